"""SQL twins of the operators that SQL can express, for DuckDB on the same tables."""

from cinderlog.llm import pii
from cinderlog.llm.spaced_seeds import SHORT, SHORT_SUBSTITUTIONS, SUBSTITUTIONS, WINDOW

# Every link is found through each shingle in common, and followed to all that it reaches.
NEAR_DUPLICATES = r"""WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents),
  s AS (SELECT DISTINCT doc_id, shingle FROM (SELECT doc_id, unnest(CASE WHEN len(t) < 2 THEN t
    ELSE list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) END) AS shingle FROM w)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
  links AS (SELECT u, v FROM shared JOIN n x ON u = x.doc_id JOIN n y ON v = y.doc_id
    WHERE 100 * c >= 80 * (x.n + y.n - c)),
  edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
  reached(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
    UNION SELECT reached.doc_id, edges.v FROM reached JOIN edges ON reached.other = edges.u),
  named AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1)
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
  FROM documents d JOIN named ON d.doc_id = named.doc_id LEFT JOIN n ON d.doc_id = n.doc_id"""

# Of three runs of a window's tokens one at least is unchanged by two substitutions.
_RUNS = "[[1, 4], [5, 8], [9, 13]]"
_TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
OVERLAPS = f"""WITH d AS (SELECT DISTINCT doc_id, {_TOKENS} AS t FROM documents),
  i AS (SELECT min(item_id) AS item_id, t FROM (SELECT item_id, {_TOKENS} AS t FROM benchmark)
    WHERE len(t) > 0 GROUP BY t),
  ds AS (SELECT doc_id, t, unnest(range(0, len(t) - {WINDOW - 1})) AS start FROM d),
  dw AS (SELECT doc_id, start, t[start + 1 : start + {WINDOW}] AS w FROM ds),
  items AS (SELECT item_id, t, unnest(range(0, len(t) - {WINDOW - 1})) AS item_start FROM i),
  iw AS (SELECT item_id, item_start, t[item_start + 1 : item_start + {WINDOW}] AS w FROM items),
  dr AS (SELECT *, unnest({_RUNS}) AS run FROM dw),
  ir AS (SELECT *, unnest({_RUNS}) AS run FROM iw),
  near AS (SELECT DISTINCT doc_id, item_id, {WINDOW} AS size, item_start - start AS shift, start
    FROM dr JOIN ir ON dr.run = ir.run AND dr.w[dr.run[1] : dr.run[2]] = ir.w[ir.run[1] : ir.run[2]]
    WHERE len(list_filter(range(1, {WINDOW + 1}), lambda k: dr.w[k] <> ir.w[k])) <= {SUBSTITUTIONS}),
  sizes AS (SELECT DISTINCT len(t) AS size FROM i WHERE len(t) < {WINDOW}),
  short AS (SELECT doc_id, size, start, t[start + 1 : start + size] AS w,
    unnest([[1, size // 2], [size // 2 + 1, size]]) AS half
    FROM (SELECT doc_id, t, size, unnest(range(0, len(t) - size + 1)) AS start FROM d, sizes)),
  si AS (SELECT item_id, t, unnest([[1, len(t) // 2], [len(t) // 2 + 1, len(t)]]) AS half
    FROM i WHERE len(t) < {WINDOW}),
  whole AS (SELECT DISTINCT doc_id, item_id, size, -start AS shift, start
    FROM short JOIN si ON size = len(t) AND short.half = si.half
      AND short.w[short.half[1] : short.half[2]] = si.t[si.half[1] : si.half[2]]
    WHERE len(list_filter(range(1, size + 1), lambda k: short.w[k] <> si.t[k]))
      <= CASE WHEN size >= {SHORT} THEN {SHORT_SUBSTITUTIONS} ELSE 0 END),
  found AS (SELECT * FROM near UNION ALL SELECT * FROM whole)
  SELECT doc_id, item_id, count(*) AS windows, min(start) AS first_token, max(start + size - 1) AS last_token
  FROM found GROUP BY 1, 2"""

# The plain patterns. An underscore bounds an account number, but not a word of \b: it is
# read as a full stop there.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(0, length({_DIGITS})), lambda i:
  CASE WHEN i % 2 = 0 THEN CAST({_DIGITS}[length({_DIGITS}) - i] AS INT)
  ELSE CAST({_DIGITS}[length({_DIGITS}) - i] AS INT) * 2
    - CASE WHEN CAST({_DIGITS}[length({_DIGITS}) - i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_TURNED = "(replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4])"
_MOD97 = f"""list_reduce(list_prepend(0, list_transform(string_split({_TURNED}, ''), lambda c:
  CASE WHEN ascii(c) <= 57 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), lambda rest, x:
  (rest * CASE WHEN x < 10 THEN 10 ELSE 100 END + x) % 97) = 1"""
_CHECKS = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p: coalesce(TRY_CAST(p AS HUGEINT), 256) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
    "iban": _MOD97,
}


def _spans(kind: str) -> str:
    seen = "translate(txt, '_', '.')" if kind == "iban" else "txt"
    near = pii.NEARBY
    return f"""SELECT r, '{kind}' AS kind, {pii.KINDS.index(kind)} AS kind_no, s AS start, s + length(m) AS stop,
      {pii.SCORES[kind]}::DOUBLE + CASE WHEN regexp_matches(
        substring(txt, greatest(s - {near}, 0) + 1, least(s, {near})) || ' ' || substring(txt, s + length(m) + 1, {near}),
        '(?i){pii.CONTEXT[kind]}') THEN {pii.BONUS}::DOUBLE ELSE 0::DOUBLE END AS score
    FROM (SELECT r, txt, ms[i] AS m, CAST(list_sum(list_transform(ps[1:i], lambda p: length(p)))
        + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p: length(p))), 0) AS BIGINT) AS s
      FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT r, txt,
        regexp_extract_all({seen}, '{_PLAIN[kind]}') AS ms, string_split_regex({seen}, '{_PLAIN[kind]}') AS ps FROM d)))
    WHERE {_CHECKS[kind]}"""


_LISTED = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no)"
PERSONAL_DATA = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS txt FROM documents),
  spans AS ({" UNION ALL ".join(map(_spans, pii.KINDS))})
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.KINDS)},
    sha256(coalesce({_LISTED} FILTER (kind <> 'iban'), '')) AS base_sha256,
    coalesce({_LISTED}, '') AS spans, coalesce(max(score), 0::DOUBLE) AS top_score
  FROM d LEFT JOIN spans ON d.r = spans.r GROUP BY d.r, doc_id"""

# Scores of every anchor with every row, ranked.
HARD_NEGATIVES = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  asked AS (SELECT vec_id, min({'l': label, 'e': e}) AS own FROM v WHERE vec_id % 100 = 0 GROUP BY 1),
  scored AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.own.l = r.label AS same,
      list_dot_product(a.own.e, r.e)::BIGINT AS score
    FROM asked a JOIN v r ON a.vec_id <> r.vec_id),
  near AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place
    FROM scored WHERE same QUALIFY place <= 5),
  found AS (SELECT n.anchor_id, n.place, n.other AS positive_id, s.other AS negative_id,
      n.score AS positive_score, s.score AS negative_score,
      row_number() OVER (PARTITION BY n.anchor_id, n.place ORDER BY s.score DESC, s.other) AS rank
    FROM near n JOIN scored s ON n.anchor_id = s.anchor_id AND NOT s.same
      AND 30 * n.score <= 100 * s.score AND 100 * s.score <= 90 * n.score)
  SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10"""

_LEAF = """sha256(list_aggregate([coalesce(CAST(octet_length(encode(p)) AS VARCHAR) || ':' || p, '-')
  FOR p IN [CAST(doc_id AS VARCHAR), source, lang, {n}, text]], 'string_agg', ''))"""
# Bit by bit: a byte enters by xor, -1 shifts.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda r, x:
  CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, 3988292384 * (r & 1)) END), 4294967295)"""
MANIFEST = f"""WITH RECURSIVE d AS (SELECT doc_id, lang, {_LEAF.format(n="CAST(n_chars AS VARCHAR)")} AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN {_LEAF.format(n="CAST(n_chars::HUGEINT + 1 AS VARCHAR)")} END AS changed FROM documents),
  langs AS (SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) AS tree, count(*) AS n FROM d GROUP BY lang),
  leaves AS (SELECT doc_id, leaf, coalesce(changed, leaf) AS folded, tree, n,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang),
  built(tree, level, pos, digest, n) AS (SELECT tree, 0, pos, leaf, n FROM leaves
    UNION ALL SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
    FROM built WHERE n > 1 GROUP BY tree, level, pos // 2, n),
  subroots AS (SELECT tree, digest FROM built WHERE n = 1),
  above(level, pos, digest, n) AS (SELECT 0, tree - 1, digest, (SELECT count(*) FROM subroots) FROM subroots
    UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
    FROM above WHERE n > 1 GROUP BY level, pos // 2, n),
  nodes AS (SELECT tree, level, pos, digest, n FROM built WHERE n > 1
    UNION ALL SELECT 0, level, pos, digest, n FROM above),
  climb(doc_id, leaf, own, tree, level, pos, n, folded, proof) AS (
    SELECT doc_id, leaf, tree, tree, 0, pos, n, folded, '' FROM leaves
    UNION ALL
    SELECT c.doc_id, c.leaf, c.own,
      CASE WHEN c.n = 1 THEN 0 ELSE c.tree END, CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
      CASE WHEN c.n = 1 THEN c.tree - 1 ELSE c.pos // 2 END,
      CASE WHEN c.n = 1 THEN (SELECT count(*) FROM subroots) ELSE (c.n + 1) // 2 END,
      CASE WHEN c.n = 1 THEN c.folded WHEN s.digest IS NULL THEN sha256(c.folded)
        WHEN c.pos % 2 = 1 THEN sha256(s.digest || c.folded) ELSE sha256(c.folded || s.digest) END,
      c.proof || coalesce(s.digest, '')
    FROM climb c LEFT JOIN nodes s
      ON c.n > 1 AND s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)
    WHERE c.n > 1 OR c.tree > 0),
  root AS (SELECT digest FROM above WHERE n = 1)
  SELECT doc_id, leaf, subroots.digest AS subroot, root.digest AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = root.digest AS verified
  FROM climb JOIN subroots ON climb.own = subroots.tree, root WHERE climb.tree = 0 AND climb.n = 1"""

ORACLE = {
    "op6_spaced_seeds": OVERLAPS,
    "op7_minhash": NEAR_DUPLICATES,
    "op8_personal_data": PERSONAL_DATA,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_merkle_manifest": MANIFEST,
}
