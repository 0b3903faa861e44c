"""Operators that find exact things: against brute force on small tables."""

import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import regex
import sentencepiece
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cinderlog.llm import common, minhash, multi_index, pii, quotations, spaced_seeds, suffix_pieces
from cinderlog.llm.common import words
from cinderlog.llm.components import components

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


# -- benchmark decontamination

def cut(text):
    return regex.findall(r"[\p{L}\p{N}]+", text.lower()) if text else []


def plain_overlaps(docs, items):
    out = {}
    for (d, text), (i, wanted) in itertools.product(docs, items):
        ours, theirs = cut(text), cut(wanted)
        size, allowed = (13, 2) if len(theirs) >= 13 else (len(theirs), int(len(theirs) >= 6))
        for a in range(len(ours) - size + 1 if size else 0):
            for b in range(len(theirs) - size + 1):
                if sum(x != y for x, y in zip(ours[a:a + size], theirs[b:b + size])) <= allowed:
                    out.setdefault((d, i), []).append((a, a + size - 1))
    return {k: (len(v), min(x for x, _ in v), max(y for _, y in v)) for k, v in out.items()}


def test_masks_miss_no_two_substitutions():
    for bad in itertools.combinations(range(spaced_seeds.WINDOW), spaced_seeds.SUBSTITUTIONS):
        assert any(
            all(m[i] == "0" or at + i not in bad for i in range(len(m)))
            for m in spaced_seeds.MASKS for at in range(spaced_seeds.WINDOW - len(m) + 1))


def test_masks_of_short_items_miss_no_substitution():
    for n in range(1, spaced_seeds.WINDOW):
        masks = spaced_seeds.short_masks(n)
        assert all(len(m) == n for m in masks)
        assert n < spaced_seeds.SHORT or all(any(m[bad] == "0" for m in masks) for bad in range(n))


def test_equal_items_are_one_class(spark):
    items = spark.createDataFrame([(5, "One two, three"), (3, "one TWO three"), (4, "one two"), (6, None), (7, "?")], ITEMS)
    assert {tuple(r) for r in spaced_seeds.item_classes(items).collect()} == {(5, 3), (3, 3), (4, 4)}


def test_overlaps_equal_their_sql(spark):
    import duckdb

    from cinderlog.llm.oracle import OVERLAPS
    words = "alpha beta gamma delta eps zeta eta theta".split()
    draw = random.Random(11)
    items = [(i, " ".join(draw.choice(words) for _ in range(i + 1))) for i in range(16)]
    docs = [(i, " ".join(["x", "y"] + [draw.choice(words) if draw.random() < 0.1 else w for w in items[i % 16][1].split()] + ["z"]))
            for i in range(64)]
    got = spaced_seeds.overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    con = duckdb.connect()
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    want = con.execute(OVERLAPS)
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("limit", [spaced_seeds.BROADCAST_BYTES, 0])
def test_overlaps_equal_brute_force(spark, limit):
    draw = random.Random(5)
    word = lambda: draw.choice("alpha beta gamma delta eps zeta eta theta".split())
    items = [(i, " ".join(word() for _ in range(draw.choice([0, 3, 5, 6, 7, 12, 13, 14, 30])))) for i in range(20)]
    items = [x for i, x in enumerate(items) if cut(x[1]) not in [cut(y[1]) for y in items[:i]]]
    items += [(100, None)]
    docs = [(i, " ".join(word() for _ in range(draw.choice([0, 5, 13, 60])))) for i in range(30)]
    for d in range(30, 45):  # items with substitutions, inside other words
        parts = cut(items[d % len(items)][1])
        parts = [word() if draw.random() < 0.12 else p.upper() for p in parts]
        docs.append((d, " ".join([word() for _ in range(9)] + parts + ["end."])))
    docs += [(50, None), (51, "")]
    extra = spark.createDataFrame(docs, DOCS).withColumn("seed", F.lit(1)).withColumn("hashes", F.lit("x"))
    got = spaced_seeds.overlaps(extra, spark.createDataFrame(items, ITEMS), limit).collect()
    want = plain_overlaps(docs, items)
    assert {(r["doc_id"], r["item_id"]): (r["windows"], r["first_token"], r["last_token"]) for r in got} == want
    assert want and len(got) == len(want)


def test_overlaps_of_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b c")], ITEMS)
    assert spaced_seeds.overlaps(none, some).count() == 0
    docs = spark.createDataFrame([(1, "x a b c"), (None, "a b c"), (2, "b c")], DOCS)
    assert spaced_seeds.overlaps(docs, some.limit(0)).count() == 0
    assert {r["doc_id"] for r in spaced_seeds.clean(docs, some).collect()} == {2}


def test_overlaps_cut_each_text_once_and_write_few_files(spark, monkeypatch):
    written, write = {}, spaced_seeds.write_table
    monkeypatch.setattr(spaced_seeds, "write_table", lambda df, label: written.setdefault(label, write(df, label)))
    items = spark.createDataFrame([(i, f"a{i} b c d e f g h i j k l m n") for i in range(50)], ITEMS)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        found = spaced_seeds.overlaps(spark.createDataFrame([(1, "x")], DOCS), items)
    finally:
        spark.conf.unset(merging)
    assert len(written["items"].inputFiles()) == len(written["seeds"].inputFiles()) == 1
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


# -- near-duplicates

def plain_groups(rows, size, percent):
    sets = {}
    for d, text in rows:
        w = words(text)
        sets[d] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    group = {d: d for d in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and common * 100 >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            group[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(seed, groups=6, copies=25, length=60):
    draw, rows, number = random.Random(seed), [], 0
    for _ in range(groups):
        text = [f"w{draw.randrange(400)}" for _ in range(length)]
        for _ in range(copies):
            worn = [f"x{draw.randrange(9999)}" if draw.random() < draw.choice([0, 0.02, 0.05, 0.1]) else w for w in text]
            rows.append((number, " ".join(worn)))
            number += 1
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    rows = near_copies(size) + [(900, None), (901, ""), (902, "one"), (903, "ONE"), (904, " \t\n")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOCS), size).collect()
    want = plain_groups(rows, size, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_parities_never_differ_more_than_the_sets():
    draw = np.random.default_rng(5)
    for size, changed in itertools.product((0, 1, 140, 5000), (0, 1, 30, 900)):
        left = draw.integers(0, 1 << 63, size, np.uint64)
        right = np.unique(np.concatenate([left[changed:], draw.integers(0, 1 << 63, changed, np.uint64)]))
        a, b = minhash._parity(np.unique(left)), minhash._parity(right)
        assert len(a) == minhash.PARITY_WORDS
        apart = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a, b))
        assert apart <= len(np.setxor1d(left, right))


def test_prefix_join_finds_every_link_without_buckets(spark):
    """As if every set were a component of its own and all of them met in mixed buckets."""
    rows = near_copies(11, groups=2, copies=40)
    docs = spark.createDataFrame(rows, DOCS)
    table = docs.select("doc_id", "text")
    sketches = table.mapInPandas(lambda it: minhash._sketch(it, 2, 40, 6),
                                 "doc_id long, n_shingles long, node long, bands array<long>, signature binary")
    classes = sketches.dropDuplicates(["node"])
    members = classes.select("node", F.col("node").alias("component"))
    pairs = minhash._confirm(table, minhash._remaining_pairs(table, members, classes, 2, 80), classes, 2, 80).collect()
    name = {r["node"]: r["doc_id"] for r in classes.collect()}
    text = dict(rows)
    two = lambda d: set(zip(text[d].split(), text[d].split()[1:]))
    want = {tuple(sorted(p)) for p in itertools.combinations(sorted(name.values()), 2)
            if len(two(p[0]) & two(p[1])) * 100 >= 80 * len(two(p[0]) | two(p[1]))}
    assert {tuple(sorted((name[r["u"]], name[r["v"]]))) for r in pairs} == want and want


def test_near_duplicates_with_odd_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (3, text + " more"), (None, text), (7, "a b c"), (7, "d e f"), (8, "d e f")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOCS).withColumn("node", F.lit(1)), 2).collect()
    found = sorted((r["doc_id"] or -1, r["component_id"]) for r in got)
    assert found == sorted([(5, 3), (5, 3), (3, 3), (7, 7), (7, 7), (8, 7)] + [(-1, None)])
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (200, 201)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


# -- personal data

def plain_spans(text):
    out, text = [], text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_spans_equal_plain_patterns(spark):
    draw = random.Random(8)
    signs = "0123456789" * 3 + "..  --@@++()ab_é🙂"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(200))) for _ in range(300)]
    texts += [
        None, "", "a@b.com_x@y.org", "é🙂 mail a.b@c-d.e.f!", "4111 1111 1111 1111", "4111-1111-1111-1111 5",
        "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.004", "+49 (0) 30 123456-78", "0" * 5000, "a" * 50000, "1." * 5000,
        "a@" * 2000, "@a.b" * 2000, "+1" + "(" * 5000, "7 7 7 7 7 7 7 7 7 7 7 7 7 7", "4242424242424242" * 3,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("pii", F.lit(1)).withColumn("m_ip", F.lit(2))
    for row in pii.find(docs).collect():
        own = [(s["start"], s["kind_no"], s["end"]) for s in row["pii"] if s["kind"] != "iban"]
        assert own == plain_spans(row["text"]), row["text"]


def test_iban_before_a_word(spark):
    """A word after a grouped account number is not taken for its next group."""
    docs = spark.createDataFrame(
        [(0, "to BE68 5390 0754 7034 PLEASE"), (1, "x_BE68539007547034_"), (2, "xBE68539007547034")], DOCS)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["pii"]] for r in pii.find(docs).collect()}
    assert got == {0: [("iban", 3, 22)], 1: [("iban", 2, 18)], 2: []}


def test_iban_context_and_masks(spark):
    texts = [
        "pay to DE89 3704 0044 0532 0130 00 now", "GB82WEST12345698765432", "GB82WEST12345698765433",
        "my e-mail: a@b.org", "zz a@b.org", "call +49 30 12345678 or a@b.org.", None,
    ]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], DOCS + ", n_chars long")
    rows = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert [s["kind"] for s in rows[0]["pii"]] == ["iban"] and len(rows[1]["pii"]) == 1 and not rows[2]["pii"]
    assert rows[3]["pii"][0]["score"] > rows[4]["pii"][0]["score"]
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact(docs).collect()}
    assert masked[0][0] == "pay to <IBAN> now"
    assert masked[5] == ("call <PHONE> or <EMAIL>.", len("call <PHONE> or <EMAIL>."))
    assert masked[6] == (None, 0) and masked[2] == (texts[2], 0)
    assert [r["spans"] for r in pii.find(docs.where("doc_id = 5")).select(
        pii.digest(F.col("pii")).alias("spans")).collect()] == ["phone:5:20,email:24:31"]


def test_personal_data_of_very_long_texts(spark):
    """Offsets, context and masking far into a text; 20,000 addresses, some of two kinds at once."""
    words = [f"ü𝄞 u{i}@ex{i % 7}.org {'mail' if i % 3 else 'x' * 60} +1 555 010 {i % 10000:04d}" for i in range(20_000)]
    text = "\n".join(words)
    docs = spark.createDataFrame([(1, text, "kept", 3), (2, "", "b", 0), (3, None, "c", None)],
                                 "doc_id long, text string, m_x string, n_chars long")
    found = {r["doc_id"]: r["pii"] for r in pii.find(docs).collect()}
    spans = {k: [(s["start"], s["end"]) for s in found[1] if s["kind"] == k] for k in pii.KINDS}
    assert spans["email"] == [m.span() for m in re.finditer(r"u[0-9]+@ex[0-9]\.org", text)]
    assert spans["phone"] == [m.span() for m in re.finditer(r"\+1 555 010 [0-9]{4}", text)]
    assert found[2] == found[3] == []
    for s in found[1][::997]:
        around = text[max(0, s["start"] - pii.NEARBY):s["start"]] + " " + text[s["end"]:s["end"] + pii.NEARBY]
        bonus = pii.BONUS if re.search(f"(?i){pii.CONTEXT[s['kind']]}", around) else 0
        assert s["score"] == pytest.approx(pii.SCORES[s["kind"]] + bonus)
    masked = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    want, at = [], 0
    for s in found[1]:
        if s["start"] >= at:
            want += [text[at:s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    assert masked[1]["text"] == "".join(want) + text[at:]
    assert masked[1]["n_chars"] == len(masked[1]["text"]) and masked[1]["m_x"] == "kept"
    assert masked[2]["text"] == "" and masked[3]["text"] is None



# -- nearest neighbours

def test_search_equals_brute_force_when_all_cells_are_walked(spark):
    draw = np.random.default_rng(4)
    points = draw.normal(size=(300, 8)).round(2)
    points[50:80] = points[50]
    bad = [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [None] * 8), (1004, [float("inf")] * 8), (None, [1.0] * 8)]
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + bad
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit("x"))
    got = multi_index.nearest(spark, vectors, F.col("vec_id") % 20 == 0, 20, 1.0).orderBy("query_id", "rank").collect()
    scores = np.einsum("ij,kj->ik", points, points)
    want = []
    for q in range(0, 300, 20):
        others = [i for i in range(300) if i != q]
        order = sorted(others, key=lambda i: (-scores[q, i], i))[:20]
        want += [(q, n, i) for n, i in enumerate(order, 1)]
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == want
    assert all(r["score"] == scores[r["query_id"], r["vec_id"]] for r in got)


def test_search_of_few_or_no_vectors(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = multi_index.nearest(spark, vectors, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 20), (0, 2, 3), (20, 1, 0), (20, 2, 3)]
    assert multi_index.nearest(spark, vectors.limit(0), F.lit(True)).count() == 0


def test_recall_of_the_fitted_walk(spark, sf_dir):
    draw = np.random.default_rng(6)
    points = draw.normal(size=(4000, 64))
    points /= np.linalg.norm(points, axis=1)[:, None]
    vectors = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = multi_index.nearest(spark, vectors, F.col("vec_id") % 20 == 0).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for q, own in found.items():
        s = points @ points[q]
        s[q] = -9
        hits.append(len(own & set(np.argsort(-s)[:20].tolist())) / 20)
    assert len(found) == 200 and np.mean(hits) >= 0.9


@pytest.mark.parametrize("spread", [0.0, 0.01])
def test_recall_beside_a_third_of_equal_or_near_equal_rows(spark, spread):
    draw = np.random.default_rng(8)
    points = draw.normal(size=(2000, 64))
    points = np.concatenate([points, points[:1] + spread * draw.normal(size=(1000, 64))])
    points /= np.linalg.norm(points, axis=1)[:, None]
    vectors = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    books = multi_index.fit(multi_index.usable(vectors))
    entries = multi_index.index(vectors, books)
    got = multi_index.search(entries, books, entries.where("vec_id % 20 = 0 and vec_id < 2000")).collect()
    scores = {}
    for r in got:
        scores.setdefault(r["query_id"], []).append(r["score"])
    hits = []
    for q, own in scores.items():
        s = points @ points[q]
        s[q] = -9
        hits.append((np.array(own) >= np.sort(s)[-20] - 1e-9).mean())
    assert len(hits) == 100 and np.mean(hits) >= 0.9


def test_ranks_passed_cells_only(spark):
    draw = np.random.default_rng(12)
    points = draw.normal(size=(1500, 16))
    vectors = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    books = multi_index.fit(multi_index.usable(vectors))
    entries = multi_index.index(vectors, books)
    cell = {r["vec_id"]: r["cell"] for r in entries.collect()}
    size = multi_index.cell_sizes(entries, books)
    for wave in (1 << 20, 2000):
        got = multi_index.search(entries, books, entries.where("vec_id % 20 = 0"), 5, enough=200, wave_bytes=wave).collect()
        want = []
        for q in range(0, 1500, 20):
            left, right = points[q, :8] @ books.left.T, points[q, 8:] @ books.right.T
            cells, _ = multi_index.walk(left, right, size.reshape(len(books.left), -1), 200)
            assert len(cells) < (size > 0).sum() / 2
            passed = {a * len(books.right) + b for a, b in cells}
            near = sorted((-float(points[q] @ points[i]), i) for i in range(1500) if i != q and cell[i] in passed)[:5]
            want += [(q, n, i) for n, (_, i) in enumerate(near, 1)]
        assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == want


def test_walk_goes_down():
    draw = np.random.default_rng(9)
    left, right, size = draw.normal(size=6), draw.normal(size=5), draw.integers(0, 3, (6, 5))
    cells, border = multi_index.walk(left, right, size, 10**9)
    sums = [left[i] + right[j] for i, j in cells]
    assert sums == sorted(sums, reverse=True) and {c for c in cells} == set(zip(*map(list, np.nonzero(size))))


# -- SentencePiece

ODD = ["", None, " ", "a", "a  b   c", "▁a", "x\n\ny\t z", "日本語 ﬁ é 🙂🙂", "a" * 500, "<s> </s> <0x0A>", "\x00a\x00", " " * 70 + "x", "é" * 200]


@pytest.fixture(scope="module")
def vocabulary():
    return suffix_pieces.load()


def test_ids_are_those_of_the_library(spark, sf_dir, vocabulary):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    draw = random.Random(3)
    texts += ODD + ["".join(draw.choice(" abcdehtno▁\né日<s>🙂") for _ in range(draw.randint(1, 200))) for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    library = sentencepiece.SentencePieceProcessor(model_file=suffix_pieces.MODEL)
    coded = suffix_pieces.encode(docs, vocabulary)
    for row in coded.collect():
        assert row["ids"] == library.encode(texts[row["doc_id"]] or "")
    for row in suffix_pieces.decoded(coded, vocabulary).collect():
        assert row["text"] == (texts[row["doc_id"]] or "").replace("▁", " ")
    rows = suffix_pieces.summary(docs, vocabulary).collect()
    assert len(rows) == len(texts) and all(r["round_trip"] for r in rows)


def test_encoding_holds_few_words_at_a_time(vocabulary):
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choices("abcdehinorst", k=7)) for _ in range(500)) for _ in range(700)]

    class Shared:
        value = cloudpickle.dumps(vocabulary)

    next(suffix_pieces._encode(iter([pa.array(["warm up"])]), Shared))
    batch = pa.array(texts)
    del texts
    tracemalloc.start()
    n = sum(len(ids) for part in suffix_pieces._encode(iter([batch]), Shared) for ids in part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 350_000 and peak < 95e6  # before: all words of a batch and 400,000 known ones


def test_tasks_give_memory_back_at_their_end(monkeypatch):
    given = []
    monkeypatch.setattr(common, "_give_back", lambda: given.append(1))
    work = common.tidy(lambda n: iter(range(n)))
    assert list(work(3)) == [0, 1, 2] and given == [1]
    begun = work(3)
    next(begun)
    begun.close()
    assert given == [1, 1]


def test_path_relaxation_finds_the_best_sum():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "bab", "▁ab", "c"]
    scores = np.array([-2.0, -3.1, -3.3, -4.2, -4.0, -4.9, -5.3, -6.6, -2.5])
    model = suffix_pieces.Vocabulary(pieces, np.arange(9, dtype=np.int32), scores, np.full(256, -1), 99, False, [], 3)
    score = dict(zip(pieces, scores))

    def best(text):
        if not text:
            return 0.0
        options = [score[text[:n]] + best(text[n:]) for n in (1, 2, 3) if text[:n] in score]
        return max(options)

    draw = random.Random(1)
    texts = ["".join(draw.choice("abc ") for _ in range(draw.randrange(1, 12))) for _ in range(60)]
    for text, ids in zip(texts, suffix_pieces.Encoder(model).encode([suffix_pieces.units(t) for t in texts])):
        assert "".join(pieces[i] for i in ids) == "▁" + text.replace(" ", "▁")
        assert sum(scores[ids]) == pytest.approx(best("▁" + text.replace(" ", "▁")))


# -- quotations

def test_replies_without_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow do I sort?"), (1, 1, "bot", "Use sorted().\nIt is stable."),
        (1, 2, "user", "On Monday, A wrote:\n> Use sorted().\n> It is stable.\nThanks! And dicts?"),
        (1, 3, "bob", "> > Use sorted().\n> thanks! and  DICTS?\nDicts keep order."),
        (1, 4, "user", "> Hello there.\nhi"), (1, 4, "user", "> Hello there.\nhi"),
        (2, 0, None, None), (2, 1, "a", "> nothing known\nx > y"), (None, 1, "a", "b"), (3, None, "a", "b"),
    ]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("level", F.lit(1))
    got = quotations.thread(talk).orderBy("conv_id", "position").collect()
    assert [(r["conv_id"], r["position"], r["turn"], r["reply_to"], r["depth"], r["quoted"], r["linked"], r["body"]) for r in got] == [
        (1, 1, 0, None, 0, 0, 0, "Hello there.\nHow do I sort?"), (1, 2, 4, 0, 1, 1, 1, "hi"),
        (1, 3, 1, None, 0, 0, 0, "Use sorted().\nIt is stable."), (1, 4, 2, 1, 1, 2, 3, "Thanks! And dicts?"),
        (1, 5, 3, 2, 2, 2, 2, "Dicts keep order."), (2, 1, 0, None, 0, 0, 0, ""), (2, 2, 1, None, 0, 1, 0, "x > y"),
    ]
    assert quotations.thread(talk.limit(0)).count() == 0


def test_long_chain_of_replies(spark):
    rows = [(1, 0, "a", "line 0")] + [(1, i, "a", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    got = quotations.thread(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r["turn"], r["depth"], r["position"]) for r in got) == [(i, i, i + 1) for i in range(40)]
