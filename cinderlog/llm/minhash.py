"""MinHash near-dedup: universal hash minima, banding, signature check, exact check, components.

1. Each task reduces a text to its set of distinct shingles, a digest of the set, the minima
   of many universal hashes (one byte of each is kept as signature) and one key per band.
   Texts with equal sets share the digest and go on as one class, named by its smallest id.
2. Classes that share a band key are candidates. Each is held against the smallest class of
   its bucket only, so a bucket of any size gives as many pairs as members. Signatures drop
   what cannot be similar enough; full sets decide. Components come from these links.
3. Buckets that still hold members of different components get other centres, for some
   rounds: a large group of near copies becomes one component without its pairs.
4. What is missed by then are links between members of one bucket that still are in
   different components. All classes of such buckets go through an exact prefix-filtered
   join on shingles (rarest first), which needs no bucket and leaves no pair out. Parities
   of the sets bound their difference from below and keep most other pairs out of the join.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.llm.common import WordHashes, chain, mix, slices, tidy, words
from cinderlog.llm.components import components
from cinderlog.session import write_table

# Production setting: at a similarity of 0.8, 40 bands of 6 miss a pair with p = 5e-6.
BANDS, ROWS = 40, 6
# Signature positions that may agree less than the threshold says (over five deviations).
SLACK = 0.14
BATCH_TOKENS = 500_000
# Rounds with other centres before the exact join; 64-bit words of the parities of a set.
ROUNDS, PARITY_WORDS = 1, 16
LONELY = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(token_lists, hashes: WordHashes, size: int):
    """Per token list, the sorted distinct 64-bit hashes of its shingles of size words; a
    shorter list is one shingle, an empty one has none."""
    for tokens in token_lists:
        h = hashes.array(tokens)
        if len(h) >= size:
            s = h[: len(h) - size + 1]
            for i in range(1, size):
                s = chain(s, h[i: len(h) - size + 1 + i])
        elif len(h):
            s = np.array([LONELY + np.uint64(len(h))])
            for w in h:
                s = chain(s, w)
        else:
            s = h
        yield np.unique(s)


def _minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of the upper half of a*x+b per hash function, a piece of the set at a time."""
    least = np.full(len(a), np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 512):
        part = shingles[at: at + 512, None] * a
        part += b
        np.minimum(least, part.min(axis=0), out=least)
    return least >> np.uint64(32)


def _functions(count: int):
    draw = np.random.default_rng(20240607)
    a = draw.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 1 << 63, count, np.uint64)


def _node(shingles: np.ndarray) -> int:
    """Name of a set: equal sets, and in practice only these, share it."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


@tidy
def _sketch(frames, size: int, bands: int, rows: int):
    hashes, (a, b) = WordHashes(), _functions(bands * rows)
    lane = mix(np.arange(1, bands + 1, dtype=np.uint64))
    remembered = {}
    for frame in frames:
        out = []
        for _, lists in slices(frame["text"], BATCH_TOKENS, words):
            for s in shingle_sets(lists, hashes, size):
                if not len(s):
                    out.append((0, None, None, None))
                    continue
                node = _node(s)
                if node not in remembered:
                    if len(remembered) > 10_000:
                        remembered.clear()
                    least = _minima(s, a, b)
                    key = lane
                    for i in range(rows):
                        key = chain(key, least[i::rows])
                    remembered[node] = key.view(np.int64), (least & np.uint64(255)).astype(np.uint8).tobytes()
                out.append((len(s), node, *remembered[node]))
        sizes, nodes, keys, signatures = zip(*out) if out else ((),) * 4
        yield pd.DataFrame({
            "doc_id": frame["doc_id"].to_numpy(), "n_shingles": np.array(sizes, np.int64),
            "node": pd.array(nodes, "Int64"),  # exact, nulls among them or not
            "bands": list(keys), "signature": list(signatures),
        })


@tidy
def _sets(frames, size: int):
    hashes = WordHashes()
    for frame in frames:
        out = [s for _, lists in slices(frame["text"], BATCH_TOKENS, words)
               for s in shingle_sets(lists, hashes, size)]
        found = pd.DataFrame({"node": frame["node"].to_numpy(), "shingles": [s.tobytes() for s in out]})
        # An id may have several texts: only the one that bears the name is meant.
        yield found[found["node"].to_numpy() == np.array([_node(s) for s in out], np.int64)]


def _alike(frames, threshold: float):
    """Pairs whose signatures agree often enough."""
    for frame in frames:
        if len(frame):
            left = np.frombuffer(b"".join(frame["u_sig"]), np.uint8).reshape(len(frame), -1)
            right = np.frombuffer(b"".join(frame["v_sig"]), np.uint8).reshape(len(frame), -1)
            yield frame.loc[(left == right).mean(axis=1) >= threshold - SLACK, ["u", "v"]]


def _linked(frames, percent: int):
    """Pairs whose full sets are similar enough: 100 * common >= percent * union."""
    for frame in frames:
        keep = []
        for u, v in zip(frame["u_set"], frame["v_set"]):
            x, y = np.frombuffer(u, np.uint64), np.frombuffer(v, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True)) \
                if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) else 0
            keep.append(common * 100 >= percent * (len(x) + len(y) - common))
        yield frame.loc[np.array(keep, bool), ["u", "v"]]


PAIR = "u long, v long"


def _with(pairs: DataFrame, values: DataFrame, column: str, suffix: str) -> DataFrame:
    for side in ("u", "v"):
        pairs = pairs.join(
            values.select(F.col("node").alias(side), F.col(column).alias(f"{side}_{suffix}")), side
        )
    return pairs


def _set_table(documents: DataFrame, nodes: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """The shingle sets of the given nodes, from the text of one document each."""
    wanted = classes.join(nodes, "node").select("node", "doc_id")
    texts = documents.join(wanted, "doc_id").select("node", "text")
    return write_table(texts.mapInPandas(lambda it: _sets(it, size), "node long, shingles binary"), "sets")


def _confirm(documents, pairs, classes, size, percent, sets=None):
    """The pairs that are links: signatures first, then the full sets. sets: a table that has
    them; without it they are made for the pairs whose signatures agree."""
    pairs = write_table(
        _with(pairs, classes, "signature", "sig").mapInPandas(lambda it: _alike(it, percent / 100), PAIR), "alike"
    )
    if sets is None:
        nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
        sets = _set_table(documents, nodes, classes, size)
    # Sets of one very common partner are joined to each of its pairs; AQE splits that key.
    return write_table(
        _with(pairs, sets, "shingles", "set").mapInPandas(lambda it: _linked(it, percent), PAIR), "links"
    )


def _open(placed: DataFrame) -> DataFrame:
    """band, node, component of the buckets with members of more than one component."""
    spread = placed.select("node", "component", F.explode("bands").alias("band"))
    mixed = spread.groupBy("band").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band")
    return spread.join(mixed, "band")


def _centre_pairs(buckets: DataFrame, number: int) -> DataFrame:
    """Every member of an open bucket with a centre that the round's number draws for it."""
    centres = buckets.groupBy("band").agg(
        F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(number))).alias("centre"))
    return buckets.join(centres, "band").where("component <> centre.component").select(
        F.least("node", "centre.node").alias("u"), F.greatest("node", "centre.node").alias("v")).distinct()


def _parity(shingles: np.ndarray) -> list:
    """Parity of the number of shingles per slot. Two sets differ in at least as many shingles
    as their parities differ in slots."""
    slots = (shingles % np.uint64(64 * PARITY_WORDS)).astype(np.int64)
    odd = np.bincount(slots, minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _remaining_pairs(documents, members, classes, size, percent, sets=None):
    """Pairs of members of different components that share a shingle among the rarest ones
    a set needs to be similar to any other, with enough shingles behind it on either side and
    parities near enough: all pairs with the similarity are among them. members: node,
    component; sets: a table with at least their sets, made if not given."""
    words_of = [f"p{i}" for i in range(PARITY_WORDS)]

    def unfold(frames):
        for frame in frames:
            for node, blob in zip(frame["node"], frame["shingles"]):
                s = np.frombuffer(blob, np.int64)
                yield pd.DataFrame({"node": np.full(len(s), node), "item": s})

    def parities(frames):
        for frame in frames:
            found = [_parity(np.frombuffer(blob, np.uint64)) for blob in frame["shingles"]]
            out = pd.DataFrame(found, columns=words_of, dtype=np.int64)
            out.insert(0, "node", frame["node"].to_numpy())
            yield out

    if sets is None:
        sets = _set_table(documents, members.select("node"), classes, size)
    sets = sets.join(members.select("node"), "node", "left_semi")
    items = write_table(sets.mapInPandas(unfold, "node long, item long"), "items")
    parity = sets.mapInPandas(parities, ", ".join(f"{c} long" for c in ["node", *words_of]))
    counted = items.groupBy("item").agg(F.count("*").alias("used")).where("used > 1")
    # One bounded group per document: its own shingles, rarest first.
    ranked = items.join(counted, "item").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("used", "item"))).alias("shared")
    ).join(classes.select("node", "n_shingles"), "node")
    # The first n - ceil(n * percent / 100) + 1 shingles of all, without those nobody shares.
    length = F.expr(
        f"cast(n_shingles - ceil(n_shingles * {percent} / 100) + 1 - (n_shingles - size(shared)) as int)"
    )
    # left: the shingle and those after it, which are all that a pair that meets in it first
    # can have in common.
    first = ranked.where(length > 0).join(members, "node").join(parity, "node").select(
        "node", "component", F.col("n_shingles").alias("n"), F.size("shared").alias("s"), *words_of,
        F.posexplode(F.slice("shared", 1, length)).alias("i", "x"),
    ).select("node", "component", "n", (F.col("s") - F.col("i")).alias("left"), *words_of, "x.item")
    first = write_table(first, "prefixes")
    a, b = first.alias("a"), first.alias("b")
    apart = " + ".join(f"bit_count(a.{w} ^ b.{w})" for w in words_of)
    return a.join(b, F.expr(
        f"a.item = b.item and a.node < b.node and a.component <> b.component "
        f"and 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) "
        f"and {100 + percent} * least(a.left, b.left) >= {percent} * (a.n + b.n) "
        f"and {100 + percent} * ({apart}) <= {100 - percent} * (a.n + b.n)"
    )).select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()


def near_duplicates(documents: DataFrame, shingle_words: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Links documents whose shingle sets have 100 * common >= percent * union.

    Returns per row of documents: doc_id, n_shingles, component_id (smallest doc_id reachable,
    itself included) and kept (doc_id = component_id). Null and empty texts have no shingles
    and are linked with nothing; a text shorter than a shingle is one shingle of its own.
    Repeated rows come back each. Rows with equal doc_id and different texts are one document,
    linked with what any of its texts is linked with. A row without doc_id takes no part: its
    component is null and it is kept. No rows give no rows. Other columns are not read."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = write_table(
        documents.mapInPandas(
            lambda it: _sketch(it, shingle_words, bands, rows),
            "doc_id long, n_shingles long, node long, bands array<long>, signature binary",
        ), "sketches",
    )
    usable = sketches.where("node is not null and doc_id is not null")
    named = usable.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    classes = write_table(
        usable.join(named, ["node", "doc_id"]).dropDuplicates(["node"]), "classes"
    )
    keyed = classes.select("node", F.explode("bands").alias("band"))
    centres = keyed.groupBy("band").agg(F.min("node").alias("u"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = keyed.join(centres, "band").where("node <> u").select("u", F.col("node").alias("v")).distinct()
    links = _confirm(documents, pairs, classes, shingle_words, percent)
    sets = None
    for number in range(ROUNDS + 1):
        reached = write_table(components(links), "reached")
        placed = classes.join(reached, "node", "left").select(
            "node", "bands", F.coalesce("component", "node").alias("component"))
        buckets = write_table(_open(placed), "open")
        if buckets.isEmpty():
            break
        members = buckets.select("node", "component").distinct()
        if sets is None:  # later rounds have no other members
            sets = _set_table(documents, members.select("node"), classes, shingle_words)
        more = _centre_pairs(buckets, number) if number < ROUNDS else _remaining_pairs(
            documents, members, classes, shingle_words, percent, sets)
        links = links.unionByName(_confirm(documents, more, classes, shingle_words, percent, sets))
    # An id with several texts ties their sets together.
    several = usable.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("w")).where("u < w")
    ties = usable.join(several, "doc_id").select("u", F.col("node").alias("v"))
    final = components(links.unionByName(ties))
    rows_out = sketches.select("doc_id", "n_shingles", "node").join(final, "node", "left").withColumn(
        "component", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    )
    least = rows_out.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    named = rows_out.join(least, "component", "left")
    component_id = F.coalesce("least", "doc_id")
    return named.select(
        "doc_id", "n_shingles", component_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"),
    )
