"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A document is contaminated by an item if WINDOW tokens in a row equal as many tokens of the
item in a row, but for SUBSTITUTIONS of them at most. A mask picks some positions of a short
span of tokens; the picked tokens are hashed together, so substitutions elsewhere don't
matter. The masks are chosen so that every such window holds a hit of one of them wherever
the substitutions fall (tests go through all cases): nothing is missed. Hits are verified
token by token in the windows around them. An item shorter than a window must be contained
whole: with one substitution at most from SHORT tokens on, for which three masks of its length
leave out every third token each, and unchanged below that, with a mask without gaps.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlog.session import write_table

WINDOW, SUBSTITUTIONS = 13, 2
MASKS = ("11101111", "1111010011", "10100110111")
SHORT, SHORT_SUBSTITUTIONS = 6, 1
# The side of the items is broadcast up to this size (it is measured); beyond it, shuffled.
BROADCAST_BYTES = 64 << 20
# Items that one task writes; few files, as each costs a process that sets its rights.
TASK_ITEMS = 20_000


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; none for null."""
    cut = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.filter(cut, lambda t: t != "")


def hashed(parts: Column) -> Column:
    return F.transform(parts, lambda t: F.xxhash64(t))


def _seed(mask: str, number: int, hashes: Column, place: Column, length: Column) -> Column:
    """Hash of the tokens that the mask picks from place on; null where it reaches past the end."""
    picked = [F.get(hashes, place + i) for i, on in enumerate(mask) if on == "1"]
    return F.when(place <= length - len(mask), F.xxhash64(F.lit(number), *picked))


def short_masks(length: int) -> list:
    """The masks of an item that is shorter than a window."""
    if length < SHORT:
        return ["1" * length]
    return ["".join("0" if i % 3 == out else "1" for i in range(length)) for out in range(3)]


def _items(benchmark: DataFrame) -> DataFrame:
    """One row per distinct token sequence: the smallest item_id and the token hashes."""
    return benchmark.select("item_id", hashed(tokens(F.col("text"))).alias("wanted")).where(
        F.size("wanted") > 0
    ).groupBy("wanted").agg(F.min("item_id").alias("item_id")).withColumn("item_len", F.size("wanted"))


def item_classes(benchmark: DataFrame) -> DataFrame:
    """item_id and class_id of every item that has tokens: items with the same tokens are one class,
    named by its smallest item_id, and overlaps reports the class. Repeated rows stay."""
    named = benchmark.select("item_id", hashed(tokens(F.col("text"))).alias("wanted")).where(F.size("wanted") > 0)
    classes = named.groupBy("wanted").agg(F.min("item_id").alias("class_id"))
    return named.join(classes, "wanted").select("item_id", "class_id")


def _item_seeds(items: DataFrame, masks) -> DataFrame:
    placed = items.select("item_id", "wanted", "item_len", F.posexplode("wanted").alias("item_at", "_w"))
    rows = []
    for number, (mask, window, allowed) in enumerate(masks):
        fits = F.col("item_len") == window if window < WINDOW else F.col("item_len") >= WINDOW
        seed = _seed(mask, number, F.col("wanted"), F.col("item_at"), F.col("item_len"))
        rows.append(F.when(fits & seed.isNotNull(), F.struct(
            seed.alias("seed"), F.lit(len(mask)).alias("span"), F.lit(window).alias("window"),
            F.lit(allowed).alias("allowed"),
        )))
    found = placed.select("item_id", "item_at", F.explode(F.array(*rows)).alias("s")).where("s is not null")
    return found.select("item_id", "item_at", "s.*")


def overlaps(documents: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document and item that overlap: doc_id, item_id, windows (matching windows),
    first_token and last_token (what they cover of the document, counted from 0).

    documents: doc_id, text; benchmark: item_id, text; other columns are not read. Items with
    the same tokens are one item, named by the smallest item_id (item_classes has the others). Null and empty texts have no
    tokens and overlap with nothing, nor do documents shorter than a window, unless a shorter
    item is in them. Rows with equal doc_id and text count once; a null doc_id is reported
    as null. Empty tables give no rows."""
    items = write_table(_items(benchmark).coalesce(benchmark.count() // TASK_ITEMS + 1), "items")
    stats = items.agg(F.sum("item_len")).first()[0] or 0
    lengths = [r[0] for r in items.where(F.col("item_len") < WINDOW).select("item_len").distinct().collect()]
    masks = [(m, WINDOW, SUBSTITUTIONS) for m in MASKS] + [  # three more at most per length below WINDOW
        (m, n, SHORT_SUBSTITUTIONS if n >= SHORT else 0) for n in sorted(lengths) for m in short_masks(n)]
    seeds = write_table(_item_seeds(items, masks), "seeds")
    small = stats * len(masks) * 64 <= broadcast_bytes
    docs = documents.select("doc_id", hashed(tokens(F.col("text"))).alias("hashes")).withColumn(
        "doc_len", F.size("hashes")
    )
    # Outer: else Spark adds a filter on the size of hashes, which cuts and hashes every text once more.
    placed = docs.select("doc_id", "hashes", "doc_len", F.posexplode_outer("hashes").alias("doc_at", "_h"))
    keyed = placed.select(
        "doc_id", "hashes", "doc_len", "doc_at",
        F.explode(F.array(*[
            _seed(m, n, F.col("hashes"), F.col("doc_at"), F.col("doc_len")) for n, (m, _, _) in enumerate(masks)
        ])).alias("seed"),
    ).where("seed is not null")
    reach = F.slice("hashes", F.greatest(F.col("doc_at") - (WINDOW - 1), F.lit(0)) + 1, 2 * WINDOW - 1)
    if small:
        hits = keyed.join(F.broadcast(seeds), "seed").withColumn("near", reach).drop("hashes").join(
            F.broadcast(items.select("item_id", "wanted", "item_len")), "item_id"
        )
    else:
        # Only positions and the few tokens a verification can need are shuffled.
        hits = keyed.withColumn("near", reach).drop("hashes").join(seeds, "seed").join(
            items.select("item_id", "wanted", "item_len"), "item_id"
        )
    shift = F.greatest(F.col("doc_at") - (WINDOW - 1), F.lit(0))

    def matches(start):
        """The window of the document from start on, against the item at the same offset."""
        other = start - F.col("doc_at") + F.col("item_at")
        ours = F.slice("near", start - shift + 1, F.col("window"))
        theirs = F.slice("wanted", other + 1, F.col("window"))
        inside = (start + F.col("window") <= F.col("doc_len")) & (other >= 0) & (
            other + F.col("window") <= F.col("item_len")
        )
        differing = F.aggregate(
            F.zip_with(ours, theirs, lambda a, b: (a != b).cast("int")), F.lit(0), lambda s, x: s + x
        )
        return F.when(inside, differing <= F.col("allowed")).otherwise(False)

    starts = F.sequence(F.greatest(F.col("doc_at") + F.col("span") - F.col("window"), F.lit(0)), F.col("doc_at"))
    windows = hits.select(
        "doc_id", "item_id", "window", (F.col("item_at") - F.col("doc_at")).alias("offset"),
        F.explode(F.filter(starts, matches)).alias("start"),
    ).distinct()
    return windows.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("windows"), F.min("start").cast("long").alias("first_token"),
        F.max(F.col("start") + F.col("window") - 1).cast("long").alias("last_token"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no item, all columns. Whether a row stays depends on its
    own text alone, whatever its doc_id: rows are told apart by the hash of the text, so equal
    texts are searched once. Null and empty texts stay."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = documents.select(key.alias("doc_id"), "text")
    found = write_table(overlaps(texts, benchmark).select(F.col("doc_id").alias("_found")).distinct(), "overlapping")
    return documents.join(found, key == F.col("_found"), "left_anti")
