"""Merkle manifest of a dataset: one tree per language over its documents, one over the subroots.

Building. Leaves are numbered within their language by range pieces. STEP levels of a tree are
built per aggregation, from groups of 2 ** STEP neighbours. A group of leaves stays one row with
all it holds; groups higher up become node rows: a node, the siblings on its way up, and a link to
the node STEP levels above it. The last link of a language leads to its subroot's place in the
tree of subroots.

Proving. A recursive query starts from the groups of leaves and climbs from link to link: each step
appends the siblings that all leaves of the group share. Then every leaf folds its hash, the tampered
one where there is one, over the siblings in its group and those climbed; so what grows on the way
is moved once per 2 ** STEP leaves. A node high up is on the way of very many groups, so its row is
stored once per block of 2 ** SPAN leaves below it: no row of the join is met by more groups than
such a block has, however large a language is.
"""

import contextlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.llm.common import fold
from cinderlog.operators.ranking import positions
from cinderlog.session import scratch_path, scratch_scope, write_table

STEP, SPAN = 6, 12  # levels of a node row; SPAN is a multiple of STEP
TOP, DONE = 0, -1   # the tree of subroots, and the place above the root
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def _part(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """Digest of a document's fields, each with its byte count in front, - where it is null."""
    parts = [_part(changed.get(name, F.col(name))) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _above(level: Column) -> Column:
    """Digests of the level above: of every two in a row, the last one alone if it is left over."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
    return F.transform(pairs, lambda i: F.unhex(F.sha2(F.concat(
        _text(F.get(level, 2 * i)), F.coalesce(_text(F.get(level, 2 * i + 1)), F.lit(""))), 256)))


def _depth(n: Column) -> Column:
    """Levels above n nodes: the bits of n - 1."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


def _grouped(nodes: DataFrame, carried=()) -> DataFrame:
    """Groups of 2 ** STEP neighbours of one level, stored: the nodes held, with the carried columns,
    and the digests l0, l1 ... of the levels above them. nodes: tree, depth, level, pos, digest. A
    tree that ends on the way ends there, and its top has number 0 on the level above."""
    grouped = nodes.groupBy("tree", "depth", "level", F.shiftright("pos", STEP).alias("up")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("held"))
    grouped = grouped.withColumn("l0", F.col("held.digest"))
    for k in range(STEP):
        more = F.col("level") + k < F.col("depth")
        grouped = grouped.withColumn(f"l{k + 1}", F.when(more, _above(F.col(f"l{k}"))).otherwise(F.col(f"l{k}")))
    return write_table(grouped, "levels")


def _path() -> Column:
    """The siblings of node number i of a group on its way through the levels of the group."""
    at = lambda k: F.shiftright(F.col("i"), k)
    path = F.array(*[
        F.when(F.col("level") + k < F.col("depth"), F.struct(
            (at(k) % 2 == 1).alias("before"), F.get(f"l{k}", at(k).bitwiseXOR(F.lit(1))).alias("digest")))
        for k in range(STEP)])
    return F.filter(path, lambda s: s.isNotNull())


def _rows(grouped: DataFrame) -> DataFrame:
    """The node rows of groups, with their path and link."""
    return grouped.select("*", F.posexplode("held").alias("i", "own")).select(
        "tree", "depth", "level", "own.pos", "up", _path().alias("path"))


def _build(nodes: DataFrame, deepest: int, carried=()):
    """(groups, tops): the groups of every STEP levels, and the top of each tree."""
    groups, tops, level = [], None, 0
    while not groups or level < deepest:
        groups.append(_grouped(nodes, () if groups else carried))
        level += STEP
        above = groups[-1].select("tree", "depth", F.lit(level).alias("level"), F.col("up").alias("pos"),
                                  F.get(f"l{STEP}", F.lit(0)).alias("digest"))
        ended = above.where(F.col("depth") <= level).select("tree", "digest")
        tops = ended if tops is None else tops.unionByName(ended)
        nodes = above.where(F.col("depth") > level)
    return groups, tops


def _linked(rows: DataFrame, top_depth: int) -> DataFrame:
    """Node rows with the place that their path leads to."""
    over = F.col("level") + STEP >= F.col("depth")
    tree = F.when(~over, F.col("tree")).when((F.col("tree") != TOP) & F.lit(top_depth > 0), F.lit(TOP)).otherwise(F.lit(DONE))
    pos = F.when(~over, F.col("up")).when(F.col("tree") != TOP, F.col("tree") - 1).otherwise(F.lit(0))
    return rows.withColumns({
        "next_tree": tree.cast("long"), "next_level": F.when(over, F.lit(0)).otherwise(F.col("level") + STEP),
        "next_pos": pos.cast("long")}).drop("up")


def _block(tree, leaf_pos) -> Column:
    return F.shiftleft(tree, 40) + F.shiftright(leaf_pos, SPAN)


def _per_block(rows: DataFrame, trees: DataFrame, deepest: int, top_depth: int) -> DataFrame:
    """The node rows above the leaves with the block of leaves that they serve."""
    low = (F.col("tree") != TOP) & (F.col("level") < SPAN)
    inside = rows.where(low).withColumn(
        "block", F.shiftleft("tree", 40) + F.expr(f"shiftright(pos, {SPAN} - level)"))
    blocks = trees.select("tree", "depth", F.explode(
        F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, SPAN))).alias("b"))
    blocks = blocks.withColumn("block", F.shiftleft("tree", 40) + F.col("b"))
    ways = [F.struct(F.col("tree").alias("tree"), F.lit(level).alias("level"),
                     F.shiftright("b", level - SPAN).alias("pos")) for level in range(SPAN, deepest, STEP)]
    ways += [F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(level).alias("level"),
                      F.shiftright(F.col("tree") - 1, level).alias("pos")) for level in range(0, top_depth, STEP)]
    if not ways:
        return inside
    places = blocks.select("block", F.explode(F.array(*ways)).alias("w")).select("block", "w.*")
    return inside.unionByName(rows.where(~low).join(places, ["tree", "level", "pos"]))


SIBLINGS = "array<struct<before boolean, digest binary>>"
CLIMB = f"""
WITH RECURSIVE climb(home, number, block, tree, level, pos, path) AS (
  SELECT home, number, block, next_tree, next_level, next_pos, CAST(array() AS {SIBLINGS}) FROM {{groups}}
  UNION ALL
  SELECT c.home, c.number, c.block, n.next_tree, n.next_level, n.next_pos, concat(c.path, n.path)
  FROM climb c JOIN {{nodes}} n
    ON c.block = n.block AND c.tree = n.tree AND c.level = n.level AND c.pos = n.pos)
SELECT home, number, path AS climbed FROM climb WHERE tree = {DONE}"""


def _folded(start: Column, path: Column) -> Column:
    """The root that a hash gives with the siblings on its way."""
    none = F.lit("")
    return F.aggregate(path, start, lambda f, s: F.unhex(F.sha2(F.when(
        s["before"], F.concat(F.coalesce(_text(s["digest"]), none), _text(f))).otherwise(
        F.concat(_text(f), F.coalesce(_text(s["digest"]), none))), 256)))


@contextlib.contextmanager
def _any_number_of_rows(spark: SparkSession):
    """A recursive query stops at a million rows by default; a manifest has more."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def climb(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """home and number of each group of leaves, and climbed: the siblings on its way to the root."""
    return groups.sparkSession.sql(CLIMB, groups=groups, nodes=nodes)


def manifest(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per row of documents: doc_id, leaf, subroot, root, proof_sha256, folded_root and
    verified (folded_root equals root). tampered says which rows have n_chars raised by 1 when
    their proof is folded; a null n_chars stays null.

    Nulls are hashed as such; rows without lang make the first tree, rows without doc_id come
    first in theirs. Rows with equal lang and doc_id go by their leaf hash; equal rows are a leaf
    each. Texts of any length are hashed whole. Other columns are not read. An empty table gives
    no row."""
    spark = documents.sparkSession
    target = scratch_path(spark, "manifest")
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("decimal(38,0)")
    hashed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", leaf_hash().alias("digest"),
        F.when(changed & F.col("n_chars").isNotNull(), leaf_hash(n_chars=more)).alias("changed"))
    with scratch_scope(spark):
        placed = write_table(positions(hashed, ["doc_id", "digest"], ["lang"], documents.count()), "placed")
        trees = placed.groupBy("lang").agg(F.count("*").alias("n"))
        trees = positions(write_table(trees, "sizes"), ["lang"]).withColumnRenamed("position", "tree")
        trees = write_table(trees.withColumn("depth", _depth(F.col("n"))), "trees")
        count, deepest = trees.agg(F.count("*"), F.max("depth")).first()
        if not count:
            return spark.createDataFrame([], RESULT)
        top_depth = (count - 1).bit_length()
        own = trees.select(F.col("lang").alias("_lang"), "tree", "depth")
        leaves = placed.join(own, F.col("lang").eqNullSafe(F.col("_lang"))).select(
            "doc_id", "changed", "tree", "depth", F.lit(0).alias("level"),
            (F.col("position") - 1).alias("pos"), "digest")
        groups, tops = _build(leaves, deepest, ("doc_id", "changed"))
        tops = write_table(tops, "subroots")
        subroots = tops.select(F.lit(TOP).cast("long").alias("tree"), F.lit(top_depth).alias("depth"),
                               F.lit(0).alias("level"), (F.col("tree") - 1).alias("pos"), "digest")
        upper, roots = _build(subroots, top_depth)
        root = roots.first()["digest"]
        starts = _linked(groups[0].select("tree", "depth", "level", "up", F.col("tree").alias("home"),
                                          F.col("up").alias("number")), top_depth).select(
            "home", "number", _block(F.col("home"), F.shiftleft("number", STEP)).alias("block"),
            "next_tree", "next_level", "next_pos")
        above = reduce(DataFrame.unionByName, [_rows(g) for g in groups[1:] + upper])
        nodes = write_table(_per_block(_linked(above, top_depth), trees, deepest, top_depth), "nodes")
        with _any_number_of_rows(spark):
            ways = write_table(climb(write_table(starts, "starts"), nodes), "ways")
        subroot = tops.select(F.col("tree").alias("home"), F.col("digest").alias("_subroot"))
        held = groups[0].join(ways.join(subroot, "home"), (F.col("tree") == F.col("home")) & (F.col("up") == F.col("number")))
        path, own = F.concat(_path(), "climbed"), F.col("own")
        held.select("*", F.posexplode("held").alias("i", "own")).select(
            "_subroot", "own", path.alias("path"), _folded(F.coalesce(own["changed"], own["digest"]), path).alias("folded"),
        ).select(
            "own.doc_id", _text(own["digest"]).alias("leaf"), _text(F.col("_subroot")).alias("subroot"),
            F.lit(root.hex()).alias("root"),
            F.sha2(F.array_join(F.transform("path", lambda s: _text(s["digest"])), ""), 256).alias("proof_sha256"),
            _text(F.col("folded")).alias("folded_root"), (F.col("folded") == F.lit(root)).alias("verified"),
        ).write.parquet(target)
    return spark.read.schema(RESULT).parquet(target)


def chosen_for_tampering() -> Column:
    """Where 7 divides the unsigned crc32 of the decimal doc_id; never without a doc_id."""
    return F.col("doc_id").isNotNull() & fold(F.col("doc_id"), 7, 0)
