"""The template catalogue of a stream: what each batch adds or changes, and snapshots.

A shape's skeleton only ever widens, and templates follow from the set of skeletons of a leaf. So
the catalogue after some lines is the same however they were cut into batches, and the same as
that of mining them at once.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog import schema
from cinderlog.operators.templates import assign_templates, leaf_key, merge_similar, skeletons, with_shape
from cinderlog.session import write_table
from cinderlog.streaming.batches import batch_ids, compact, pointer, read_batches

_STORED = "shape string, skeleton string, pattern string, batch_id bigint"


def known_templates(spark: SparkSession, path, before: int | None = None, version: int | None = None) -> DataFrame:
    """Newest row of each shape: of the newest snapshot (or of a version) and the batches behind
    it, up to the batch before. A version alone is the catalogue as it was published."""
    at = pointer(spark, path, version)
    if version is not None and at is None:
        raise ValueError(f"there is no catalogue version {version}")
    rows = spark.createDataFrame([], _STORED) if at is None else spark.read.schema(_STORED).parquet(at.folder)
    if version is None:
        more = read_batches(spark, path, at, lambda folders: spark.read.schema(_STORED).option(
            "basePath", str(path)).parquet(*folders), before)
        rows = rows if more is None else rows.unionByName(more)
    return rows.groupBy("shape").agg(
        F.max_by(F.struct("skeleton", "pattern"), "batch_id").alias("row")).select("shape", "row.*")


def widen(pattern, skeleton):
    """Hide the tokens in which a new skeleton differs from its shape's skeleton so far."""
    return F.array_join(
        F.zip_with(
            F.split(pattern, " "), F.split(skeleton, " "),
            lambda p, s: F.when(p == s, p).otherwise(F.lit(K.WILDCARD)),
        ), " ",
    )


def _templates_of(state: DataFrame, depth, similarity) -> DataFrame:
    """shape, skeleton, template of a table of shapes and skeletons."""
    mapping = merge_similar(state.select(F.col("skeleton").alias("pattern")).distinct(), depth, similarity)
    return state.join(mapping, state["skeleton"] == mapping["pattern"]).select("shape", "skeleton", "template")


def learn(lines: DataFrame, known: DataFrame, depth=K.MINING_DEPTH,
          similarity=K.MINING_SIMILARITY) -> DataFrame:
    """Catalogue rows that a batch of lines adds or changes: none, once the statements of
    the log are known. New or wider skeletons give their leaf new templates, and every shape
    whose template changes gets a row; its older lines still match."""
    fresh = write_table(skeletons(lines).select("shape", F.col("skeleton").alias("seen")), "skeletons")
    known = write_table(known, "known")
    old, seen = F.col("skeleton"), F.col("seen")
    state = known.join(fresh, "shape", "full_outer").select(
        "shape", F.col("skeleton").alias("before"), F.col("pattern").alias("old_pattern"),
        F.when(old.isNull(), seen).when(seen.isNull(), old).otherwise(widen(old, seen)).alias("skeleton"))
    leaf = leaf_key(F.col("skeleton"), depth)
    changed = write_table(state.where(F.col("before").isNull() | (F.col("before") != F.col("skeleton"))).select(
        leaf.alias("leaf")).distinct(), "changed")
    if changed.isEmpty():
        return known.limit(0)
    touched = write_table(state.withColumn("leaf", leaf).join(changed, "leaf", "left_semi"), "touched")
    found = _templates_of(touched.select("shape", "skeleton"), depth, similarity)
    before = touched.select("shape", "before", "old_pattern")
    news = found.join(before, "shape").where(
        ~F.col("before").eqNullSafe(F.col("skeleton")) | ~F.col("old_pattern").eqNullSafe(F.col("template")))
    return write_table(news.select("shape", "skeleton", F.col("template").alias("pattern")), "news")


def publish_templates(spark: SparkSession, path, depth=K.MINING_DEPTH, similarity=K.MINING_SIMILARITY):
    """Mine the templates of all shapes anew and publish them as the next version; its pointer.
    None if nothing was learnt so far. depth and similarity may differ from the stream's; leaves that
    change later are mined with the stream's own."""
    at, ids = pointer(spark, path), batch_ids(spark, path)
    if at is None and not ids:
        return None
    upto = max([*ids, -1 if at is None else at.upto])
    known = write_table(known_templates(spark, path, before=upto + 1), "known")
    mined = _templates_of(known.select("shape", "skeleton"), depth, similarity)
    rows = mined.select("shape", "skeleton", F.col("template").alias("pattern"), F.lit(upto).cast("long").alias("batch_id"))
    return compact(spark, path, rows, upto)


def restated(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Structured rows with the templates, ids and parameters of a catalogue: rows of older
    batches carry the templates that were known when they came."""
    plain = rows.drop("event_id", "event_template", "parameters")
    return assign_templates(with_shape(plain), catalogue.select("shape", "pattern")).select(*rows.columns)
