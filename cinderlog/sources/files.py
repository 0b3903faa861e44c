"""Batch scans of files."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderlog import schema
from cinderlog.operators.ranking import positions
from cinderlog.session import write_table


# Bits of a line_id for the line's number in its file, and splits whose places are broadcast.
LINE_BITS, BROADCAST_SPLITS = 40, 200_000


def _splits(scan: DataFrame) -> DataFrame:
    """Per file and split start: the task that reads it, its first row there, and the line_id of
    its first line. One row per split of the input."""
    row = F.col("_row")
    found = write_table(scan.groupBy("_file", "_start").agg(
        F.min(row).alias("_first"), F.max(row).alias("_last"), F.count("*").alias("_n")), "splits")
    names = found.groupBy("_file").agg(F.sum("_n").alias("_lines"))
    names = positions(names, ["_file"], rows=names.count()).select("_file", "position")
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.join(names, "_file").withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    base = F.shiftleft(F.col("position") - 1, LINE_BITS) + F.col("_before")
    return write_table(placed.select("_file", "_start", "_first", "_last", base.alias("_base")), "places")


def raw_lines(spark: SparkSession, path) -> DataFrame:
    """All files of a log directory as one scan: line_id, value.

    line_id is the number of the file among all file names in order, shifted, plus the number of
    the line in the file. It is a property of the files: the same for every scan and every split
    size. Adding files may renumber those whose names come later. A first scan counts the lines of
    every split; a scan whose splits are dealt to tasks otherwise (the settings were changed in
    between) raises an error, as do files of 2 ** 40 lines."""
    scan = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"))
    places = _splits(scan)
    if places.count() <= BROADCAST_SPLITS:
        places = F.broadcast(places)
    inside = F.col("_row").between(F.col("_first"), F.col("_last"))
    checked = F.when(inside, F.col("_base") + F.col("_row") - F.col("_first")).otherwise(
        F.raise_error(F.lit("the splits of the input have changed since its lines were counted")))
    return scan.join(places, ["_file", "_start"], "left").select(checked.cast("bigint").alias("line_id"), "value")


def spread(scan: DataFrame, key=None) -> DataFrame:
    """Spread the rows of a scan that has fewer tasks than there are cores, such as one of
    a single small file, over the cores. A scan with enough tasks is left as it is.

    With the name of a unique key, so are those of a scan whose largest task has more than 1.5
    times a core's share: Spark cuts a table by bytes into about a split a core, but a split without
    the middle of a row group reads nothing. The rows are counted from the files' footers."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    tasks = scan.rdd.getNumPartitions()
    if tasks < cores:
        return scan.repartition(cores)
    if key is not None and tasks < 2 * cores:
        rows = [r["count"] for r in scan.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        if max(rows, default=0) * cores > 1.5 * sum(rows):
            return scan.repartition(2 * cores, key)
    return scan


# Bytes of text that a task takes at a time to count its words: what it holds stays in memory.
DEALT_BYTES = 8 << 20


def dealt(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Rows dealt out by a unique key, about DEALT_BYTES of text to a task and a task to a core at
    least. What is then counted per key and word needs no further shuffle, and words outweigh texts."""
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-size // DEALT_BYTES)), key)


def structured_parquet(spark: SparkSession, path) -> DataFrame:
    """Structured logs with their partition column log_day."""
    return spark.read.schema(schema.STORED).parquet(path)


def structured_csv(spark: SparkSession, path) -> DataFrame:
    """Structured logs from CSV with a header; parameters travel as a JSON list."""
    flat = [
        f"{f.name} {'string' if f.name == 'parameters' else f.dataType.simpleString()}"
        for f in schema.STRUCTURED.fields
    ]
    rows = spark.read.schema(", ".join(flat)).option("header", True).option("escape", '"').csv(path)
    return rows.withColumn("parameters", F.from_json("parameters", "array<string>"))


def label_csv(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(schema.LABELS).option("header", True).csv(path)
