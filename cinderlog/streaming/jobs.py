"""Queries over unbounded input.

Sinks that are not append-only write each micro-batch to its own folder batch_id=N, which
appears when it is complete (streaming/batches.py): a batch that is replayed after a failure adds
nothing, and readers never see half of one.
"""

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog import schema
from cinderlog.functions.envelope import to_envelope
from cinderlog.functions.ratios import throughput
from cinderlog.operators.parse import accepted, parse_header, rejected
from cinderlog.operators.series import batch_points, count_points, level_counts, newest
from cinderlog.operators.templates import assign_templates, with_shape
from cinderlog.session import put_text, read_text, remove, scratch_scope, write_table
from cinderlog.sources.sinks import with_day
from cinderlog.streaming.batches import batch_ids, compact, pointer, publish, read_batches
from cinderlog.streaming.catalogue import known_templates, learn


def stream_session(spark: SparkSession, partitions=None) -> SparkSession:
    """A session for streams. State is split over a fixed number of partitions that AQE
    cannot merge, so it is set to the cores at hand rather than to the batch value."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set(
        "spark.sql.shuffle.partitions", partitions or spark.sparkContext.defaultParallelism
    )
    return session


def start(writer, trigger=None):
    """trigger: a processing-time interval, or None to take what is there and stop."""
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def folder_sink(path):
    """Publishes each batch's messages as text in the batch's folder, whole and once."""

    def put(messages: DataFrame, batch_id: int):
        publish(messages.sparkSession, path, batch_id, messages.write.text)

    return put


def topic_sink(servers, topic):
    """Publishes to a topic, at least once. Needs the Kafka connector jar."""

    def put(messages: DataFrame, batch_id: int):
        (
            messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).save()
        )

    return put


def with_place(lines: DataFrame) -> DataFrame:
    """Adds the task that reads a line and the line's row in it."""
    running = F.monotonically_increasing_id()
    return lines.withColumns(
        {"_task": F.shiftright(running, 33), "_row": running.bitwiseAND(F.lit((1 << 33) - 1))}
    )


def numbered_lines(batch: DataFrame, first: int) -> DataFrame:
    """line_id: running numbers from first on, without gaps, however many tasks read the batch
    and however uneven they are. Places that are there already are kept."""
    placed = batch if "_task" in batch.columns else with_place(batch)
    # One row per task goes through the window.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = placed.groupBy("_task").agg(F.count("*").alias("_n")).select(
        "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return placed.join(shifts, "_task").withColumn(
        "line_id", F.lit(first).cast("bigint") + F.col("_before") + F.col("_row")
    ).drop("_task", "_row", "_before")


def first_number(spark: SparkSession, out, batch_id: int) -> int:
    """The number of lines in the batches before this one."""
    if batch_id == 0:
        return 0
    held = read_text(spark, f"{out}/numbering/{batch_id - 1}")
    if held is None:
        raise ValueError(f"{out}/numbering does not say how many lines came before batch {batch_id}")
    return int(held)


def keep_number(spark: SparkSession, out, batch_id: int, following: int) -> None:
    """Notes the first number after a batch. The note of the batch before stays for a replay."""
    put_text(spark, f"{out}/numbering/{batch_id}", str(following))
    remove(spark, f"{out}/numbering/{batch_id - 2}")


def structure_stream(lines: DataFrame, out, checkpoint, trigger=None, masks=K.MASKS,
                     depth=K.MINING_DEPTH, similarity=K.MINING_SIMILARITY,
                     rows_sink=None, metrics_sink=None):
    """Raw lines (column value) -> messages of structured rows and of batch metrics, plus
    rejected lines and the growing template catalogue under out. An empty batch has metrics too."""
    rows_sink = rows_sink or folder_sink(f"{out}/structured")
    metrics_sink = metrics_sink or folder_sink(f"{out}/metrics")

    def structured(parsed: DataFrame, batch_id: int, first: int):
        spark = parsed.sparkSession
        numbered = parsed if "line_id" in parsed.columns else numbered_lines(parsed, first)
        good = accepted(numbered)
        with scratch_scope(spark):
            known = known_templates(spark, f"{out}/catalogue", before=batch_id)
            news = learn(good, known, depth, similarity)
            if not news.isEmpty():
                publish(spark, f"{out}/catalogue", batch_id, news.write.parquet)
                known = known_templates(spark, f"{out}/catalogue", before=batch_id + 1)
            catalogue = write_table(known.select("shape", "pattern"), "catalogue")
            rows = assign_templates(good, catalogue).select(*schema.STRUCTURED.fieldNames())
            rows_sink(to_envelope(rows), batch_id)
        publish(spark, f"{out}/rejects", batch_id, rejected(numbered).write.parquet)

    def process(batch: DataFrame, batch_id: int):
        begun = time.time()
        spark = batch.sparkSession
        given = "line_id" in batch.columns
        parsed = with_shape(parse_header(batch if given else with_place(batch)), masks).persist()
        try:
            n = parsed.count()
            first = 0 if given else first_number(spark, out, batch_id)
            if n:
                structured(parsed, batch_id, first)
            if not given:
                keep_number(spark, out, batch_id, first + n)
        finally:
            parsed.unpersist()
        seconds = time.time() - begun
        metrics = spark.range(1).coalesce(1).select(
            F.lit(str(batch_id)).alias("batch_id"),
            F.lit(n).cast("bigint").alias("record_count"),
            F.lit(seconds).alias("latency"),
            throughput(F.lit(float(n)), F.lit(seconds)).alias("throughput"),
            F.lit(begun).alias("timestamp"),
        )
        metrics_sink(to_envelope(metrics), batch_id)

    return start(
        lines.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint), trigger
    )


def archive_stream(structured: DataFrame, path, checkpoint, trigger=None):
    """Structured rows -> Parquet by day, appended exactly once by the file sink."""
    writer = (
        with_day(structured).writeStream.format("parquet").outputMode("append")
        .partitionBy("log_day").option("path", path).option("checkpointLocation", checkpoint)
    )
    return start(writer, trigger)


def windowed_counts(structured: DataFrame, time="event", watermark=None) -> DataFrame:
    """Counts per minute and level. time "processing" counts by arrival; "event" by log
    time, and then a watermark (a delay such as "10 minutes") bounds the state."""
    if time == "processing":
        return level_counts(structured.withColumn("arrival", F.current_timestamp()), "arrival")
    if watermark is not None:
        structured = structured.withWatermark("event_time", watermark)
    return level_counts(structured)


def counts_stream(counts: DataFrame, path, checkpoint, trigger=None):
    """Update mode: the windows a batch touched, as messages in the batch's folder."""
    sink = folder_sink(path)
    writer = counts.writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: sink(to_envelope(batch), batch_id)
    )
    return start(writer.option("checkpointLocation", checkpoint), trigger)


def counts_topic(counts: DataFrame, servers, topic, checkpoint, trigger="1 minute"):
    """The same to a topic. Needs the Kafka connector jar."""
    writer = (
        to_envelope(counts).writeStream.format("kafka").outputMode("update")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
    )
    return start(writer.option("checkpointLocation", checkpoint), trigger)


_KEPT_COUNTS = [*schema.LEVEL_COUNTS.fieldNames(), "batch_id"]


def _count_updates(spark: SparkSession, path) -> tuple:
    """(updates with their batch, pointer): the newest snapshot and the batches behind it."""
    at = pointer(spark, path)
    fields = F.from_json("value", schema.LEVEL_COUNTS).alias("row")
    news = read_batches(spark, path, at, lambda folders: spark.read.schema("value string, batch_id bigint").option(
        "basePath", str(path)).text(folders).select("batch_id", fields).select("row.*", "batch_id"))
    kept = spark.createDataFrame([], schema.LEVEL_COUNTS).withColumn("batch_id", F.lit(-1).cast("bigint"))
    if at is not None:
        kept = spark.read.schema(kept.schema).parquet(at.folder)
    return (kept if news is None else kept.unionByName(news)).select(*_KEPT_COUNTS), at


def current_counts(spark: SparkSession, path) -> DataFrame:
    """What the update messages amount to: the newest row per window end and level. Reads the
    newest snapshot and the batches behind it."""
    updates, _ = _count_updates(spark, path)
    return newest(updates, ["window_end", "log_level"])


def compact_counts(spark: SparkSession, path):
    """Fold the update messages into a snapshot; its pointer, or None if there are none. Batches
    that the snapshot before already held are deleted, so run it no more often than other readers
    of the folder (points, for one) need to have read them."""
    ids = batch_ids(spark, path)
    updates, at = _count_updates(spark, path)
    if not ids and at is None:
        return None
    upto = max([*ids, -1 if at is None else at.upto])
    state = newest(updates.where(F.col("batch_id") <= upto), ["window_end", "log_level"])
    return compact(spark, path, state.withColumn("batch_id", F.lit(upto).cast("bigint")).coalesce(1)
                   .select(*_KEPT_COUNTS), upto)


def points_stream(messages: DataFrame, kind, path, checkpoint, trigger=None):
    """Count or batch-metric messages -> line protocol text, one folder per batch. Points
    with the same tags and time overwrite each other in the store that loads them."""
    fields, points = {
        "counts": (schema.LEVEL_COUNTS, count_points),
        "batches": (schema.BATCH_METRICS, batch_points),
    }[kind]
    rows = messages.select(F.from_json("value", fields).alias("row")).select("row.*")

    sink = folder_sink(path)
    writer = rows.writeStream.foreachBatch(
        lambda batch, batch_id: sink(points(batch).where("value IS NOT NULL"), batch_id)
    )
    return start(writer.option("checkpointLocation", checkpoint), trigger)


def replay_stream(lines: DataFrame, path, checkpoint, trigger=None):
    """Copies a stream of lines into a directory that other streams watch."""
    writer = (
        lines.select("value").writeStream.format("text").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return start(writer, trigger)


def console_stream(rows: DataFrame, checkpoint, trigger=None):
    """Prints each batch, for a look at a stream."""
    writer = rows.writeStream.format("console").option("checkpointLocation", checkpoint)
    return start(writer, trigger)


def live(lines: DataFrame, rows, out, checkpoint, trigger="0 seconds", archive_every="30 minutes",
         count_every="1 minute", count_rows=None, counts_to=None, **options):
    """Structuring, archive and counts as three queries of one application. rows() gives a
    new reader of what the first query publishes, for the archive; count_rows() the one for the
    counts, with limits of its own (the same if not given). counts_to: (servers, topic) to publish
    counts to, instead of a folder."""
    counts = windowed_counts((count_rows or rows)(), "processing")
    queries = [
        structure_stream(lines, out, f"{checkpoint}/structure", trigger, **options),
        archive_stream(rows(), f"{out}/archive", f"{checkpoint}/archive", archive_every),
    ]
    if counts_to:
        return [*queries, counts_topic(counts, *counts_to, f"{checkpoint}/counts", count_every)]
    return [*queries, counts_stream(counts, f"{out}/counts", f"{checkpoint}/counts", count_every)]


def run_to_end(query):
    """Wait for an available-now query; raises what the query raised."""
    query.awaitTermination()
    return query
