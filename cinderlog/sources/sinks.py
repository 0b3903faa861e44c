"""Batch writers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog.functions.envelope import to_envelope


def with_day(df: DataFrame) -> DataFrame:
    """Adds log_day, the partition column: a day of event_time, or null. The header's date
    itself is free text, and would give a folder per odd value."""
    return df.withColumn("log_day", F.to_date("event_time"))


def write_structured(df: DataFrame, path, mode="overwrite"):
    """Parquet by day. The rebalance hint lets AQE split a heavy day over many files of
    normal size and merge light ones; sorted by event, a report on one template skips
    most row groups."""
    balanced = with_day(df).hint("rebalance", F.col("log_day"))
    sorted_rows = balanced.sortWithinPartitions("log_day", "event_id")
    sorted_rows.write.mode(mode).partitionBy("log_day").parquet(path)


def write_report(df: DataFrame, path, single_file=True):
    """CSV with a header. A single file suits aggregated reports only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path):
    """CSV export of rows with arrays: arrays become JSON text."""
    cols = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_topic(df: DataFrame, servers, topic):
    """Rows as JSON messages. Needs the Kafka connector jar."""
    (
        to_envelope(df).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )


def write_messages(df: DataFrame, path, mode="append"):
    """Rows as JSON lines: the file form of a topic."""
    to_envelope(df).write.mode(mode).text(path)
