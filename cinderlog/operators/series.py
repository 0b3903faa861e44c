"""Windowed counts, dashboard series and time-series points."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog.functions.points import float_field, integer_field, point
from cinderlog.functions.times import epoch_instant


def level_counts(structured: DataFrame, time="event_time", width="1 minute") -> DataFrame:
    """Events per tumbling window and level with the first and last log time. Works on
    batch and streaming frames alike."""
    return structured.groupBy(F.window(time, width), "log_level").agg(
        F.count("*").alias("event_count"),
        F.min("event_time").alias("orig_first_timestamp"),
        F.max("event_time").alias("orig_last_timestamp"),
    ).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "log_level", "event_count", "orig_first_timestamp", "orig_last_timestamp",
    )


def newest(updates: DataFrame, keys, version="batch_id") -> DataFrame:
    """The last update of each key: what a store keyed by tag and time would hold."""
    rest = [c for c in updates.columns if c not in keys and c != version]
    return updates.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.col(version)).alias("_row")
    ).select(*keys, "_row.*")


def count_points(counts: DataFrame) -> DataFrame:
    return counts.select(
        point(
            K.COUNT_MEASUREMENT, {"level": F.col("log_level")},
            {"event_count": integer_field(F.col("event_count"))}, F.col("window_end"),
        ).alias("value")
    )


def batch_points(metrics: DataFrame) -> DataFrame:
    fields = {
        "record_count": integer_field(F.col("record_count")),
        "latency": float_field(F.col("latency")),
        "throughput": float_field(F.col("throughput")),
    }
    line = point(
        K.BATCH_MEASUREMENT, {"batch_id": F.col("batch_id")}, fields, epoch_instant(F.col("timestamp"))
    )
    return metrics.select(line.alias("value"))


def in_range(series: DataFrame, time: str, start, end) -> DataFrame:
    """Rows with start <= time <= end: a panel that ends now shows the newest point."""
    return series.where((F.col(time) >= start) & (F.col(time) <= end))


def latest_per_level(counts: DataFrame) -> DataFrame:
    seen = counts.where(F.col("event_count").isNotNull())
    return seen.groupBy("log_level").agg(
        F.max("window_end").alias("window_end"),
        F.max_by("event_count", "window_end").alias("event_count"),
    )


def count_trend(counts: DataFrame, start, end) -> DataFrame:
    """Count per level over a time range, ordered for drawing."""
    return in_range(counts, "window_end", start, end).select(
        "log_level", "window_end", "event_count"
    ).orderBy("log_level", "window_end")


def mean_per_interval(series: DataFrame, time: str, fields, start: int, end: int,
                      seconds: int) -> DataFrame:
    """Mean of each field per bucket of the given length between two epoch seconds, with
    a row of nulls for each empty bucket. Buckets come from a distributed range."""
    first = start - start % seconds
    axis = series.sparkSession.range(first, end, seconds).withColumnRenamed("id", "bucket")
    stamp = F.unix_seconds(time)
    bucket = stamp - F.pmod(stamp, F.lit(seconds))
    means = series.where((stamp >= start) & (stamp < end)).groupBy(bucket.alias("bucket")).agg(
        *[F.avg(f).alias(f"mean_{f}") for f in fields]
    )
    return axis.join(means, "bucket", "left").select(
        F.timestamp_seconds("bucket").alias("interval_start"), *[f"mean_{f}" for f in fields]
    )
