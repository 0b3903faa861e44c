"""The six reports over structured logs. Each returns a frame; writing is separate."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog.functions.ratios import mebibytes_per_second
from cinderlog.functions.text import endpoint, first_integer, host, item, named_number, port, strip_marks
from cinderlog.functions.text import first_block_id
from cinderlog.functions.times import month_key
from cinderlog.sources.sinks import write_report


# Templates of one statement that go into the scan's filter; beyond that they are joined.
PUSHED_TEMPLATES = 100


def _of_statement(structured: DataFrame, template, fixed_words: str) -> DataFrame:
    """Lines of the given template; without one, lines of the templates that have the statement's
    fixed words. These are found among the distinct templates, a scan of one column, and go into
    the scan of the lines as a filter, by which files sorted by event are skipped."""
    if template is not None:
        return structured.where(F.col("event_template") == template)
    named = structured.select("event_template").where(F.col("event_template").like(fixed_words)).distinct()
    found = [r["event_template"] for r in named.limit(PUSHED_TEMPLATES + 1).collect()]
    if len(found) > PUSHED_TEMPLATES:
        return structured.join(named, "event_template", "left_semi")
    return structured.where(F.col("event_template").isin(found))


def severity(structured: DataFrame, levels=K.LEVELS) -> DataFrame:
    """One row with a count per level."""
    return structured.agg(
        *[F.count_if(F.col("log_level") == level).alias(level.lower()) for level in levels]
    )


def exceptions(structured: DataFrame, templates=(K.IO_EXCEPTION, K.PERMISSION_DENIED)) -> DataFrame:
    """Exceptions per day, latest day first."""
    return (
        structured.where(F.col("event_template").isin(*templates))
        .groupBy("log_date").agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("log_date"))
    )


def write_latency(structured: DataFrame, template=K.SLOW_WRITE) -> DataFrame:
    """Mean of the first integer among the parameters of slow writes."""
    cost = first_integer(F.array_join("parameters", " "))
    return structured.where(F.col("event_template") == template).agg(
        F.avg(cost).alias("average_write_latency")
    )


def transfer_speed(structured: DataFrame, template=None) -> DataFrame:
    """Per write record: source, destination and speed in MiB/s (text with two decimals,
    and the number). Values are read by name from the content."""
    content = F.col("content")
    rate = mebibytes_per_second(named_number(content, "bytes"), named_number(content, "duration"))
    return _of_statement(structured, template, K.TRANSFER_WORDS).select(
        "line_id",
        strip_marks(endpoint(content, K.SOURCE)).alias("src"),
        strip_marks(endpoint(content, K.DESTINATION)).alias("dest"),
        F.format_number(rate, 2).alias("speed"),
        rate.alias("speed_mib_s"),
    )


def retries(structured: DataFrame, template=None, param_index=None) -> DataFrame:
    """Histogram of the retry count: the number after "Already tried", or the parameter at
    param_index."""
    if param_index is None:
        count = F.regexp_extract("content", r"Already tried (\d+) time", 1).try_cast("int")
    else:
        count = first_integer(item(F.col("parameters"), param_index))
    return (
        _of_statement(structured, template, K.CONNECT_RETRY_WORDS)
        .groupBy(count.alias("retrycount")).agg(F.count("*").alias("event_count"))
        .orderBy(F.desc("event_count"), "retrycount")
    )


def monthly_severity(structured: DataFrame) -> DataFrame:
    """Records and distinct events per level and month."""
    return (
        structured.groupBy("log_level", month_key(F.col("log_date")).alias("month"))
        .agg(
            F.count("event_id").alias("total_records"),
            F.count_distinct("event_id").alias("distinct_eventid"),
        )
        .orderBy("log_level", F.desc("distinct_eventid"), F.desc("total_records"))
    )


def block_endpoints(structured: DataFrame) -> DataFrame:
    """Adds first block id, source and destination with their hosts and ports."""
    content = F.col("content")
    found = structured.select(
        "*",
        first_block_id(content).alias("first_block_id"),
        endpoint(content, K.SOURCE).alias("source"),
        endpoint(content, K.DESTINATION).alias("destination"),
    )
    return found.select(
        "*",
        host(F.col("source")).alias("source_ip"),
        port(F.col("source")).alias("source_port"),
        host(F.col("destination")).alias("destination_ip"),
        port(F.col("destination")).alias("destination_port"),
    )


# Reports that take a template.
CHOICES = ("exceptions", "slowness", "speed", "retrycount")


def write_all(structured: DataFrame, path, templates=None):
    """Every report as CSV under path. templates: report -> template to use in place of the
    usual one. The speed report has a row per line, so it keeps its files; the others are one
    file each."""
    t = templates or {}
    for name, report in {
        "exceptions": exceptions(structured, (t["exceptions"],)) if "exceptions" in t else exceptions(structured),
        "severity": severity(structured),
        "slowness": write_latency(structured, t.get("slowness", K.SLOW_WRITE)),
        "speed": transfer_speed(structured, t.get("speed")),
        "retrycount": retries(structured, t.get("retrycount")),
        "monthly": monthly_severity(structured),
    }.items():
        write_report(report, f"{path}/{name}", single_file=name != "speed")
