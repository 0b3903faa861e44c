"""Header parsing: raw line -> typed columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog.functions.times import log_timestamp

# Date, time and process, level, then a component that is not empty and ends in a colon.
HEADER = r"(?s)^\S+\s+[^,\s]+,\S+\s+\S+\s+(?!:\s)\S.*?:\s"


def parse_header(lines: DataFrame) -> DataFrame:
    """<Date> <Time>,<PID> <Level> <Component>: <Content>. Adds the header columns,
    event_time and is_valid; other columns pass through. One pattern tells whether a line
    is valid, so that the filter on it runs at the scan; two splits read all fields."""
    value = F.coalesce("value", F.lit(""))
    cut = lines.withColumns({"is_valid": value.rlike(HEADER), "_head": F.split(value, r"\s+", 4)})
    cut = cut.withColumn("_tail", F.split(F.get("_head", F.lit(3)), r":\s+", 2))
    stamp = F.get("_head", F.lit(1))
    cut = cut.withColumns(
        {
            "log_date": F.get("_head", F.lit(0)),
            "log_time": F.substring_index(stamp, ",", 1),
            "pid": F.substring(stamp, F.instr(stamp, ",") + 1, F.length(stamp)),
            "log_level": F.get("_head", F.lit(2)),
            "component": F.get("_tail", F.lit(0)),
            "content": F.get("_tail", F.lit(1)),
        }
    )
    time = log_timestamp(F.col("log_date"), F.col("log_time"))
    return cut.withColumn("event_time", time).drop("_head", "_tail")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_valid").drop("is_valid", "value")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where("NOT is_valid").select("line_id", "value")
