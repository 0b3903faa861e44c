"""Rows as time-series points in line protocol."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIAL = r"([,= ])"


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, _SPECIAL, r"\\$1")


def integer_field(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("i"))


def float_field(value: Column) -> Column:
    return value.cast("double").cast("string")


def point(measurement: str, tags: dict, fields: dict, time: Column) -> Column:
    """One line: measurement,tags fields nanoseconds. Fields are rendered text, in name
    order; a null field is left out, and a row without any field or time gives null."""
    head = [F.lit(measurement)] + [
        F.when(tags[k].isNotNull() & (tags[k] != ""), F.concat(F.lit(f"{k}="), _escaped(tags[k])))
        for k in sorted(tags)
    ]
    body = F.concat_ws(",", *[F.concat(F.lit(f"{k}="), fields[k]) for k in sorted(fields)])
    nanos = (F.unix_micros(time) * 1000).cast("string")
    line = F.concat(F.concat_ws(",", *head), F.lit(" "), body, F.lit(" "), nanos)
    return F.when(body != "", line)
