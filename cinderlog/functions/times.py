"""Time functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(text: Column, *spans) -> Column:
    """The given (start, length) spans of a text if they hold digits only, else null."""
    joined = F.concat(*[F.substring(text, start, length) for start, length in spans])
    return F.when(joined.try_cast("int").isNotNull(), joined)


def _iso_date(date: Column) -> Column:
    six = F.concat(F.lit("20"), _digits(date, (1, 6)))
    ten = _digits(date, (1, 4), (6, 2), (9, 2))
    dashed = (F.substring(date, 5, 1) == "-") & (F.substring(date, 8, 1) == "-")
    digits = F.when(F.length(date) == 6, six).when((F.length(date) == 10) & dashed, ten)
    return F.concat(
        F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2), F.lit("-"), F.substring(digits, 7, 2)
    )


def _iso_time(time: Column) -> Column:
    colons = (F.substring(time, 3, 1) == ":") & (F.substring(time, 6, 1) == ":")
    digits = F.when(F.length(time) == 6, _digits(time, (1, 6))).when(
        (F.length(time) == 8) & colons, _digits(time, (1, 2), (4, 2), (7, 2))
    )
    return F.concat(
        F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2), F.lit(":"), F.substring(digits, 5, 2)
    )


def log_timestamp(date: Column, time: Column) -> Column:
    """Header date (yyMMdd or yyyy-MM-dd) and time (HHmmss or HH:mm:ss) as an instant;
    null when either is malformed."""
    return F.concat(_iso_date(date), F.lit(" "), _iso_time(time)).try_cast("timestamp")


def log_day(date: Column) -> Column:
    return _iso_date(date).try_cast("date")


def month_key(date: Column) -> Column:
    return F.date_format(log_day(date), "yyyyMM")


def iso_instant(text: Column) -> Column:
    """Text such as 2024-01-01T00:01:00.000Z."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))


def epoch_instant(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * 1000000).cast("bigint"))
