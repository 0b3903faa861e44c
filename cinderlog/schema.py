"""Explicit schemas of every table that is read or written; nothing is inferred."""

from pyspark.sql import types as T


def _struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _long, _int = T.StringType(), T.LongType(), T.IntegerType()
_double, _time, _texts = T.DoubleType(), T.TimestampType(), T.ArrayType(T.StringType())

RAW = _struct(line_id=_long, value=_text)

HEADER = _struct(
    line_id=_long,
    log_date=_text,
    log_time=_text,
    pid=_text,
    log_level=_text,
    component=_text,
    content=_text,
    event_time=_time,
)

STRUCTURED = T.StructType(
    HEADER.fields
    + _struct(event_id=_text, event_template=_text, parameters=_texts).fields
)

STORED = T.StructType(STRUCTURED.fields + _struct(log_day=T.DateType()).fields)

LABELS = _struct(BlockId=_text, Label=_text)

BATCH_METRICS = _struct(
    batch_id=_text, record_count=_long, latency=_double, throughput=_double, timestamp=_double
)

LEVEL_COUNTS = _struct(
    window_start=_time,
    window_end=_time,
    log_level=_text,
    event_count=_long,
    orig_first_timestamp=_time,
    orig_last_timestamp=_time,
)

# pattern is the template of the shape, skeleton what the shape itself has seen.
CATALOGUE = _struct(shape=_text, skeleton=_text, pattern=_text)
