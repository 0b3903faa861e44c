"""Rows to and from one JSON string, the form in which they travel through topics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_envelope(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def from_envelope(df: DataFrame, schema) -> DataFrame:
    return df.select(
        F.from_json(F.col("value").cast("string"), schema).alias("row")
    ).select("row.*")
