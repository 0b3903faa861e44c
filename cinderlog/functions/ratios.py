"""Guarded arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def throughput(records: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, records / seconds).otherwise(F.lit(0.0))


def mebibytes_per_second(size: Column, nanos: Column) -> Column:
    """Null when the duration is zero or missing."""
    return F.try_divide(size / F.lit(1024.0 * 1024.0), nanos / F.lit(1e9))


def classification_metrics(tp: Column, fp: Column, tn: Column, fn: Column) -> dict:
    precision = ratio_or_zero(tp, tp + fp)
    recall = ratio_or_zero(tp, tp + fn)
    return {
        "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "f1": ratio_or_zero(2 * precision * recall, precision + recall),
    }
