"""Train/test splits. Both return one condition; train and test are two filters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog.operators.ranking import rows_at, up_to


def _not_after(bound):
    order = ["split_key", "block_id"]
    return up_to(order, bound and dict(zip(order, bound)))


def split_condition(sessions: DataFrame, ratio: float, split_type: str, window="session"):
    """(keyed sessions, condition that holds for training rows). Sequential: the first
    floor(n * ratio) sessions by first event time. Uniform: that share of each label, in
    the order of a hash of the block id, which is random but repeatable."""
    if window != "session":
        raise ValueError("only session windows are supported")
    if split_type == "sequential":
        keyed = sessions.withColumn("split_key", F.coalesce(F.unix_micros("first_time"), F.lit(0)))
        bound = rows_at(keyed, F.col("split_key"), "block_id", ratio).get(None)
        return keyed, _not_after(bound)
    if split_type == "uniform" and "label" in sessions.columns:
        # 60 bits of the hash; equal ones go by block id
        keyed = sessions.withColumn("split_key", F.conv(F.left(F.md5("block_id"), F.lit(15)), 16, 10).cast("bigint"))
        bounds = rows_at(keyed, F.col("split_key"), "block_id", ratio, "label")
        train = F.lit(False)
        for label in (0, 1):
            train = train | ((F.col("label") == label) & _not_after(bounds.get(label)))
        return keyed, train
    raise ValueError("split_type must be 'uniform' (with labels) or 'sequential'")


def split_sessions(sessions: DataFrame, ratio=0.5, split_type="sequential", window="session"):
    """(train, test): disjoint, and together all sessions."""
    keyed, condition = split_condition(sessions, ratio, split_type, window)
    helper = [c for c in keyed.columns if c not in sessions.columns]
    return keyed.where(condition).drop(*helper), keyed.where(~condition).drop(*helper)


def flag_sessions(sessions: DataFrame, ratio=0.5, split_type="sequential", window="session"):
    """All sessions with is_train."""
    keyed, condition = split_condition(sessions, ratio, split_type, window)
    helper = [c for c in keyed.columns if c not in sessions.columns]
    return keyed.withColumn("is_train", condition).drop(*helper)


def shuffle_key(key: str, seed=0):
    """A hash that puts rows in random but repeatable order."""
    return F.md5(F.concat(F.col(key), F.lit(f"#{seed}")))


def repeatable_shuffle(df: DataFrame, key: str, seed=0) -> DataFrame:
    """Rows in that order; a range shuffle, not one task."""
    return df.orderBy(shuffle_key(key, seed), key)


def first_rows(df: DataFrame, order, n: int) -> DataFrame:
    """Head of the data by an explicit order (top-k per partition, then merged)."""
    return df.orderBy(*order).limit(n)


def distinct_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of left that are not in right, without duplicates."""
    return left.subtract(right)
