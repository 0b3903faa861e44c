"""Block sessions: the ordered events of each storage block."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog.functions.text import block_ids
from cinderlog.operators.ranking import numbered, with_halo
from cinderlog.session import write_table

PART_SIZE = 100_000


def block_events(structured: DataFrame) -> DataFrame:
    """One row per line and distinct block id in it."""
    return structured.where(F.col("content").contains("blk_")).select(
        F.explode(block_ids(F.col("content"))).alias("block_id"),
        "event_time", "line_id", "event_id",
    )


def _numbered(events: DataFrame) -> DataFrame:
    events = write_table(events, "events")  # ids are taken out of the contents once
    return numbered(events, ["event_time", "line_id"], ["block_id"], events.count())


def session_parts(events: DataFrame, part_size=PART_SIZE, lookahead=0) -> DataFrame:
    """Sessions as ordered arrays: block_id, part, own_events, event_sequence.

    Every block is cut into consecutive parts of part_size events, the last one shorter, so
    no task ever holds a whole heavy block; its rows, in order of part, are the session. A
    block of at most part_size events is part 0. With lookahead, event_sequence goes on with
    up to that many events of the next part, beyond the part's own_events.
    """
    if lookahead > part_size:
        raise ValueError("lookahead must not exceed part_size")
    part, offset = _part(part_size), (F.col("position") - 1) % part_size
    # An event belongs to its own part and, near the start of a part, to the one before.
    parts = F.when((offset < lookahead) & (part > 0), F.array(part, part - 1)).otherwise(F.array(part))
    copies = _numbered(events).withColumn("_own", part).withColumn("part", F.explode(parts))
    return copies.groupBy("block_id", "part").agg(
        F.count_if(F.col("_own") == F.col("part")).alias("own_events"),
        F.sort_array(F.collect_list(F.struct("position", "event_id"))).alias("_items"),
    ).select("block_id", "part", "own_events", F.col("_items.event_id").alias("event_sequence"))


def _part(part_size: int):
    return F.floor((F.col("position") - 1) / F.lit(part_size))


def session_heads(events: DataFrame) -> DataFrame:
    """One narrow row per block: first event time and event count."""
    return events.groupBy("block_id").agg(
        F.min("event_time").alias("first_time"), F.count("*").alias("n_events")
    )


def with_labels(sessions: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join on the block: "Anomaly" is 1, any other or missing label 0."""
    flags = labels.select(
        F.col("BlockId").alias("block_id"),
        (F.col("Label") == K.ANOMALY).cast("int").alias("label"),
    )
    return sessions.join(flags, "block_id", "left").fillna(0, subset=["label"])


def slices(events: DataFrame, width: int, part_size=PART_SIZE) -> DataFrame:
    """Every run of width consecutive events of a block, with the part it starts in and the
    event that follows, or padding after the last. Blocks shorter than width give no rows.

    Events stay rows: each range piece takes in the width events that follow its last block in
    later pieces, and looks ahead within itself. No session is collected, however long."""
    if width < 1:
        raise ValueError("width must be positive")
    rows = with_halo(_numbered(events), ["block_id"], width)
    piece = Window.partitionBy("block_id", "piece").orderBy("position")
    event = F.struct("event_id")  # not null where there is an event, even one without an id
    ahead = {f"_{i}": F.lead(event, i).over(piece) for i in range(1, width + 1)}
    last = F.col(f"_{width - 1}") if width > 1 else event
    return rows.withColumns(ahead).where(F.col("own") & last.isNotNull()).select(
        "block_id", _part(max(part_size, width)).alias("part"), (F.col("position") - 1).alias("start"),
        F.array("event_id", *[F.col(f"_{i}.event_id") for i in range(1, width)]).alias("event_sequence"),
        F.coalesce(F.col(f"_{width}.event_id"), F.lit(K.PAD)).alias("next_event"),
    )


def session_slices(events: DataFrame, chosen: DataFrame, width: int, part_size=PART_SIZE) -> DataFrame:
    """The slices of the chosen sessions (block_id, label and what else there is to carry,
    such as is_train). Other blocks are left out before anything is ordered."""
    own = events.join(chosen.select("block_id"), "block_id", "left_semi")
    return slices(own, width, part_size).join(chosen, "block_id")
