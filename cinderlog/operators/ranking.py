"""Positions and running totals over orders that no single task could hold.

A window without a partition key, or over one heavy key, runs in one task. Here rows are
range-partitioned by key and order, so that a heavy key spreads over many pieces; each
piece is numbered on its own and shifted by the totals of the pieces before it.
"""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinderlog.session import write_table

# Rows per range piece at most, and the rows worth a piece while there are cores to spare.
# Where the number of rows is unknown there are as many pieces as shuffle partitions.
PIECE_ROWS = 10_000_000
MIN_PIECE_ROWS = 50_000


def _pieces(df: DataFrame, columns, rows=None) -> DataFrame:
    if rows is None:
        placed = df.repartitionByRange(*columns)
    else:
        cores = df.sparkSession.sparkContext.defaultParallelism
        wanted = min(cores, math.ceil(rows / MIN_PIECE_ROWS))
        placed = df.repartitionByRange(max(1, wanted, math.ceil(rows / PIECE_ROWS)), *columns)
    # Range bounds come from a sample; storing the piece with the rows keeps every later
    # step on the same pieces.
    return write_table(placed.withColumn("_piece", F.spark_partition_id()), "pieces")


def running_total(df: DataFrame, order, totals: dict, keys=(), rows=None) -> DataFrame:
    """Adds, for each name -> column in totals, its sum up to and including the row, per
    key and in the given order. Rows must be unique in keys + order. rows is the number of
    rows, if known."""
    keys, order = list(keys), list(order)
    placed = _pieces(df.withColumns({f"_v_{n}": c for n, c in totals.items()}), keys + order, rows)
    sums = placed.groupBy(*keys, "_piece").agg(
        *[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals]
    )
    # One row per key and piece it touches: as many as there are pieces for a heavy key.
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        *keys, "_piece",
        *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in totals],
    )
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = placed.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(inside) for n in totals})
    match = F.col("l._piece") == F.col("s._piece")
    for key in keys:
        match = match & F.col(f"l.{key}").eqNullSafe(F.col(f"s.{key}"))
    return local.alias("l").join(shifts.alias("s"), match).select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[(F.col(f"_r_{n}") + F.col(f"_b_{n}")).alias(n) for n in totals],
    )


def positions(df: DataFrame, order, keys=(), rows=None) -> DataFrame:
    """Adds the 1-based position of each row within its key."""
    return running_total(df, order, {"position": F.lit(1).cast("bigint")}, keys, rows)


def _same(left: str, right: str, keys):
    match = F.lit(True)
    for key in keys:
        match = match & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return match


def _ends(placed: DataFrame, keys, *more) -> DataFrame:
    """The last key of every range piece: one row per piece. Only such keys go on in later pieces."""
    last = placed.groupBy("piece").agg(F.max(F.struct(*keys, *more)).alias("_last"))
    return last.select("piece", "_last.*")


def numbered(df: DataFrame, order, keys, rows=None) -> DataFrame:
    """df with piece, its range piece by keys and order, and position, counted from 1 within the
    key; stored. Rows must be unique in keys + order. What earlier pieces add to a position is
    known for few keys, at most one per piece, so they are broadcast and no row is shuffled for it."""
    keys, order = list(keys), list(order)
    placed = _pieces(df, keys + order, rows).withColumnRenamed("_piece", "piece")
    spread = placed.alias("l").join(
        F.broadcast(_ends(placed, keys).select(*keys).distinct().alias("s")), _same("l", "s", keys), "left_semi")
    before = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = spread.groupBy(*keys, "piece").agg(F.count("*").alias("_n")).select(
        *keys, "piece", F.sum("_n").over(before).alias("_before")).where("_before is not null")
    inside = Window.partitionBy(*keys, "piece").orderBy(*order)
    local = placed.withColumn("_row", F.row_number().over(inside).cast("bigint"))
    match = _same("l", "s", keys) & (F.col("l.piece") == F.col("s.piece"))
    return write_table(local.alias("l").join(F.broadcast(shifts.alias("s")), match, "left").select(
        *[F.col(f"l.{c}") for c in df.columns], F.col("l.piece"),
        (F.col("_row") + F.coalesce("_before", F.lit(0))).alias("position")), "numbered")


def with_halo(rows: DataFrame, keys, width: int) -> DataFrame:
    """The rows of numbered with own = true, and for each piece the width rows that follow its last
    key in later pieces, as further rows of that piece with own = false."""
    ends = _ends(rows, keys, "position")
    after = (F.col("l.piece") > F.col("s.piece")) & (F.col("l.position") > F.col("s.position")) & (
        F.col("l.position") <= F.col("s.position") + width)
    halo = rows.alias("l").join(F.broadcast(ends.alias("s")), _same("l", "s", keys) & after).select(
        *[F.col("s.piece" if c == "piece" else f"l.{c}") for c in rows.columns])
    return rows.withColumn("own", F.lit(True)).unionByName(halo.withColumn("own", F.lit(False)))


# Buckets that a selection counts at a time, and rows that it looks at one by one.
BUCKETS, FEW = 4096, 10_000


def rows_at(df: DataFrame, number, tie: str, ratio: float, group=None) -> dict:
    """group -> (number, tie) of the row at position floor(n * ratio) of its group, in the order
    of number (a long of at most 62 bits) and tie (text); None where that is 0. group: a column of
    few values; without one, all rows are the group None.

    Every pass counts rows per bucket, for all groups at once and with partial aggregation, and
    goes on in the bucket that holds the row sought: nothing is sorted or moved but counts. Equal
    numbers are told apart by the tie's next character. FEW rows are looked at in the end."""
    rows = df.select((F.lit(None).cast("string") if group is None else F.col(group)).alias("g"),
                     number.cast("bigint").alias("k"), F.col(tie).alias("t"))
    rows = write_table(rows, "selection")
    out, state = {}, {}
    for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect():
        if group is not None and r["g"] is None:
            continue
        left = int(r["n"] * ratio)
        out[r["g"]] = None
        if left:
            state[r["g"]] = dict(lo=r["lo"], hi=r["hi"], prefix="", left=left, n=r["n"])

    def own(g, s):
        same = F.col("g").eqNullSafe(F.lit(g)) & F.col("k").between(s["lo"], s["hi"])
        return same & F.col("t").startswith(s["prefix"]) if s["prefix"] else same

    while todo := {g: s for g, s in state.items() if s["n"] > FEW and not s.get("whole")}:
        part = F.lit(None).cast("binary")
        for g, s in todo.items():
            if s["lo"] < s["hi"]:
                s["width"] = (s["hi"] - s["lo"]) // BUCKETS + 1
                # Exact integer division, as text of equal length that sorts alike
                bucket = F.expr(f"lpad(cast((k - {s['lo']}) div {s['width']} as string), 8, '0')")
            else:
                bucket = F.substring("t", len(s["prefix"]) + 1, 1)
            part = F.when(own(g, s), bucket.cast("binary")).otherwise(part)
        counted = rows.select("g", part.alias("part")).where("part is not null").groupBy("g", "part").count().collect()
        for g, s in todo.items():
            for r in sorted((r for r in counted if r["g"] == g), key=lambda r: bytes(r["part"])):
                if s["left"] <= r["count"]:
                    break
                s["left"] -= r["count"]
            s["n"], at = r["count"], bytes(r["part"]).decode()
            if s["lo"] < s["hi"]:
                low = s["lo"] + int(at) * s["width"]
                s["lo"], s["hi"] = low, min(s["hi"], low + s["width"] - 1)
            elif at:
                s["prefix"] += at
            else:
                s["whole"] = True  # the rows that equal the prefix are equal
    for g, s in state.items():
        if s.get("whole"):
            out[g] = (s["lo"], s["prefix"])
        else:
            few = rows.where(own(g, s)).select("k", "t").collect()  # FEW rows at most
            out[g] = tuple(sorted(few, key=lambda r: (r["k"], r["t"].encode()))[s["left"] - 1])
    return out


def up_to(order, row):
    """Condition: the row is not after the given one (false for None)."""
    if row is None:
        return F.lit(False)
    condition = F.lit(True)
    for name in reversed(order):
        bound = F.lit(row[name])
        condition = (F.col(name) < bound) | ((F.col(name) == bound) & condition)
    return condition
