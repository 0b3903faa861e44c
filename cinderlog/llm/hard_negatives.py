"""Hard-negative mining: exact integer inner products by residue arithmetic in float32.

Components become integers, and these centred residues modulo several primes under 1024: a
product of two residue matrices, CHUNK columns at a time, has sums below 2 ** 24, so a float32
GEMM gives them exactly. Chinese remaindering puts the signed scores together again; as many
primes are taken as the largest norm among the rows asks for.

Anchors are held in waves of bounded size, and every wave meets all rows, a tile at a time, while
the rows stay where they are. A task keeps the best of what it has met per anchor, so what is
shuffled is a few rows per anchor and task. The first pass finds the positives, the second the
negatives within the window of scores that each positive sets.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderlog.llm.common import receive, send
from cinderlog.session import write_table

CHUNK = 64                      # columns of one float32 product: 64 * 510 ** 2 < 2 ** 24
LARGEST_PRIME = 1021
TILE_ANCHORS, TILE_ROWS = 512, 8192
WAVE_BYTES = 32 << 20           # vectors of a wave of anchors, as int64
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90              # percent of the positive's score
LONGS = 1 << 63


def primes_for(bound: int) -> list:
    """Primes from LARGEST_PRIME down whose product exceeds 2 * bound + 1."""
    found, product, n = [], 1, LARGEST_PRIME
    while product <= 2 * bound + 1 or len(found) < 2:
        if n < 3:
            raise ValueError("scores are too large for the primes under 1024")
        if all(n % k for k in range(2, math.isqrt(n) + 1)):
            found.append(n)
            product *= n
        n -= 1
    return found


class Residues:
    """Scores of integer vectors with absolute values up to bound. Vectors are float64 or, beyond
    2 ** 53, still exact float64 integers."""

    def __init__(self, bound: int):
        self.primes = primes_for(bound)
        self.product = math.prod(self.primes)
        # Garner's digits: the inverse of the product so far, modulo the next prime
        self.inverse = [pow(math.prod(self.primes[:k]), -1, p) for k, p in enumerate(self.primes)]
        self.exact = self.product < LONGS // 128  # room for percentages of a score in int64

    def split(self, vectors: np.ndarray) -> list:
        """The vectors' centred residues, a float32 matrix per prime."""
        out = []
        for p in self.primes:
            r = np.fmod(vectors, p)
            r -= p * np.rint(r / p)
            out.append(r.astype(np.float32))
        return out

    def scores(self, left: list, right: list) -> np.ndarray:
        """Exact signed inner products of every left with every right vector."""
        shape = len(left[0]), len(right[0])
        kind = np.int64 if self.exact else object
        total, place = np.zeros(shape, kind), 1
        for k, (p, a, b) in enumerate(zip(self.primes, left, right)):
            r = np.zeros(shape, np.int64)
            for at in range(0, a.shape[1], CHUNK):
                r += (a[:, at:at + CHUNK] @ b[:, at:at + CHUNK].T).astype(np.int64)
            digit = ((r - (total % p).astype(np.int64)) * self.inverse[k]) % p
            total = total + digit.astype(kind) * place
            place *= p
        return np.where(total > self.product // 2, total - self.product, total)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and point (floor of 256 times each component) of the rows that take part;
    where 7 divides vec_id the label is moved on by one. Rows without vec_id take no part."""
    label = F.col("label").cast("long")
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.col("embedding").cast("array<double>").alias("e"),
    ).where(
        "vec_id is not null and label is not null and e is not null"
        " and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    ).select("vec_id", "label", F.expr(  # beyond 1e15 a double has no fraction, and 256 x is exact
        "transform(e, x -> CASE WHEN abs(x) < 1e15 THEN CAST(floor(256 * x) AS double) ELSE 256 * x END)"
    ).alias("point"))


def _matrix(column, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, width))


def _best(held, fresh, top: int):
    """The top entries (group, score, id) per group: highest score first, ties by id."""
    group, score, ids = (np.concatenate(x) for x in zip(held, fresh))
    if score.dtype == object:
        order = np.array(sorted(range(len(group)), key=lambda i: (group[i], -score[i], ids[i])), np.int64)
    else:
        order = np.lexsort((ids, -score, group))
    group, score, ids = group[order], score[order], ids[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
    place = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    keep = place < top
    return group[keep], score[keep], ids[keep]


def _floors(held, groups: int, top: int, kind):
    """Per group the score of its last held entry where it has top entries, else None: rows
    below it cannot come in any more."""
    group, score, _ = held
    lowest = np.zeros(groups, kind)
    full = np.bincount(group, minlength=groups) >= top if len(group) else np.zeros(groups, bool)
    if len(group):
        last = np.flatnonzero(np.r_[group[1:] != group[:-1], True])
        lowest[group[last]] = score[last]
    return full, lowest


def _texts(score) -> pd.Series:
    """Scores as text: they may be longer than a long."""
    return pd.Series([str(x) for x in score], dtype=object)


def _tiles(frames):
    """Rows of a task, TILE_ROWS at a time at most."""
    for frame in frames:
        for at in range(0, len(frame), TILE_ROWS):
            yield frame.iloc[at:at + TILE_ROWS]


class _Wave:
    """The anchors of a wave, in tiles with their residues at hand."""

    def __init__(self, shared):
        self.ids, self.labels, points, self.bound, self.windows = receive(shared)
        self.residues, self.width = Residues(self.bound), points.shape[1]
        self.tiles = [
            (at, self.residues.split(points[at:at + TILE_ANCHORS].astype(np.float64)))
            for at in range(0, len(points), TILE_ANCHORS)
        ]
        self.kind = np.int64 if self.residues.exact else object

    def none(self):
        return np.empty(0, np.int64), np.empty(0, self.kind), np.empty(0, np.int64)


def _positives(frames, shared, top):
    wave = _Wave(shared)
    held = [wave.none() for _ in wave.tiles]
    for frame in _tiles(frames):
        ids, labels = frame["vec_id"].to_numpy(), frame["label"].to_numpy()
        points = wave.residues.split(_matrix(frame["point"], wave.width))
        for t, (at, tile) in enumerate(wave.tiles):
            own = slice(at, at + len(tile[0]))
            score = wave.residues.scores(tile, points)
            full, lowest = _floors(held[t], len(score), top, wave.kind)
            may = (wave.labels[own, None] == labels) & (wave.ids[own, None] != ids)
            a, j = np.nonzero(may & (~full[:, None] | (score >= lowest[:, None])))
            held[t] = _best(held[t], (a, score[a, j], ids[j]), top)
    for (at, _), (a, score, ids) in zip(wave.tiles, held):
        yield pd.DataFrame({"anchor_id": wave.ids[at + a], "positive_id": ids, "exact": _texts(score)})


def _negatives(frames, shared, top):
    wave = _Wave(shared)
    places, low, high = wave.windows  # per anchor and place of the positive; low > high: none
    held = [[wave.none() for _ in range(places)] for _ in wave.tiles]
    low, high = low.astype(wave.kind), high.astype(wave.kind)
    for frame in _tiles(frames):
        ids, labels = frame["vec_id"].to_numpy(), frame["label"].to_numpy()
        points = wave.residues.split(_matrix(frame["point"], wave.width))
        for t, (at, tile) in enumerate(wave.tiles):
            own = slice(at, at + len(tile[0]))
            score = wave.residues.scores(tile, points)
            other = wave.labels[own, None] != labels
            for k in range(places):
                full, lowest = _floors(held[t][k], len(score), top, wave.kind)
                least = np.where(full & (lowest > low[own, k]), lowest, low[own, k])
                a, j = np.nonzero(other & (score >= least[:, None]) & (score <= high[own, k][:, None]))
                held[t][k] = _best(held[t][k], (a, score[a, j], ids[j]), top)
    for (at, _), of in zip(wave.tiles, held):
        for k, (a, score, ids) in enumerate(of):
            yield pd.DataFrame({"anchor_id": wave.ids[at + a], "place": np.full(len(a), k, np.int32),
                                "negative_id": ids, "exact": _texts(score)})


def _window(exact: list):
    """Lowest and highest score of a negative for each positive score."""
    return [-(-LOW * s // 100) for s in exact], [HIGH * s // 100 for s in exact]


def _top(found: DataFrame, keys, name: str, top: int) -> DataFrame:
    """The top found per key. Scores beyond a long travel as text; decimals compare them."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), name)
    return found.withColumn("score", F.col("exact").cast("decimal(38,0)")).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(spark: SparkSession, vectors: DataFrame, is_anchor, positives: int = POSITIVES,
         negatives: int = NEGATIVES, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """For each anchor and each of its positives, the highest rows of another label whose score
    is between LOW and HIGH percent of the positive's: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    vectors: vec_id, embedding, label; other columns are not read. Rows with a null vec_id, label
    or vector, or with a null or non-finite component take no part, nor do those of another width
    than the most frequent one (ties: the smaller). Ties go to the smaller vec_id. Repeated rows of
    an id are candidates each, except for an anchor of that id, which asks once (with its smallest
    label and vector). Scores beyond a long are compared exactly and given as the nearest long.
    Fewer candidates give fewer rows; no usable vector or no anchor gives none."""
    rows = write_table(usable(vectors), "points")
    width = rows.groupBy(F.size("point").alias("w")).count().orderBy(F.desc("count"), "w").first()
    none = spark.createDataFrame([], RESULT)
    if width is None or width["w"] == 0:
        return none
    width = width["w"]
    rows = rows.where(F.size("point") == width)
    norm = rows.agg(F.max(F.aggregate("point", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    if norm == float("inf") or norm >= 1e37:
        raise ValueError("inner products of 37 digits and more are not supported")
    bound = int(norm * (1 + 1e-9)) + 1  # no inner product exceeds the largest squared norm
    asked = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "point")).alias("own"))
    asked = write_table(asked.select("vec_id", "own.*"), "anchors")
    count = asked.count()
    if not count:
        return none
    size = max(1, wave_bytes // (8 * width))
    waves = math.ceil(count / size)
    parts = []
    for number in range(waves):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == number).orderBy("vec_id").toPandas()
        if not len(own):
            continue
        parts.append(_wave(spark, rows, own, width, bound, positives, negatives))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _wave(spark, rows, own, width, bound, positives, negatives):
    ids, labels, points = own["vec_id"].to_numpy(), own["label"].to_numpy(), _matrix(own["point"], width)
    shared = send(spark, (ids, labels, points, bound, None))
    near = write_table(_top(rows.mapInPandas(
        lambda it: _positives(it, shared, positives), "anchor_id long, positive_id long, exact string"
    ), ["anchor_id"], "positive_id", positives), "positives")
    chosen = near.select("anchor_id", "rank", "exact").toPandas()  # positives per anchor of a wave at most
    low, high = np.ones((len(ids), positives), object), np.zeros((len(ids), positives), object)
    at, place = np.searchsorted(ids, chosen["anchor_id"]), chosen["rank"].to_numpy() - 1
    low[at, place], high[at, place] = _window([int(x) for x in chosen["exact"]])
    asked = send(spark, (ids, labels, points, bound, (positives, low, high)))
    far = write_table(_top(rows.mapInPandas(
        lambda it: _negatives(it, asked, negatives), "anchor_id long, place int, negative_id long, exact string"
    ), ["anchor_id", "place"], "negative_id", negatives), "negatives")
    within = lambda c: F.least(F.greatest(c, F.lit(-LONGS)), F.lit(LONGS - 1)).cast("long")
    return far.alias("n").join(near.alias("p"), F.expr("n.anchor_id = p.anchor_id and n.place = p.rank - 1")).select(
        "n.anchor_id", "p.positive_id", "n.rank", "n.negative_id",
        within(F.col("p.score")).alias("positive_score"), within(F.col("n.score")).alias("negative_score"))
