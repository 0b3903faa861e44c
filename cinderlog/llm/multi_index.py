"""Approximate nearest neighbours by inner product: an inverted multi-index.

Vectors are cut in two halves, each with its own codebook, fitted on a bounded sample; a
cell is a pair of centroids, and every vector is stored with its cell. A query walks the cells
from the largest sum of its two halves' inner products with the centroids down, through a
heap over the two sorted lists, until the cells passed hold enough distinct vectors; a crowded
cell counts for a few only, so that copies and tight groups do not use the walk up. How many are
enough is fitted: for a bounded sample of queries the exact neighbours are found among all
rows, and the walk is made as long as the aimed share of them asks for.

Entries stay where they are. Queries go to them in waves of bounded size, with the cells that each
has passed; a task ranks the entries of those cells only and keeps the best per query.
"""

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderlog.llm.common import receive, send
from cinderlog.session import write_table
from cinderlog.sources.files import spread

# Documented bounds: vectors the codebooks are fitted on, centroids per half, queries whose exact
# neighbours fit the length of a walk.
SAMPLE, CENTROIDS, FITTED_QUERIES = 20_000, 256, 256
ROUNDS = 12
AIM = 0.94  # share of the exact neighbours that a walk is made long enough for
# A cell counts for so many times the mean of the filled cells at most.
CROWDED = 4
TILE_QUERIES, TILE_ROWS = 512, 8192
WAVE_BYTES = 32 << 20  # vectors and passed cells of a wave of queries
WALK_QUERIES = 64      # queries that a task walks for, at least


@dataclass
class Codebooks:
    left: np.ndarray   # centroids of the first half
    right: np.ndarray
    width: int


def usable(vectors: DataFrame, width: int | None = None) -> DataFrame:
    """vec_id and embedding as array<double>: not null, without null or non-finite components,
    not zero; of the given width, if one is given."""
    good = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(
        "vec_id is not null and embedding is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(embedding, x -> x <> 0)"
    )
    return good if width is None else good.where(F.size("embedding") == width)


def _kmeans(points: np.ndarray, k: int) -> np.ndarray:
    draw = np.random.default_rng(7)
    distinct = np.unique(points, axis=0)
    k = min(k, len(distinct))
    # Each first centre is drawn by squared distance from those before: a tight group gets few.
    at = [int(draw.integers(len(distinct)))]
    far = ((distinct - distinct[at[0]]) ** 2).sum(1)
    while len(at) < k:
        reach = far.cumsum()
        at.append(min(int(np.searchsorted(reach, draw.random() * reach[-1], side="right")), len(distinct) - 1))
        far = np.minimum(far, ((distinct - distinct[at[-1]]) ** 2).sum(1))
    centres = distinct[at].copy()
    for _ in range(ROUNDS):
        near = _nearest(points, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        count = np.bincount(near, minlength=k)
        filled = count > 0
        centres[filled] = total[filled] / count[filled, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2 * points @ centres.T, axis=1)


def fit(vectors: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Codebooks | None:
    """Codebooks from the vectors that come first by hash of the id; None without vectors.
    Their width is the most frequent one; the others take no part in the search. There are
    about a quarter as many cells as vectors, up to centroids squared."""
    widths = vectors.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if widths is None:
        return None
    total = widths["count"]
    centroids = min(centroids, max(4, math.isqrt(total) // 2))
    order = F.xxhash64("vec_id")
    some = usable(vectors, widths["w"])
    if total > 2 * sample:  # a threshold first, so that few vectors are sorted
        some = some.where(order < F.lit(int(-(1 << 63) + 1.2 * sample / total * (1 << 64))))
    drawn = some.orderBy(order, "vec_id").limit(sample)
    points = np.array(drawn.select("embedding").toPandas()["embedding"].tolist())
    half = widths["w"] // 2
    return Codebooks(_kmeans(points[:, :half], centroids), _kmeans(points[:, half:], centroids), widths["w"])


def _matrix(column, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, width))


def _assign(frames, shared):
    books = receive(shared)
    half = books.width // 2
    for frame in frames:
        points = _matrix(frame["embedding"], books.width)
        cell = _nearest(points[:, :half], books.left) * len(books.right) + _nearest(points[:, half:], books.right)
        yield frame.assign(cell=cell)


def index(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Every usable vector with its cell: vec_id, embedding, cell."""
    shared = send(vectors.sparkSession, books)
    return spread(write_table(vectors.mapInPandas(
        lambda it: _assign(it, shared), "vec_id long, embedding array<double>, cell int"
    ), "cells"))


def walk(left: np.ndarray, right: np.ndarray, size: np.ndarray, enough: int):
    """Cells (i, j) in order of falling left[i] + right[j] until their sizes add up to enough,
    empty ones left out, and the last sum. size: what [i, j] counts for."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    x, y, held = left[a].tolist(), right[b].tolist(), size[np.ix_(a, b)].tolist()
    heap, cells, total, last = [(-(x[0] + y[0]), 0, 0)], [], 0, 0.0
    while heap and total < enough:
        last, i, j = heapq.heappop(heap)
        if held[i][j]:
            cells.append((int(a[i]), int(b[j])))
            total += held[i][j]
        # (i, j + 1) comes from (i, j) alone, (i + 1, 0) from (i, 0): each cell is pushed once.
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))
    return cells, -last


def _passed(frames, shared, enough):
    """Per query the cells that its walk passes, as a bit per cell."""
    books, size = receive(shared)
    half = books.width // 2
    for frame in frames:
        points = _matrix(frame["embedding"], books.width)
        left, right = points[:, :half] @ books.left.T, points[:, half:] @ books.right.T
        bits = []
        for a, b in zip(left, right):
            passed = np.zeros(size.shape, bool)
            cells, _ = walk(a, b, size, enough)
            passed[tuple(np.array(cells).T)] = True
            bits.append(np.packbits(passed.ravel()).tobytes())
        yield frame.assign(cells=bits)


def _best(held, fresh, top: int):
    """The top entries (query, score, id) per query: largest score first, ties by id."""
    query, score, ids = (np.concatenate(x) for x in zip(held, fresh))
    order = np.lexsort((ids, -score, query))
    query, score, ids = query[order], score[order], ids[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
    keep = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)])) < top
    return query[keep], score[keep], ids[keep]


def _rank(frames, shared, top: int, width: int):
    """The best entries of a task for each query of a wave, among the cells that it has passed."""
    queries, points, cells = receive(shared)
    tiles = range(0, len(queries), TILE_QUERIES)
    held = [(np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)) for _ in tiles]
    for frame in frames:
        for start in range(0, len(frame), TILE_ROWS):
            part = frame.iloc[start:start + TILE_ROWS].sort_values("cell", kind="stable")
            ids, entries, own = part["vec_id"].to_numpy(), _matrix(part["embedding"], width), part["cell"].to_numpy()
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            for n, at in enumerate(tiles):
                asking = slice(at, at + TILE_QUERIES)
                ours, bits = points[asking], cells[asking]
                scores = np.full((len(ours), len(part)), -np.inf)
                for lo, hi in zip(first, np.r_[first[1:], len(own)]):
                    who = np.flatnonzero(bits[:, own[lo] >> 3] >> (7 - (own[lo] & 7)) & 1)
                    # einsum adds the components of each pair up alike: equal vectors, equal scores
                    scores[who, lo:hi] = np.einsum("ij,kj->ik", ours[who], entries[lo:hi])
                query, score, _ = held[n]
                least = np.full(len(ours), -np.inf)
                full = np.bincount(query, minlength=len(ours)) >= top
                last = np.flatnonzero(np.r_[query[1:] != query[:-1], True]) if len(query) else np.empty(0, np.int64)
                least[query[last]] = score[last]
                least[~full] = -np.inf
                good = (scores >= least[:, None]) & (scores > -np.inf) & (queries[asking, None] != ids)
                i, j = np.nonzero(good)
                held[n] = _best(held[n], (i, scores[i, j], ids[j]), top)
    for at, (query, score, ids) in zip(tiles, held):
        yield pd.DataFrame({"query_id": queries[at + query], "vec_id": ids, "score": score})


def cell_sizes(entries: DataFrame, books: Codebooks) -> np.ndarray:
    """What each cell counts for in a walk: its distinct vectors, up to CROWDED times the
    mean of the filled cells."""
    sizes = entries.select("cell", F.xxhash64("embedding").alias("v")).distinct().groupBy(
        "cell").count().toPandas()  # at most centroids * centroids rows
    size = np.zeros(len(books.left) * len(books.right), np.int64)
    size[sizes["cell"].astype(int)] = sizes["count"]
    return np.minimum(size, int(np.ceil(CROWDED * size.sum() / max(1, (size > 0).sum()))))


def _ranked(entries: DataFrame, asked: DataFrame, width: int, top: int, waves: int) -> DataFrame:
    """query_id, rank, vec_id, score. asked: vec_id, embedding, cells."""
    spark, parts = entries.sparkSession, []
    for number in range(waves):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == number).orderBy("vec_id").toPandas()
        if len(own):
            bits = np.stack([np.frombuffer(b, np.uint8) for b in own["cells"]])
            shared = send(spark, (own["vec_id"].to_numpy(), _matrix(own["embedding"], width), bits))
            parts.append(entries.mapInPandas(
                lambda it, shared=shared: _rank(it, shared, top, width), "query_id long, vec_id long, score double"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")


def enough_for(entries: DataFrame, books: Codebooks, size: np.ndarray, queries: DataFrame, top: int, aim: float) -> int:
    """How much the cells of a walk have to count for, so that it passes the cells of the share
    aim of the exact neighbours of FITTED_QUERIES queries (those first by hash of the id)."""
    total = int(size.sum())
    drawn = write_table(queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FITTED_QUERIES), "fitted")
    every = np.packbits(np.ones(len(size), bool)).tobytes()
    exact = write_table(_ranked(
        entries, drawn.select("vec_id", "embedding", F.lit(bytearray(every)).alias("cells")), books.width, top, 1), "exact")
    placed = entries.select("vec_id", "cell").join(exact.select("query_id", "vec_id"), "vec_id").toPandas()
    own = drawn.select("vec_id", "embedding").toPandas().drop_duplicates("vec_id").set_index("vec_id")["embedding"]
    half, needed = books.width // 2, []
    for query, cells in placed.groupby("query_id")["cell"]:
        point = np.array(own[query], np.float64)
        sums = ((point[:half] @ books.left.T)[:, None] + (point[half:] @ books.right.T)[None, :]).ravel()
        order = np.argsort(-sums, kind="stable")
        before = np.empty(len(size), np.int64)
        before[order] = np.r_[0, np.cumsum(size[order])[:-1]]
        needed.append(before[cells.to_numpy()])
    return min(total, int(np.quantile(np.concatenate(needed), aim)) + 1) if needed else total


def search(entries: DataFrame, books: Codebooks, queries: DataFrame, top: int = 20, aim: float = AIM,
           enough: int | None = None, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """The top nearest entries found of each query: query_id, rank, vec_id, score (inner
    product in double precision). A query's own row is no candidate; ties go to the smaller
    vec_id; with fewer candidates all are returned. queries: vec_id, embedding. enough: what the
    cells of a walk have to count for; fitted to the aimed share of neighbours if not given."""
    spark = entries.sparkSession
    queries = write_table(queries.select("vec_id", "embedding"), "queries")
    count = queries.count()
    if not count:
        return spark.createDataFrame([], RESULT)
    size = cell_sizes(entries, books)
    if enough is None:
        enough = enough_for(entries, books, size, queries, top, aim)
    enough = max(enough, top + 1)
    shared = send(spark, (books, size.reshape(len(books.left), len(books.right))))
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(count / 10_000))
    asked = write_table(queries.repartition(min(tasks, math.ceil(count / WALK_QUERIES))).mapInPandas(
        lambda it: _passed(it, shared, enough), "vec_id long, embedding array<double>, cells binary"), "walks")
    waves = math.ceil(count * (8 * books.width + len(size) // 8 + 1) / wave_bytes)
    return _ranked(entries, asked, books.width, top, waves)


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(spark: SparkSession, vectors: DataFrame, is_query, top: int = 20, aim: float = AIM) -> DataFrame:
    """Index over all usable vectors and search for those that is_query selects. Repeated
    rows of an id are candidates each (its own id's are not) and answer once. No usable vector
    and no query gives no row. aim 1.0 walks as far as the farthest neighbour of the fitted
    queries."""
    good = usable(vectors)
    books = fit(good)
    if books is None:
        return spark.createDataFrame([], RESULT)
    entries = index(usable(good, books.width), books)
    queries = entries.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return search(entries, books, queries, top, aim)
