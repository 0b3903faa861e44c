"""Connected components by alternating large-star and small-star steps on an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog.session import write_table


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on the smallest of the node and its neighbours."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of long ids -> (node, component): the smallest node reachable, for every
    node with an edge to another one. Loops, nulls and repeated edges change nothing; without
    edges the result is empty. Joins are on nodes and minima are pre-aggregated, so a node with
    very many edges is split by adaptive execution. Every round is stored."""
    edges = edges.select("u", "v").where("u <> v").distinct()
    state = None
    while True:
        edges = write_table(_small_star(_large_star(edges)).where("u <> v").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = now
