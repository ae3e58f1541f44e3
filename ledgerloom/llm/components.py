"""Connected components of an edge table by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.sinks import written


def _star(edges: DataFrame, low: DataFrame) -> DataFrame:
    return edges.join(low, "u")


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u meets the least vertex around u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _star(both, low).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours meet the least of them; edges run from larger u to smaller v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _star(edges, low).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the (u, v) edges with the least node of its component.

    Each round is written to the shared folder, so lost executors repeat one round at most. The
    rounds end when a whole one changes nothing; their number grows with the logarithm of the size.
    Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = seen
        edges = written(_small(_large(edges)))
