"""Connected components of a large graph, as a loop of joins over stored edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.storage import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("least").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    joined = edges.join(least, "b")
    moved = joined.select(F.col("least").alias("x"), F.explode(F.array("a", "b")).alias("b"))
    return moved.filter("x < b").select(F.col("x").alias("a"), "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of the links ``(a, b)``; a root is the least node reachable.

    Alternates the two star operations until the edges stay the same, which takes a number of
    rounds that grows with the logarithm of the nodes. Each round's edges are stored, so a lost
    executor costs one round at most. Nothing but a count and a checksum reaches the driver.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = store(edges.filter("a < b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == before:
            break
        before = state
        edges = store(_small_star(_large_star(edges)), "edges")
    roots = edges.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
