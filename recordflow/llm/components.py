"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordflow.llm.base import saved


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Point each node's larger (or its smaller, and itself) neighbours at the least of its neighbours and itself.

    The least neighbour is aggregated before the shuffle and joined back, so a
    node with very many links is spread by the skew join instead of gathered.
    """
    if large:
        sides = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
    near = sides.join(least, F.col("a") == F.col("of"))
    if large:
        moved = near.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("of").alias("a"), F.col("m").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b"))


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for every node of ``links`` (a, b: two integers).

    Rounds repeat until nothing moves; each leaves one checkpoint and brings one
    row to the driver.
    """
    first = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    now = saved(first.distinct(), narrow=True)
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        now = saved(_stars(_stars(now, large=True), large=False).distinct(), narrow=True)
