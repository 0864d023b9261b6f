"""Connected components of a link table by alternating large and small stars.

Each round is two aggregations and two joins; neighbours are never gathered
in one place, only their minimum is (combined on the map side). A node with
very many links is an ordinary skewed join key, which adaptive execution
splits. The rounds grow with the logarithm of the number of nodes; only a
row count and a checksum of each round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import cut_lineage


def _large_star(e: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the smallest of the neighbourhood."""
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written out, so that the join is a plain one of two shuffles and the rows of
    # a node with very many neighbours are split over tasks.
    least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them (u > v holds)."""
    least = cut_lineage(e.groupBy("u").agg(F.min("v").alias("m")))  # as above
    moved = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): ``root`` is the smallest node that can be reached.

    Only nodes with a link to another node are returned, each once. Links
    may repeat, go either way or join a node to itself; a link with a null
    end is ignored. No link gives no row.
    """
    real = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = cut_lineage(real.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        e = cut_lineage(_small_star(_large_star(e)))
    roots = e.select(F.col("v").alias("node")).distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(roots.select("node", F.col("node").alias("root"))))
