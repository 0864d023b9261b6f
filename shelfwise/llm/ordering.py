"""Positions and running sums within a group, however large the group is.

A window over a group puts all its rows into one task. Here rows are dealt by
ranges of (group, order), so a group with a third of all rows is spread over
many tasks; what came before in the group is summed over ranges or blocks
(one small row for each) and added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.common import cut_lineage

BLOCK = 4096  # rows of a group whose running sums are taken in one window


def numbered(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``pos`` (from 0, by ``order`` within ``group``, nulls first) and ``total``
    (rows of the group). Rows that tie keep an arbitrary order, the same ever after.

    Both steps are written out: neither the ties nor the ranges can come out
    another way when a task is run again."""
    names = df.columns
    tied = cut_lineage(df.withColumn("_tie", F.monotonically_increasing_id()))
    by = [*group, *order, "_tie"]
    placed = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    placed = cut_lineage(placed.withColumn("_at", F.monotonically_increasing_id())
                         .withColumn("_part", F.shiftright("_at", 33)))
    runs = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group)
    before = F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    keys = [*group, "_part"]
    runs = cut_lineage(runs.select(*[F.col(k).alias(f"_run_{k}") for k in keys],
                                   (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
                                   F.sum("_n").over(w).alias("total")))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_run_{k}")) for k in keys])
    return placed.join(runs, same).select(*names, (F.col("_at") + F.col("_shift")).alias("pos"), "total")


def running(df: DataFrame, group: str, pos: str, sums: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """``df`` with a column for each of ``sums``: its sum over the rows of ``group`` up to
    this ``pos`` (whole numbers from 0, none twice), as decimal(38,0)."""
    df = df.withColumn("_block", F.floor(F.col(pos) / block))
    inside = Window.partitionBy(group, "_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    wide = {n: c.cast("decimal(20,0)") for n, c in sums.items()}
    within = df.withColumns({f"_{n}": F.sum(c).over(inside).cast("decimal(38,0)") for n, c in wide.items()})
    blocks = df.groupBy(group, "_block").agg(*[F.sum(c).cast("decimal(38,0)").alias(n) for n, c in wide.items()])
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    blocks = blocks.select(group, "_block", *[F.coalesce(F.sum(n).over(earlier).cast("decimal(38,0)"), zero)
                                              .alias(f"_before_{n}") for n in sums])
    out = within.join(blocks, [group, "_block"])
    for n in sums:
        out = out.withColumn(n, (F.col(f"_{n}") + F.col(f"_before_{n}")).cast("decimal(38,0)"))
    return out.drop("_block", *[f"_{n}" for n in sums], *[f"_before_{n}" for n in sums])
