"""Exact quantiles without sorting a table.

``percentile_approx`` is a sketch; its answer may be off by a share of the
rows. Here the sketch only narrows the range. A first scan finds two values
that enclose the rank; a second one counts what lies below them and sketches
the range between; a third counts the distinct values of the part, a few ten
thousandths of the rows at most, in which the rank must fall, and picks it.
However often a value is repeated it is one row there. Everything is a scalar
subquery: no job runs while the plan is built, nothing is collected.

Both usual meanings are given: the lower one (the value of rank ceil(q n),
what ``percentile_approx`` aims at) and the interpolated one (between the
values around rank q (n - 1)). Nulls and NaN do not count; with nothing left
the quantile is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.functions.columns import safe_double

ACCURACY = 10_000   # a sketch is off by this part of its rows at most
STEPS = 500         # parts into which the second scan cuts the range that the first one left


def _numbers(df: DataFrame, name: str) -> DataFrame:
    return df.select(safe_double(df, name).alias("x")).where("x IS NOT NULL AND NOT isnan(x)")


def _around(values: Column, at: Column, by: int) -> tuple[Column, Column]:
    """The values ``by`` places before and after place ``at`` (from 0) of an array; null beyond its ends."""
    return F.get(values, (at - by).cast("int")), F.get(values, (at + by).cast("int"))


def exact_quantile(df: DataFrame, name: str, q: float = 0.5, interpolated: bool = False,
                   accuracy: int = ACCURACY) -> Column:
    """The exact ``q``-quantile of a numeric column (text that is no number counts as null), as a scalar."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must lie between 0 and 1")
    x = _numbers(df, name)
    slack = 2.0 / accuracy
    outer = x.agg(F.percentile_approx("x", [max(0.0, q - slack), min(1.0, q + slack)], accuracy).alias("b"),
                  F.count(F.lit(1)).alias("n"))
    # Ranks count from 1. Interpolation needs the next one, too.
    n = F.col("n").cast("double")
    first = F.floor(F.lit(q) * (n - 1)) + 1 if interpolated else F.greatest(F.ceil(F.lit(q) * n), F.lit(1))
    outer = outer.select(F.struct(F.col("b")[0].alias("lo"), F.col("b")[1].alias("hi"), "n", first.cast("long").alias("rank"))
                         .alias("outer"))

    # Inside [lo, hi]: values at every STEPS-th part, and how many lie below.
    o = outer.scalar()
    grid = [i / STEPS for i in range(STEPS + 1)]
    inside = (F.col("x") >= o["lo"]) & (F.col("x") <= o["hi"])
    inner = x.agg(F.percentile_approx(F.when(inside, F.col("x")), grid, max(accuracy, 20 * STEPS)).alias("grid"),
                  F.count_if(F.col("x") < o["lo"]).alias("below"), F.count_if(inside).alias("n_in"))
    place = F.floor((o["rank"] - F.col("below")) * F.lit(float(STEPS)) / F.greatest("n_in", F.lit(1)))
    lo, hi = _around(F.col("grid"), place, 2)
    inner = inner.select(F.struct(F.coalesce(lo, o["lo"]).alias("lo"), F.coalesce(hi, o["hi"]).alias("hi")).alias("inner"))

    # Distinct values of what is left; all below and all above are one row each.
    i = inner.scalar()
    side = F.when(F.col("x") < i["lo"], -1).when(F.col("x") > i["hi"], 1).otherwise(0)
    counted = (x.groupBy(side.alias("side"), F.when(side == 0, F.col("x")).alias("v"))
               .agg(F.count(F.lit(1)).alias("k"), F.min("x").alias("least"), F.max("x").alias("most")))
    upto = F.sum("k").over(Window.orderBy("side", "v"))
    ranked = counted.select("k", "least", "most", "side", upto.alias("last"))
    # The outer rows stand for their inner ends: the rank before and the one after the range.
    value = F.when(F.col("side") < 0, F.col("most")).otherwise(F.col("least"))

    def at(r: Column) -> Column:
        known = ((F.col("side") == 0) | (F.col("side") < 0) & (F.col("last") == r)
                 | (F.col("side") > 0) & (F.col("last") - F.col("k") + 1 == r))
        found = F.min(F.when(F.col("last") >= r, F.struct("last", value.alias("value"), known.alias("known"))))
        return F.when(found["known"], found["value"]).when(
            found.isNotNull(), F.raise_error(F.lit("the sketch lost the rank")).cast("double"))

    rank = o["rank"]
    low = at(rank)
    if not interpolated:
        return ranked.agg(low.alias("q")).scalar()
    share = F.lit(q) * (o["n"].cast("double") - 1)
    share = share - F.floor(share)
    return ranked.agg(F.when(share > 0, low + (at(rank + 1) - low) * share).otherwise(low).alias("q")).scalar()
