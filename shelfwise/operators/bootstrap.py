"""Intervals for metrics by the Poisson bootstrap (M6, M8).

Resampling n rows with replacement gives each row about Poisson(1) copies. Here
the number of a row's copies in a replicate is that distribution inverted at a
hash of seed, replicate and the row's key: no state, nothing random, the same for
any layout and after any lost task. All replicates are taken in one pass; copies
are weights, so a row is at most one row for each replicate, summed on the map
side. Replicate 0 has every row once and gives the estimate itself.

A row costs one hash and a few text comparisons for each replicate, as native
columns. Rows that are dear to make, or that come in few parts, are best stored
first (``session.stored_rows``): each metric reads them again, and the task that
has a row multiplies it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.functions.columns import qcol
from shelfwise.operators.metrics import AUC_BUCKETS, count_le

REPLICATES = 200
LEVEL = 0.95
SEED = 42
REPLICATE, WEIGHT, _HASH = "_replicate", "_weight", "_hash"


def poisson_cdf() -> list[float]:
    """P(copies <= k) of the Poisson distribution with mean 1, as far as 52 binary digits tell."""
    out, p, total = [], math.exp(-1), 0.0
    while not out or total < 1.0 - 2.0 ** -52:
        total += p
        out.append(total)
        p /= len(out)
    return out


def drawn(key: str, replicate: int, seed: int = SEED) -> Column:
    """The hash of a row in a replicate, as hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}|{replicate}|"), F.coalesce(qcol(key).cast("string"), F.lit(""))))


def weight(hashed: Column, replicate: Column) -> Column:
    """Copies of a row with this hash in a replicate (1 in replicate 0).

    The first 13 hex digits over 2**52 are a uniform number; texts of hex digits compare as
    their numbers do. A share of 1 is never reached."""
    bounds = [f"{n:013x}" for n in (math.ceil(c * 2.0 ** 52) for c in poisson_cdf()) if n < 2 ** 52]
    copies = F.when(replicate == 0, 1)
    for k, bound in enumerate(bounds):
        copies = copies.when(hashed < bound, k)
    return copies.otherwise(len(bounds))


def replicated(df: DataFrame, key: str, replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """``df``, for each replicate (0 to ``replicates``) the rows that are in it, with their weight."""
    hashes = F.array(F.lit(""), *[drawn(key, r, seed) for r in range(1, replicates + 1)])
    rows = df.select("*", F.posexplode(hashes).alias(REPLICATE, _HASH))
    return rows.withColumn(WEIGHT, weight(F.col(_HASH), F.col(REPLICATE))).where(F.col(WEIGHT) > 0).drop(_HASH)


def regression_by_replicate(df: DataFrame, label: str, prediction: str, key: str, replicates: int = REPLICATES,
                            seed: int = SEED) -> DataFrame:
    """``mae``, ``rmse`` and ``r2`` of each replicate. Rows with a null label or prediction do not count."""
    y, p = qcol(label).cast("double"), qcol(prediction).cast("double")
    rows = df.select(qcol(key), y.alias("y"), (y - p).alias("e")).where("e IS NOT NULL")
    w, e, y = F.col(WEIGHT), F.col("e"), F.col("y")
    sums = replicated(rows, key, replicates, seed).groupBy(REPLICATE).agg(
        F.sum(w).alias("n"), F.sum(w * F.abs(e)).alias("a"), F.sum(w * e * e).alias("s"), F.sum(w * y).alias("t"),
        F.sum(w * y * y).alias("q"))
    spread = F.col("q") - F.col("t") * F.col("t") / F.col("n")
    return sums.select(REPLICATE, (F.col("a") / F.col("n")).alias("mae"), F.sqrt(F.col("s") / F.col("n")).alias("rmse"),
                       F.when(spread > 0, 1.0 - F.col("s") / spread).alias("r2"))


def auc_by_replicate(df: DataFrame, label: str, score: str, key: str, replicates: int = REPLICATES, seed: int = SEED,
                     buckets: int = AUC_BUCKETS) -> DataFrame:
    """``auc`` of each replicate, exact, with weights: distinct scores by bucket as in ``metrics.auc``, whose
    bounds all replicates share. Null where a replicate has one class only."""
    rows = df.select(qcol(key), qcol(score).cast("double").alias("s"), (qcol(label).cast("double") == 1).alias("one"))
    rows = rows.where("s IS NOT NULL AND one IS NOT NULL")
    bounds = rows.agg(F.percentile_approx("s", [i / buckets for i in range(1, buckets)]).alias("q")).scalar()
    w = F.col(WEIGHT)
    # A score's bucket is the same in all replicates: found once, before a row becomes many.
    rows = rows.withColumn("_q", bounds).withColumn("b", count_le(F.col("_q"), F.col("s"), buckets - 1)).drop("_q")
    d = replicated(rows, key, replicates, seed).groupBy(REPLICATE, "b", "s").agg(
        F.sum(F.when(F.col("one"), w).otherwise(0)).alias("pos"), F.sum(F.when(F.col("one"), 0).otherwise(w)).alias("neg"))
    within = Window.partitionBy(REPLICATE, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("before", F.coalesce(F.sum("neg").over(within), F.lit(0)))
    per = d.groupBy(REPLICATE, "b").agg(F.sum(F.col("pos") * (F.col("before") + F.col("neg") / 2.0)).alias("inner"),
                                        F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n"))
    lower = Window.partitionBy(REPLICATE).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("lower", F.coalesce(F.sum("n").over(lower), F.lit(0.0)))
    sums = per.groupBy(REPLICATE).agg(F.sum(F.col("inner") + F.col("p") * F.col("lower")).alias("x"),
                                      (F.sum("p") * F.sum("n")).alias("pairs"))
    return sums.select(REPLICATE, F.when(F.col("pairs") > 0, F.col("x") / F.col("pairs")).alias("auc"))


def intervals(by_replicate: DataFrame, level: float = LEVEL) -> DataFrame:
    """(``metric``, ``estimate``, ``lower``, ``upper``): percentile intervals of each metric column."""
    names = [c for c in by_replicate.columns if c != REPLICATE]
    tail = (1.0 - level) / 2.0
    long = by_replicate.select(REPLICATE, F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), qcol(n).alias("x"))
                                                              for n in names])).alias("m")).select(REPLICATE, "m.*")
    drawn = F.when(F.col(REPLICATE) > 0, F.col("x"))
    return long.groupBy("metric").agg(F.max(F.when(F.col(REPLICATE) == 0, F.col("x"))).alias("estimate"),
                                      F.percentile(drawn, tail).alias("lower"), F.percentile(drawn, 1.0 - tail).alias("upper"))
