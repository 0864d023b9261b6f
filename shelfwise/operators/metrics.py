"""Evaluation metrics as lazy DataFrames (M6, M8).

MLlib's evaluators return a driver-side float; these formulations return a
one-row DataFrame computed by aggregates, so they compose with other
queries and can be checked against plain SQL. ``tests/`` checks that they
equal the MLlib evaluators.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import qcol

# Most buckets of the distinct scores used by the AUC prefix sums. The per-bucket
# rows (at most AUC_BUCKETS) are what goes through a window without a
# partition key.
AUC_BUCKETS = 1024


def count_le(bounds: Column, x: Column, size: int) -> Column:
    """Number of elements of the ascending array ``bounds`` (``size`` long)
    that are <= ``x``: a binary search of ceil(log2(size + 1)) steps."""
    steps = max(1, math.ceil(math.log2(size + 1)))
    init = F.struct(F.lit(0).alias("lo"), F.lit(size).alias("hi"))

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = ((lo + hi) / 2).cast("int")
        right = F.coalesce(F.try_element_at(bounds, mid + 1) <= x, F.lit(False))
        active = lo < hi
        return F.struct(F.when(active & right, mid + 1).otherwise(lo).alias("lo"),
                        F.when(active & ~right, mid).otherwise(hi).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["lo"])


def auc(df: DataFrame, label: str, score: str, buckets: int | None = None,
        accuracy: int = 10000) -> DataFrame:
    """Area under the ROC curve of ``score`` for a 0/1 ``label`` (one row: ``auc``).

    Equals the Mann-Whitney statistic with ties counted one half, i.e.
    Spark's ``BinaryClassificationEvaluator`` (trapezoids over thresholds)
    with ``numBins=0``; the evaluator's default down-samples the curve to
    1000 bins, so it is approximate beyond 1000 distinct scores.

    Distributed prefix sums, no single-partition sort of the data:
    1. one row per distinct score with its positive / negative counts
       (reduced map side, so a score shared by many rows is one row);
    2. ``buckets - 1`` approximate quantiles of the distinct scores (one
       scalar subquery) cut them into ``buckets`` ranges of about equal
       size, whatever the score distribution; a binary search places each
       score. The bucket is computed in one place only, so every later step
       sees the same bounds;
    3. per bucket (window partitioned by bucket): negatives earlier in the
       bucket; then one row per bucket with its partial sum and totals;
    4. over the at most ``buckets`` bucket rows: negatives in lower buckets.
    The bucketing only spreads the work: the result is exact for any bounds.
    """
    if buckets is None:  # a few for each shuffle partition spread the work as far as it goes
        buckets = min(AUC_BUCKETS, max(2, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    s = qcol(score).cast("double")
    y = qcol(label).cast("double")
    base = df.select(s.alias("s"), y.alias("y")).filter(F.col("s").isNotNull() & F.col("y").isNotNull())
    d = base.groupBy("s").agg(F.count_if(F.col("y") == 1).alias("pos"),
                              F.count_if(F.col("y") != 1).alias("neg"))
    probs = [i / buckets for i in range(1, buckets)]
    # The counts are summed along so that the subquery needs the same columns
    # as the main branch: both then read one shuffle of the distinct scores.
    bounds = d.agg(F.struct(F.percentile_approx("s", probs, accuracy).alias("q"),
                            F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("x")).scalar()
    # (a subquery may not sit inside the search's lambda: project it first)
    d = (d.withColumn("_x", bounds).withColumn("_q", F.when(F.col("_x.p") + F.col("_x.n") >= 0, F.col("_x.q")))
          .withColumn("b", count_le(F.col("_q"), F.col("s"), buckets - 1)).drop("_q", "_x"))
    within = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("neg_before", F.coalesce(F.sum("neg").over(within), F.lit(0)))
    per_b = d.groupBy("b").agg(
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("inner"),
        F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n"))
    lower = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    per_b = per_b.withColumn("neg_lower", F.coalesce(F.sum("n").over(lower), F.lit(0.0)))
    num = F.sum(F.col("inner") + F.col("p") * F.col("neg_lower"))
    return per_b.agg(F.when((F.sum("p") > 0) & (F.sum("n") > 0),
                            num / (F.sum("p") * F.sum("n"))).alias("auc"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """MAE, RMSE and R² in one aggregate (one row), as ``RegressionEvaluator``.

    R² is null when every label is equal (no variance to explain); ANSI
    mode would otherwise raise on the zero divisor.
    """
    y = qcol(label).cast("double")
    p = qcol(prediction).cast("double")
    e = y - p
    n = F.count(e)
    ss_res = F.sum(e * e)
    ss_tot = F.var_pop(F.when(e.isNotNull(), y)) * n
    return df.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.try_divide(ss_res, n)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(ss_res, F.when(ss_tot > 0, ss_tot))).alias("r2"),
        n.alias("n"),
    )


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every double column (metric values differ in the last bits
    between summation orders)."""
    return df.select(*[F.round(qcol(f.name), digits).alias(f.name)
                       if f.dataType.typeName() == "double" else qcol(f.name)
                       for f in df.schema.fields])
