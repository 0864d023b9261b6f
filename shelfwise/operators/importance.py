"""Permutation importance of features (M9), for any model that scores a DataFrame.

A feature matters as much as the loss grows when its values are dealt to other
rows. The deal is keyed by hashes, not by a random number: rows fall into
buckets by a hash of their key, and in each bucket, ordered by a hash of seed,
feature and key, every row takes the value of the next one (the last that of the
first). That is a permutation, the same for any layout, and no task sorts more
than a bucket. All features share one shuffle; the model scores the rows once as
they are and once for each feature, and one aggregate gives all losses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.functions.columns import qcol

SEED = 42
BUCKET_ROWS = 4096


def _digest(key: str, *salt: str) -> Column:
    return F.md5(F.concat_ws("|", *[F.lit(s) for s in salt], F.coalesce(qcol(key).cast("string"), F.lit(""))))


def bucket_of(key: str, buckets: int) -> Column:
    """A row's bucket: first 7 hex digits of md5(key as text) mod ``buckets``."""
    return F.conv(F.substring(_digest(key), 1, 7), 16, 10).cast("bigint") % buckets


def permuted(df: DataFrame, features: list[str], key: str, buckets: int, seed: int = SEED) -> DataFrame:
    """``df`` with ``_permuted``: a struct with the value that each feature gets from another row of the bucket.

    ``key`` tells rows apart; rows that share one are told apart by the feature's value."""
    df = df.withColumn("_bucket", bucket_of(key, buckets))
    taken = []
    for f in features:
        w = Window.partitionBy("_bucket").orderBy(_digest(key, str(seed), f), qcol(f))
        last = F.row_number().over(w) == F.count(F.lit(1)).over(Window.partitionBy("_bucket"))
        first = F.first(qcol(f)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        taken.append(F.when(last, first).otherwise(F.lead(qcol(f)).over(w)).alias(f))
    return df.withColumn("_permuted", F.struct(*taken)).drop("_bucket")


def squared_error(label: Column, prediction: Column) -> Column:
    return (label - prediction) * (label - prediction)


def log_loss(label: Column, probability: Column, least: float = 1e-15) -> Column:
    """Of a 0/1 label and the probability of 1."""
    p = F.greatest(F.least(probability, F.lit(1.0 - least)), F.lit(least))
    return -F.log(F.when(label == 1, p).otherwise(1.0 - p))


def permutation_importance(df: DataFrame, predict: Callable[[DataFrame], DataFrame], features: list[str], label: str,
                           key: str, loss: Callable[[Column, Column], Column] = squared_error, prediction: str = "prediction",
                           buckets: int | None = None, seed: int = SEED) -> DataFrame:
    """(``feature``, ``loss``, ``increase``): the mean loss with each feature permuted, and by how much it
    is over the loss of the rows as they are. ``predict`` adds the column ``prediction``.

    ``buckets`` defaults to one for every ``BUCKET_ROWS`` rows, which counts them. Rows whose label or
    prediction is null do not count."""
    if buckets is None:
        buckets = -(-df.count() // BUCKET_ROWS) or 1
    rows = permuted(df, features, key, buckets, seed)
    tags = F.explode(F.array(F.lit(None).cast("string"), *[F.lit(f) for f in features]))
    rows = rows.withColumn("_feature", tags)
    columns = [F.when(F.col("_feature") == c, F.col("_permuted")[c]).otherwise(qcol(c)).alias(c) if c in features else qcol(c)
               for c in df.columns]
    scored = predict(rows.select(*columns, "_feature"))
    losses = scored.groupBy("_feature").agg(F.avg(loss(qcol(label), qcol(prediction))).alias("loss"))
    base = losses.where("_feature IS NULL").select(F.col("loss").alias("base")).scalar()
    return losses.where("_feature IS NOT NULL").select(F.col("_feature").alias("feature"), "loss",
                                                       (F.col("loss") - base).alias("increase"))
