"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of copies of each of its documents that
gives it its target share of the mix. A document's number of copies is drawn
from the Poisson distribution with that rate by inverting it at a number in
[0, 1) that is a hash of seed and id: no state, the same on every run and
after any lost task. Copies are then dealt to partitions and ordered by a
second hash, which is one shuffle of the mix.

Scale: sizes of sources are summed on the map side. A table with one row for
each source (its rate and distribution) is joined by source: it is sent to the
tasks if it holds at most ``SMALL`` numbers, so that texts move once, when their
copies are dealt; above that a source with a third of all rows is an ordinary
skewed key, split by adaptive execution. Copies are spread by hash, so no
source, document or group of copies stays together.

Nulls and edge cases: documents without a source are a source of their own
(the weight for ``None``); without weight a source has rate 0. A null text
has size 0, and a source of size 0 has rate 0. A null id draws by its text.
Rows that repeat an id (or, without id, a text) draw the same number. An
empty table gives an empty mix. Input columns named like an output column
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import col, cut_lineage, ship_code, without

SEED = 2024
ALPHA = 0.5    # default weights: size to this power
EPOCHS = 1.0   # size of the mix in sizes of the input
SMALL = 1 << 20  # numbers in all distributions that are sent to every task (8 MB)


def poisson_cdf(rate: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... until nothing of the distribution is left
    that a number with 52 binary digits could tell."""
    if not rate > 0:
        return [1.0]
    most = int(rate + 12 * np.sqrt(rate) + 40)
    k = np.arange(most + 1)
    logs = -rate + k * np.log(rate) - np.array([lgamma(i + 1.0) for i in k])
    cdf = np.minimum(np.cumsum(np.exp(logs)), 1.0)
    return cdf[:int(np.searchsorted(cdf, 1.0 - 2.0 ** -53)) + 1].tolist()


def uniform(digest: Column) -> Column:
    """52 bits of a hexadecimal digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / 2.0 ** 52


def rates(docs: DataFrame, source_col: str = "source", text_col: str = "text",
          weights: dict[str | None, float] | None = None, alpha: float = ALPHA,
          epochs: float = EPOCHS) -> DataFrame:
    """(source, size, weight, rate): size in characters; the weights add up to 1."""
    sizes = (docs.groupBy(col(source_col).alias("source"))
             .agg(F.coalesce(F.sum(F.char_length(col(text_col)).cast("double")), F.lit(0.0)).alias("size")))
    if weights is None:
        raw = F.pow("size", F.lit(alpha))
    else:
        raw = F.lit(0.0)
        for name, w in weights.items():
            raw = F.when(F.col("source").eqNullSafe(F.lit(name)), float(w)).otherwise(raw)
    sizes = cut_lineage(sizes.withColumn("raw", F.when(F.col("size") > 0, raw).otherwise(0.0)))
    total = sizes.agg(F.sum("size").alias("all"), F.sum("raw").alias("every")).first()
    if not total["every"]:
        return sizes.select("source", "size", F.lit(0.0).alias("weight"), F.lit(0.0).alias("rate"))
    weight = F.col("raw") / total["every"]
    rate = F.col("raw") * (total["all"] * epochs) / (F.col("size") * total["every"])
    return sizes.select("source", "size", weight.alias("weight"), F.when(F.col("size") > 0, rate).otherwise(0.0).alias("rate"))


def _with_distribution(r: DataFrame) -> DataFrame:
    ship_code(r.sparkSession)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield p.assign(cdf=[poisson_cdf(x) for x in p["rate"]])

    kind = r.schema["source"].dataType.simpleString()
    return r.select("source", "rate").mapInPandas(run, f"source {kind}, rate double, cdf array<double>")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: dict[str | None, float] | None = None, alpha: float = ALPHA, epochs: float = EPOCHS,
        seed: int = SEED) -> DataFrame:
    """The columns of ``docs``, once for each copy, with ``copy`` (from 1), ``n_copies``
    and ``shuffle_key``, in hashed order."""
    docs = without(docs, ["copy", "n_copies", "shuffle_key"])
    table = cut_lineage(_with_distribution(rates(docs, source_col, text_col, weights, alpha, epochs)))
    if (table.agg(F.sum(F.size("cdf") + 8).alias("n")).first()["n"] or 0) <= SMALL:
        table = F.broadcast(table)
    row = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row")
    who = F.coalesce(col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(col(text_col), F.lit("")))))
    drawn = docs.select(row, col(source_col).alias("from"), who.alias("who"))
    drawn = drawn.join(table, F.col("from").eqNullSafe(F.col("source")))
    u = uniform(F.md5(F.concat_ws("|", F.lit(str(seed)), "who")))
    drawn = (drawn.withColumn("u", u)
             .withColumn("n_copies", F.size(F.filter("cdf", lambda c: c <= F.col("u"))).cast("long"))
             .where("n_copies > 0")
             .select("row", "who", "n_copies", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))).alias("copy"))
             .withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(str(seed + 1)), "who", F.col("copy").cast("string")))))
    dealt = drawn.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return dealt.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)],
                        F.col("copy").cast("long").alias("copy"), "n_copies", "shuffle_key")
