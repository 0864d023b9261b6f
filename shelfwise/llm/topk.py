"""Exact top-k search by inner product with an impact-ordered, score-at-a-time index.

Vectors are quantised to integers. A block of candidates is indexed by
postings: for every dimension, the rows in order of their component. A
query's impact of a posting is its component times the row's, counted from
the dimension's smallest so that none is negative. Postings are taken in
bands of falling impact over all dimensions at once; each adds to its row's
accumulator. After a band with least impact t a row can still gain less than
t for each dimension not seen yet. When the k-th best sum proves that few
rows can still be among the best, those are rescored exactly; the search
stops on that proof only, at the latest when every posting is read.

Scale: candidates and queries are dealt to blocks of bounded expected size by
a hash of the id, and every block of queries meets every block of candidates
in a task of its own; each returns its k best for a query, and a window with
a pushed-down limit merges them. No vector is broadcast. Equal vectors are
spread like any others. The work is the number of queries times the number
of rows, which is what the exact result asks for.

Nulls and edge cases: a vector that is null, empty or holds a null or non-finite
component takes no part, nor does a row with a null id. Ids are keys: of
rows that repeat one, the smallest vector counts. A query meets vectors of
its own length only. Ties go to the smaller id. With fewer than k candidates
all are returned; an empty table gives an empty result. Other columns are not
read. Sums of impacts must fit 38 bits for the index; where they might not,
a block's rows are all scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.common import col, cut_lineage, ship_code

BLOCK = 16384        # candidates indexed together
QUERIES = 16384      # queries that meet a block in one task
BANDS = (0.2, 0.12, 0.08, 0.04, 0.0)  # least impact of each band in parts of the largest
RESCORE = 0.25       # share of a block's rows that is scored exactly rather than read on
_SEEN = float(1 << 40)  # one posting read, in the same accumulator as the sum of impacts


class ImpactIndex:
    """Postings of one block: ``ids`` (n) and integer ``vectors`` (n x d)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, d = vectors.shape
        order = np.argsort(vectors, axis=0, kind="stable")
        self.row = order.T.ravel()
        value = np.take_along_axis(vectors, order, axis=0).T.ravel()
        self.value = value.astype(np.float64)
        self.plain = vectors.astype(np.float64)
        self.gain, self.read = np.empty(n * d), np.empty(n * d, dtype=self.row.dtype)  # room for one band
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        self.least = int(self.low.min())
        self.span = int(self.high.max()) - self.least + 3
        self.dim = np.arange(d)
        self.key = np.repeat(self.dim, n) * self.span + (value - self.least + 1)  # ascending

    def _upto(self, dim: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Postings before the first one of ``dim`` with at least ``value``."""
        value = np.clip(value - self.least + 1, 0, self.span - 1)
        return np.searchsorted(self.key, dim * self.span + value)

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows (of this block) and scores of the k best, without id ``own``."""
        n = len(self.ids)
        others = self.ids != own
        rows = np.flatnonzero(others)
        reach = int(np.abs(query).sum()) * max(abs(self.least), int(self.high.max()), 1)
        dim = np.flatnonzero(query)
        if n > k and len(dim) and reach < 1 << 38 and len(dim) < 1 << 12:
            rows = self._possible(query, dim, others, k)
        # Floats of 53 bits hold these products exactly and multiply faster than longs.
        exact = reach < 1 << 53
        score = (self.plain[rows] @ query.astype(np.float64)).astype(np.int64) if exact else self.vectors[rows] @ query
        if len(rows) > 4 * k:  # ties included
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[keep], score[keep]
        pick = np.lexsort((self.ids[rows], -score))[:k]
        return rows[pick], score[pick]

    def _possible(self, query: np.ndarray, dim: np.ndarray, others: np.ndarray, k: int) -> np.ndarray:
        n, q = len(self.ids), query[dim]
        up = q > 0
        base = np.where(up, q * self.low[dim], q * self.high[dim])
        tops = np.where(up, q * self.high[dim], q * self.low[dim]) - base
        most = int(tops.max())
        sums = np.zeros(n)
        begin, end = dim * n, (dim + 1) * n
        done = np.where(up, end, begin)
        bound, weight, less = -1.0, q.astype(np.float64).tolist(), (_SEEN - base).tolist()
        gain, rows_read = self.gain, self.read
        for band in BANDS:
            t = int(most * band)
            # impact >= t: the large components for a positive weight, the small for a negative
            edge = np.where(up, -(-(t + base) // q), (t + base) // q + 1)
            now = np.clip(self._upto(dim, edge), begin, end)
            first, last = np.where(up, now, done), np.where(up, done, now)
            size = np.maximum(last - first, 0)
            filled = 0
            for a, m, w, c in zip(first.tolist(), size.tolist(), weight, less):
                part = gain[filled:filled + m]
                np.multiply(self.value[a:a + m], w, out=part)
                part += c
                rows_read[filled:filled + m] = self.row[a:a + m]
                filled += m
            sums += np.bincount(rows_read[:filled], gain[:filled], minlength=n)
            seen = np.floor(sums / _SEEN)
            total = sums - seen * _SEEN
            total[~others] = -1.0e300
            done = now
            # The whole sums of the rows that lead now are a bound that others must reach.
            lead = np.argpartition(total, n - k)[n - k:]
            whole = self.plain[lead[others[lead]]] @ query - int(base.sum())
            if len(whole) == k:
                bound = max(bound, float(whole.min()))
            # A dimension gains a row less than t, or its own largest impact if none reached t.
            large = tops >= t
            rows = np.flatnonzero((total + (int(large.sum()) - seen) * t + int(tops[~large].sum()) >= bound) & others)
            if len(rows) <= max(RESCORE * n, 4 * k):
                break
        return rows


def quantise(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of every component, as long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def usable(vector: Column) -> Column:
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                     | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(wrong, F.lit(True))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(``query_id``, ``rank`` from 1, id, ``score``): the k best rows for every row with ``is_query``."""
    spark = vectors.sparkSession
    ship_code(spark)
    rows = (vectors.where(usable(col(vector_col)) & col(id_col).isNotNull())
            .select(col(id_col).cast("long").alias("id"), quantise(col(vector_col)).alias("v"),
                    F.coalesce(is_query, F.lit(False)).alias("asks")))
    rows = cut_lineage(rows.groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
                       .withColumn("d", F.size("v")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    n_blocks, n_asks = -(-size["n"] // block) or 1, -(-size["q"] // queries) or 1
    spread = F.xxhash64("id")
    mine = F.pmod(spread, F.lit(n_blocks)).cast("int")
    asked = F.pmod(F.xxhash64(F.col("id"), F.lit("q")), F.lit(n_asks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    there = rows.select("id", "v", "d", mine.alias("b"), every(n_asks).alias("a"))
    here = rows.where("asks").select("id", "v", "d", asked.alias("a"), every(n_blocks).alias("b"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            index = ImpactIndex(*_arrays(left))
            for own, query in zip(*_arrays(right)):
                at, score = index.best(query, own, k)
                found.append((np.full(len(at), own), index.ids[at], score))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "id", "score"])

    best = (there.groupBy("b", "a", "d").cogroup(here.groupBy("b", "a", "d"))
            .applyInArrow(meet, "query_id long, id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id")))
    return (best.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


def _arrays(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = t.column("id").to_numpy()
    flat = t.column("v").combine_chunks().flatten().to_numpy()
    return ids, flat.reshape(len(ids), -1)
