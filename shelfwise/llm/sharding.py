"""Sharding by extendible hashing (native).

A document's place is the hash of its key, read bit by bit. The directory
starts as one bucket; a bucket that exceeds the byte limit splits on the next
bit, the others stay, until every shard fits. So a shard is named by the
shortest hash prefix whose documents fit together, shards differ in depth,
and documents with one key stay together as long as they fit.

The split is found ``ROUND`` bits at a time from sums, not by moving rows:
bytes are summed by prefix cell (map side first, at most 2**ROUND cells for
each bucket that is still too large), all prefixes of the cells are summed
once, and every cell takes its shortest prefix that fits. Only rows of cells
that are still too large go on to the next bits. The driver learns whether
there are any.

A key's 128 bits are followed by 128 bits of the row itself, so that even a
key held by a third of all rows is spread over shards that fit; a document
that alone exceeds the limit is a shard of its own (``oversize``).

Scale: texts are read once, for their length. What goes on is a row of a
hundred bytes for each document. ``write_shards`` writes every text three
times: with a row number, on the way to its shard's name by that number, and
on the way to its shard.

Nulls and edge cases: a null text has no bytes. A null key is placed by its
text. Rows that repeat a key are rows of their own. An empty table has no
shards. Other columns are not read by ``assign``; ``write_shards`` keeps them,
but for one named like a column of the assignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import col, cut_lineage

ROUND = 12     # bits decided at once: three hexadecimal digits
ROUNDS = 21    # of 256 bits


def _bits(digest: str, n: int) -> Column:
    """The ``n``-th twelve bits of a hexadecimal digest as text."""
    return F.lpad(F.conv(F.substring(digest, 3 * n + 1, 3), 16, 2), ROUND, "0")


def _placed(docs: DataFrame, key_col: str, text_col: str, row: Column) -> DataFrame:
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    key = F.coalesce(col(key_col).cast("string"), F.concat(F.lit("text:"), F.md5(text)))
    rows = docs.select(col(key_col).alias("key"), F.octet_length(text).cast("long").alias("bytes"),
                       F.md5(key).alias("h"), row.alias("row"))
    # Written out, the row number is fixed, whatever task runs again.
    rows = cut_lineage(rows)
    return rows.withColumn("h", F.concat("h", F.md5(F.col("row").cast("string"))))


def assign(docs: DataFrame, limit: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its key, ``bytes``, ``shard`` (the bits of its prefix), ``depth``,
    ``shard_bytes``, ``shard_docs`` and ``oversize``."""
    return _assigned(docs, limit, key_col, text_col, F.monotonically_increasing_id()).select(
        F.col("key").alias(key_col), "bytes", "shard", "depth", "shard_bytes", "shard_docs", "oversize")


def _assigned(docs: DataFrame, limit: int, key_col: str, text_col: str, row: Column) -> DataFrame:
    """``assign`` with the key as ``key`` and the number of the row as ``row``."""
    rows = _placed(docs, key_col, text_col, row).withColumn("path", F.lit(""))
    done = []
    for n in range(ROUNDS):
        rows = rows.withColumn("path", F.concat("path", _bits("h", n)))
        cells = rows.groupBy("path").agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        first = 0 if n == 0 else ROUND * n + 1
        depths = F.sequence(F.lit(first), F.lit(ROUND * (n + 1)))
        prefixes = cells.select("path", "b", "n", F.explode(depths).alias("depth")) \
            .withColumn("prefix", F.expr("substring(path, 1, depth)"))
        sums = prefixes.groupBy("prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)
        leaf = prefixes.join(sums.where(fits), "prefix").groupBy("path").agg(
            F.min(F.struct("depth", F.col("prefix").alias("shard"), "shard_bytes", "shard_docs")).alias("leaf"))
        directory = cut_lineage(cells.select("path").join(leaf, "path", "left"))
        done.append(rows.join(directory.where("leaf is not null"), "path").select("row", "key", "bytes", "leaf.*"))
        large = directory.where("leaf is null").select("path")
        if large.isEmpty():
            break
        rows = cut_lineage(rows.join(large, "path", "left_semi"))
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out.select("row", "key", "bytes", "shard", "depth", "shard_bytes", "shard_docs",
                      (F.col("shard_bytes") > limit).alias("oversize"))


def directory(assigned: DataFrame) -> DataFrame:
    """The shards: ``shard``, ``depth``, ``shard_bytes``, ``shard_docs``, ``oversize``."""
    return assigned.select("shard", "depth", "shard_bytes", "shard_docs", "oversize").distinct()


def write_shards(docs: DataFrame, path: str, limit: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write every document once to the folder of its shard (``shard=BITS``), a file for
    each shard, and return the directory. Keys may repeat or be null."""
    row = "_row"
    while row in map(str.lower, docs.columns):
        row += "_"
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    where = cut_lineage(_assigned(numbered, limit, key_col, text_col, F.col(row)))
    kept = numbered.select(*[col(c) for c in numbered.columns if c.lower() != "shard"])
    rows = kept.join(where.select(F.col("row").alias(row), "shard"), row).drop(row)
    rows.repartition("shard").write.partitionBy("shard").parquet(path)
    return directory(where)
