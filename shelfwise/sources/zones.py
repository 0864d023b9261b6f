"""Bucketed zones (S7, S9): tables laid out by product, so gold joins need no exchange.

A bucketed table keeps the rows of a product in the bucket that the hash of its
key says. Aggregates and joins on that key then read bucket beside bucket;
what a shuffle would do on every run is done once, when the table is written.

A bucket is read by one task, so a table in which one product may hold a third
of all rows (raw movements) is better stored as the partials of
``operators.incremental``, a row for each product and span of days. They, the
inventory and the suppliers have a bounded number of rows for a product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.functions.columns import qcol


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
                   mode: str = "overwrite") -> None:
    """Save ``df`` as ``table``, in ``buckets`` files by the hash of ``key``, each sorted by it.

    Tables that are to be joined without an exchange need the same ``buckets`` and a key of the
    same type. ``path`` names the folder (default: the session's warehouse). One task writes a bucket."""
    w = df.repartition(buckets, qcol(key)).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    (w.option("path", path) if path else w).saveAsTable(table)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
