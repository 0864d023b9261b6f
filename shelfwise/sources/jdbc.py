"""JDBC source and sink.

The reference read the whole table through one pandas connection. Here
Spark reads it in ``num_partitions`` parallel range queries over a numeric
(or date) column, so the extract scales with the executors instead of one
client process. URL, user and password come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              fetch_size: int = 10000, properties: dict | None = None) -> DataFrame:
    """``SELECT * FROM table`` as a DataFrame, optionally in parallel ranges.

    Bounds only decide the stride of the ranges; rows outside them are still
    read (by the first and last partitions). Where they are not given, the
    database finds them (one ``min``/``max`` query); an empty table is read as
    a single query.
    """
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", fetch_size))
    if partition_column:
        if not num_partitions:
            raise ValueError("partition_column needs num_partitions")
        if lower_bound is None or upper_bound is None:
            lower_bound, upper_bound = column_bounds(spark, url, table, partition_column, properties)
    if partition_column and lower_bound is not None:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def column_bounds(spark: SparkSession, url: str, table: str, column: str, properties: dict | None = None) -> tuple:
    """(min, max) of a column, computed by the database; the name is quoted as Spark's
    own JDBC reads quote it."""
    q = "`" if url.startswith(("jdbc:mysql", "jdbc:mariadb")) else '"'
    name = q + column.replace(q, 2 * q) + q
    r = (spark.read.format("jdbc").option("url", url)
         .option("query", f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}"))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return tuple(r.load().first())


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               batch_size: int = 10000, properties: dict | None = None) -> None:
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
