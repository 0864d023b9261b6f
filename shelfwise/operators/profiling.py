"""Validation and profiling tables (V1-V5).

The reference prints these; here each is a small DataFrame so a job can
write, show or assert on it. Every statistic is one aggregate pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import qcol

# The six features the reference profiles after building gold.
PROFILE_COLUMNS = ("daily_sales_velocity", "stock_on_hand", "procurement_lead_time",
                   "order_buffer_index", "safety_stock", "reorder_point")


def row_counts(**tables: DataFrame) -> DataFrame:
    """V1: (table, rows) for each named DataFrame; one count per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def risk_summary(gold: DataFrame, label: str = "stockout_risk") -> DataFrame:
    """V2: products at risk / safe, with percentages to one decimal."""
    total = F.count(F.lit(1))
    risk = F.count_if(qcol(label) == 1)
    safe = F.count_if(qcol(label) == 0)
    denom = F.greatest(total, F.lit(1))
    return gold.agg(
        total.alias("total"), risk.alias("at_risk"), safe.alias("safe"),
        F.round(100.0 * risk / denom, 1).alias("pct_at_risk"),
        F.round(100.0 * safe / denom, 1).alias("pct_safe"),
    )


def profile(df: DataFrame, cols=PROFILE_COLUMNS) -> DataFrame:
    """V3: count, mean, sample stddev, min, max per column (long form).

    Same statistics as ``df.describe()`` but numeric, one row per column.
    One aggregate over the data; the unpivot runs on its single row.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = qcol(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("count"),
                              F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                              F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
                     for i, c in enumerate(cols)])
    return one.select(F.inline(rows))


def schema_table(df: DataFrame, spark: SparkSession | None = None, counts: bool = True) -> DataFrame:
    """V4: (position, column, type, nullable) of a DataFrame's schema, and
    with ``counts`` the number of non-null values per column (one
    aggregate pass over the data, unpivoted from its single row)."""
    fields = df.schema.fields
    if not counts:
        spark = spark or df.sparkSession
        rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(fields)]
        schema = T.StructType([T.StructField("position", T.IntegerType()),
                               T.StructField("column", T.StringType()),
                               T.StructField("type", T.StringType()),
                               T.StructField("nullable", T.BooleanType())])
        return spark.createDataFrame(rows, schema)
    one = df.agg(*[F.count(qcol(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                              F.lit(f.dataType.simpleString()).alias("type"),
                              F.lit(f.nullable).alias("nullable"), F.col(f"c{i}").alias("non_nulls"))
                     for i, f in enumerate(fields)])
    return one.select(F.inline(rows))


def sample_rows(df: DataFrame, n: int = 5, order_by: list[str] | None = None,
                cols: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a stated order (top-k per task, then merged).

    The reference shows "any n rows"; an order makes it reproducible.
    """
    order_by = order_by or [df.columns[0]]
    out = df.select(*[qcol(c) for c in cols]) if cols else df
    return out.orderBy(*[qcol(c).asc_nulls_last() for c in order_by]).limit(n)
