"""Native column expressions shared by the operators.

Spark 4 runs with ANSI mode on, where a bad cast raises. The reference was
written for non-ANSI casts ("bad value -> null"); every parse here is the
``try_`` variant so the meaning is kept without switching ANSI off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Transaction types counted as a sale (upper-cased match).
SALE_LABELS = ("SALE", "SALES", "OUT", "KELUAR")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def qcol(name: str) -> Column:
    """Column by exact name (back-quoted, so dots and spaces are safe)."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_double(df: DataFrame, name: str) -> Column:
    """Cast to double; unparsable text becomes null (never raises)."""
    t = dtype_of(df, name)
    c = qcol(name)
    if isinstance(t, T.DoubleType):
        return c
    if isinstance(t, _NUMERIC):
        return c.cast("double")
    return c.try_cast("double")


def safe_timestamp(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    """String -> timestamp with the default (or given) pattern; bad text -> null."""
    t = dtype_of(df, name)
    c = qcol(name)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(t, T.DateType):
        return c.cast("timestamp")
    if fmt is None:
        return F.try_to_timestamp(c.cast("string"))
    return F.try_to_timestamp(c.cast("string"), F.lit(fmt))


def safe_date(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    """Calendar day of a date/timestamp/string column; bad text -> null."""
    t = dtype_of(df, name)
    c = qcol(name)
    if isinstance(t, T.DateType):
        return c
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    return F.to_date(safe_timestamp(df, name, fmt))


def is_sale(type_col: Column, labels=SALE_LABELS) -> Column:
    """True when upper(type) is a sale label; a null type is not a sale."""
    return F.coalesce(F.upper(type_col).isin(*labels), F.lit(False))


def nan_to_null(c: Column) -> Column:
    """NaN -> null for a double column (pandas' NaN means 'missing')."""
    return F.when(~F.isnan(c), c)
