"""Silver cleaning: names, trimming, safe parsing, imputation, de-duplication.

Each step is one projection or one aggregate. Nothing is collected: the
median used for imputation is a scalar subquery over a mergeable sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import qcol, safe_timestamp
from shelfwise.functions.naming import normalize_columns
from shelfwise.operators.quantiles import exact_quantile

# Name keys that mark a datetime column, and the price
# columns tried in order (only the first one found is cleaned).
DATETIME_KEYS = ("date", "time", "created")
PRICE_CANDIDATES = ("price", "unit_price", "cost")
REJECTS = "_rejects"


def trim_strings(df: DataFrame, chars: str | None = None) -> DataFrame:
    """Trim every string column. Spaces only by default (like SQL
    ``trim``); pass ``chars`` (e.g. ``" \\t\\n"``) to strip more."""
    out = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.trim(c) if chars is None else F.btrim(c, F.lit(chars))
            out.append(c.alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def datetime_columns(df: DataFrame, keys=DATETIME_KEYS, exclude=()) -> list[str]:
    """String columns whose lower-cased name contains one of ``keys``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude
            and any(k in f.name.lower() for k in keys)]


def instants(df: DataFrame) -> list[str]:
    """Date and timestamp columns, in order: what says which of two rows is later."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def parse_datetimes(df: DataFrame, keys=DATETIME_KEYS, fmt: str | None = None,
                    exclude=()) -> DataFrame:
    """C4: string columns named like a date/time -> timestamp; bad text -> null."""
    targets = set(datetime_columns(df, keys, exclude))
    return df.select(*[safe_timestamp(df, c, fmt).alias(c) if c in targets else qcol(c)
                       for c in df.columns])


def _misread(df: DataFrame, fmt: str | None = None, exclude=(), quantity: str = "quantity") -> dict[str, tuple[str, Column]]:
    """Per text column that is to be parsed: the rule, and whether a text that is not blank breaks it."""
    there = {c: ("timestamp", (F.length(qcol(c)) > 0) & safe_timestamp(df, c, fmt).isNull())
             for c in datetime_columns(df, exclude=exclude)}
    if quantity in df.columns and isinstance(df.schema[quantity].dataType, T.StringType):
        there[quantity] = ("number", (F.length(qcol(quantity)) > 0) & qcol(quantity).try_cast("double").isNull())
    return there


def lost_counts(df: DataFrame, fmt: str | None = None, exclude=()) -> list[Column]:
    """An aggregate for each parsed column of a trimmed table: texts that are not blank and do not
    parse (C4 makes them null, C5 zero). Fit for ``DataFrame.observe``, so they cost no pass of their own."""
    return [F.count_if(bad).alias(c) for c, (_, bad) in _misread(df, fmt, exclude).items()]


def rejected_values(df: DataFrame, fmt: str | None = None, exclude=()) -> Column:
    """Array of (``column``, ``value``, ``rule``): what a row of a trimmed table loses in parsing."""
    each = [F.when(bad, F.struct(F.lit(c).alias("column"), qcol(c).alias("value"), F.lit(rule).alias("rule")))
            for c, (rule, bad) in _misread(df, fmt, exclude).items()]
    every = F.array(*each) if each else F.array().cast("array<struct<column:string,value:string,rule:string>>")
    return F.filter(every, lambda x: x.isNotNull())


def rejects(silver: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The quarantine table of a silver table cleaned with ``keep_rejects``: one row for each value
    that was lost (``key``, ``column``, ``value``, ``rule``)."""
    return silver.select(qcol(key), F.inline(REJECTS))


def fill_quantity(df: DataFrame, col: str = "quantity") -> DataFrame:
    """The column named exactly ``col`` -> double, null/unparsable -> 0.0."""
    if col not in df.columns:
        return df
    return df.withColumn(col, F.coalesce(qcol(col).try_cast("double"), F.lit(0.0)))


def _part(df: DataFrame, name: str) -> Column:
    """One value so that no two rows read alike: ``n`` for null, else the text's
    length in bytes and the text. Instants count microseconds, whatever the
    session's time zone."""
    c = qcol(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        c = F.unix_micros(c)
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("n"))


def content_hash(df: DataFrame, cols: list[str] | None = None) -> Column:
    """sha-256 of the row: equal for equal rows only, and the same in every session."""
    return F.sha2(F.concat(*[_part(df, c) for c in cols or df.columns]), 256)


def ensure_transaction_id(df: DataFrame, method: str = "hash") -> DataFrame:
    """Add ``transaction_id`` when absent.

    ``hash`` (default): content hash, so equal rows get equal ids and re-runs
    are stable. ``uuid``: a random id per row, as the reference does.
    """
    if "transaction_id" in df.columns:
        return df
    if method == "uuid":
        return df.withColumn("transaction_id", F.expr("uuid()"))
    if method != "hash":
        raise ValueError("method must be 'hash' or 'uuid'")
    return df.withColumn("transaction_id", content_hash(df, [c for c in df.columns if c != REJECTS]))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop fully equal rows (one aggregate, reduced map side)."""
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (desc, nulls
    last), then by every remaining column (desc). Deterministic for any
    layout; null keys form one group, as in ``dropDuplicates``.

    One aggregate of ``max(struct(...))``: reduced map side, so a key holding
    a large share of rows never lands whole in one task; its output is
    hash-partitioned and sorted by the key, which a following sort-merge
    join on the key reuses without a new exchange.
    """
    order_by = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if not order_by and not rest:
        return df.select(*[qcol(k) for k in keys]).distinct()
    parts = []
    for i, c in enumerate(order_by):
        parts += [qcol(c).isNotNull().alias(f"_o{i}n"), qcol(c).alias(f"_o{i}")]
    for i, c in enumerate(rest):
        parts += [qcol(c).isNotNull().alias(f"_r{i}n"), qcol(c).alias(f"_r{i}")]
    agg = df.groupBy(*[qcol(k) for k in keys]).agg(F.max(F.struct(*parts)).alias("_best"))
    out = []
    for c in df.columns:
        if c in keys:
            out.append(qcol(c))
        elif c in order_by:
            out.append(F.col(f"_best._o{order_by.index(c)}").alias(c))
        else:
            out.append(F.col(f"_best._r{rest.index(c)}").alias(c))
    return agg.select(*out)


def price_column(df: DataFrame, candidates=PRICE_CANDIDATES) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def cast_price(df: DataFrame, candidates=PRICE_CANDIDATES) -> DataFrame:
    """The first existing price candidate -> double (bad text -> null)."""
    col = price_column(df, candidates)
    if col is None:
        return df
    return df.withColumn(col, qcol(col).try_cast("double"))


def impute_median(df: DataFrame, col: str, accuracy: int = 10000, method: str = "approximate") -> DataFrame:
    """Nulls of ``col`` -> median of the column.

    By default the approximate (lower) median: an uncorrelated scalar subquery
    over ``percentile_approx`` (a mergeable sketch, partially aggregated per
    task): no collect, no cross join. ``method`` "lower" or "interpolated" takes
    the exact one (see ``quantiles``). An all-null column stays null.
    """
    if method == "approximate":
        med = df.agg(F.percentile_approx(qcol(col), 0.5, accuracy).alias("m")).scalar()
    elif method in ("lower", "interpolated"):
        med = exact_quantile(df, col, 0.5, method == "interpolated")
    else:
        raise ValueError("method must be 'approximate', 'lower' or 'interpolated'")
    return df.withColumn(col, F.coalesce(qcol(col), med))


def conform_supplier_key(df: DataFrame) -> DataFrame:
    """C11: ``id`` -> ``supplier_id`` when the latter is missing."""
    if "supplier_id" not in df.columns and "id" in df.columns:
        return df.withColumnRenamed("id", "supplier_id")
    return df


def clean_transactions(df: DataFrame, id_method: str = "hash", trim_chars: str | None = None,
                       fmt: str | None = None, exclude=(), keep_rejects: bool = False) -> DataFrame:
    """Normalize -> trim -> parse datetimes -> quantity -> dedup -> id.

    Of rows that repeat an ``id`` the latest stays, by the date and timestamp
    columns as they are after parsing (so text and typed dates give the same
    survivor). De-duplication runs before a missing ``transaction_id`` is added (with a
    random id added first, no two rows would ever be equal). With ``keep_rejects`` the texts
    that did not parse stay beside each row (``_rejects``, see ``rejects``); of rows that are equal
    otherwise, the larger list.
    """
    df = normalize_columns(df)
    df = trim_strings(df, trim_chars)
    if keep_rejects:
        df = df.withColumn(REJECTS, rejected_values(df, fmt, exclude))
    df = parse_datetimes(df, fmt=fmt, exclude=exclude)
    df = fill_quantity(df)
    if "id" in df.columns:
        df = dedup_by_key(df, ["id"], order_by=instants(df))
    elif keep_rejects:
        df = dedup_by_key(df, [c for c in df.columns if c != REJECTS])
    else:
        df = dedup_rows(df)
    return ensure_transaction_id(df, id_method)


def clean_inventory(df: DataFrame, trim_chars: str | None = None, accuracy: int = 10000,
                    parse_dates: bool = False, fmt: str | None = None) -> DataFrame:
    """Normalize -> trim -> price cast + median fill -> dedup.

    Dates are left as they are unless ``parse_dates`` (gold parses them
    safely either way).
    """
    df = normalize_columns(df)
    df = trim_strings(df, trim_chars)
    if parse_dates:
        df = parse_datetimes(df, fmt=fmt)
    col = price_column(df)
    if col is not None:
        df = impute_median(cast_price(df), col, accuracy)
    return dedup_rows(df)


def clean_suppliers(df: DataFrame, trim_chars: str | None = None) -> DataFrame:
    """C14: normalize -> trim -> supplier key -> dedup."""
    df = normalize_columns(df)
    df = trim_strings(df, trim_chars)
    df = conform_supplier_key(df)
    return dedup_rows(df)
