"""Silver cleaning queries (C1-C14) over the dirty fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.naming import normalize_columns
from shelfwise.operators import cleaning as cl
from shelfwise.operators import features as fe
from shelfwise.operators.quantiles import exact_quantile
from shelfwise.plans.catalog import register
from shelfwise.plans.q_gold import gold_sql
from shelfwise.sources import fixtures as fx

# DuckDB projections of the dirty views after name normalization.
_INV_EACH = """"Product ID" AS product_id, "Product Name" AS product_name, "Stock-Quantity" AS stock_quantity,
       "Reorder Level" AS reorder_level, " Unit Price" AS unit_price, "Date  Received" AS date__received,
       "Last/Order Date" AS last_order_date"""
_INV_COLLAPSE = _INV_EACH.replace("AS date__received", "AS date_received")
_INV_TRIMMED = """"Product ID" AS product_id, trim("Product Name") AS product_name, "Stock-Quantity" AS stock_quantity,
       "Reorder Level" AS reorder_level, trim(" Unit Price") AS unit_price, trim("Date  Received") AS date__received,
       trim("Last/Order Date") AS last_order_date"""
_TRX_NORM = """" Product ID" AS product_id, "Transaction Type" AS transaction_type, "Quantity" AS quantity,
       "Transaction Date" AS transaction_date, "Supplier-ID" AS supplier_id"""



def _id_sql(*columns: str) -> str:
    """The content id: each value as its length in bytes, a colon and its text; null as n."""
    parts = (f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in columns)
    return f"sha256({' || '.join(parts)})"


_SILVER_TRX_SQL = f"""SELECT *, {_id_sql('product_id', 'transaction_type', 'quantity', 'epoch_us(transaction_date)',
                                    'supplier_id')} AS transaction_id
  FROM (SELECT DISTINCT " Product ID" AS product_id, trim("Transaction Type") AS transaction_type,
               coalesce(TRY_CAST("Quantity" AS DOUBLE), 0.0::DOUBLE) AS quantity,
               TRY_CAST(trim("Transaction Date") AS TIMESTAMP) AS transaction_date, "Supplier-ID" AS supplier_id
        FROM movements_dirty)"""

_SILVER_INV_SQL = f"""SELECT DISTINCT product_id, product_name, stock_quantity, reorder_level,
       coalesce(unit_price, (SELECT quantile_disc(p, 0.5) FROM (SELECT TRY_CAST(trim(" Unit Price") AS DOUBLE) AS p
                                                              FROM inventory_dirty))) AS unit_price,
       date__received, last_order_date
  FROM (SELECT {_INV_TRIMMED.replace('trim(" Unit Price") AS unit_price', 'TRY_CAST(trim(" Unit Price") AS DOUBLE) AS unit_price')}
        FROM inventory_dirty)"""


def _norm(df, collapse=False):
    return normalize_columns(df, collapse)


@register("normalize_each", fx.with_views("inventory_dirty") + f"SELECT {_INV_EACH} FROM inventory_dirty")
def normalize_each(spark, d):
    """Strip, lower, each space / '-' / '/' -> '_'."""
    return _norm(fx.inventory_dirty(spark, d))


@register("normalize_collapse", fx.with_views("inventory_dirty") + f"SELECT {_INV_COLLAPSE} FROM inventory_dirty")
def normalize_collapse(spark, d):
    """Strip, lower, a run of whitespace / '-' / '/' -> one '_'."""
    return _norm(fx.inventory_dirty(spark, d), collapse=True)


@register("trim_strings", fx.with_views("inventory_dirty") + f"SELECT {_INV_TRIMMED} FROM inventory_dirty")
def trim_strings(spark, d):
    """Trim every string column (spaces)."""
    return cl.trim_strings(_norm(fx.inventory_dirty(spark, d)))


@register("parse_datetimes", fx.with_views("movements_dirty") + """SELECT " Product ID" AS product_id,
       trim("Transaction Type") AS transaction_type, "Quantity" AS quantity,
       TRY_CAST(trim("Transaction Date") AS TIMESTAMP) AS transaction_date, "Supplier-ID" AS supplier_id
FROM movements_dirty""")
def parse_datetimes(spark, d):
    """C4: text columns named like a date/time -> timestamp; 'bad' -> null."""
    return cl.parse_datetimes(cl.trim_strings(_norm(fx.movements_dirty(spark, d))))


@register("fill_quantity", fx.with_views("movements_dirty") + f"""SELECT * REPLACE
       (coalesce(TRY_CAST(quantity AS DOUBLE), 0.0::DOUBLE) AS quantity)
FROM (SELECT {_TRX_NORM} FROM movements_dirty)""")
def fill_quantity(spark, d):
    """``quantity`` -> double; 'n/a' and null -> 0.0."""
    return cl.fill_quantity(_norm(fx.movements_dirty(spark, d)))


@register("transaction_id_hash", fx.with_views("movements") + f"""SELECT *,
       {_id_sql('product_id', 'transaction_type', 'quantity_change', 'transaction_date', 'supplier_id')} AS transaction_id
FROM movements""")
def transaction_id_hash(spark, d):
    """Content-hash transaction id (sha-256 of the row text)."""
    return cl.ensure_transaction_id(fx.movements(spark, d))


@register("dedup_rows", fx.with_views("movements_dirty") + f"SELECT DISTINCT {_TRX_NORM} FROM movements_dirty")
def dedup_rows(spark, d):
    """Drop fully equal rows (the dirty export repeats some)."""
    return cl.dedup_rows(_norm(fx.movements_dirty(spark, d)))


@register("price_cast_impute", fx.with_views("inventory_dirty") + """, t AS (
  SELECT "Product ID" AS product_id, TRY_CAST(trim(" Unit Price") AS DOUBLE) AS p FROM inventory_dirty)
SELECT product_id, coalesce(p, (SELECT quantile_disc(p, 0.5) FROM t)) AS unit_price FROM t""")
def price_cast_impute(spark, d):
    """Price text -> double, gaps -> approximate median."""
    inv = cl.trim_strings(_norm(fx.inventory_dirty(spark, d)))
    col = cl.price_column(inv)
    return cl.impute_median(cl.cast_price(inv), col).select("product_id", col)


@register("conform_supplier_key", fx.with_views("suppliers_global")
          + "SELECT id AS supplier_id, supplier_name, average_lead_time_days FROM suppliers_global")
def conform_supplier_key(spark, d):
    """C11: a bare ``id`` becomes ``supplier_id``."""
    return cl.conform_supplier_key(fx.suppliers_global(spark, d))


@register("clean_transactions", fx.with_views("movements_dirty") + _SILVER_TRX_SQL)
def clean_transactions(spark, d):
    """The whole transaction cleaning chain."""
    return cl.clean_transactions(fx.movements_dirty(spark, d))


_BY_ID_SQL = f"""SELECT *,
       {_id_sql('id', 'product_id', 'quantity', 'epoch_us(transaction_date)', 'supplier_id')} AS transaction_id
FROM (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY transaction_date DESC NULLS LAST,
        product_id DESC NULLS LAST, quantity DESC NULLS LAST, supplier_id DESC NULLS LAST) AS rn
  FROM (SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey AS product_id, CAST(l_quantity AS DOUBLE) AS quantity,
               CAST(l_shipdate AS TIMESTAMP) AS transaction_date, l_suppkey AS supplier_id FROM lineitem)) WHERE rn = 1)"""


@register("clean_transactions_by_id", _BY_ID_SQL)
def clean_transactions_by_id(spark, d):
    """C12 with an ``id`` and typed dates: the latest row of an id stays."""
    return cl.clean_transactions(fx.movements_by_id(spark, d))


@register("clean_inventory", fx.with_views("inventory_dirty") + _SILVER_INV_SQL)
def clean_inventory(spark, d):
    """The whole inventory cleaning chain."""
    return cl.clean_inventory(fx.inventory_dirty(spark, d))


@register("clean_suppliers", fx.with_views("suppliers_global") + """SELECT DISTINCT id AS supplier_id,
       trim(supplier_name) AS supplier_name, average_lead_time_days FROM suppliers_global""")
def clean_suppliers(spark, d):
    """C14: the whole supplier cleaning chain."""
    return cl.clean_suppliers(fx.suppliers_global(spark, d))


_SILVER_GOLD_PREFIX = fx.with_views("movements_dirty", "inventory_dirty", "suppliers_by_product").rstrip() + f""",
silver_trx AS (SELECT product_id, transaction_type, quantity AS quantity_change, transaction_date
               FROM ({_SILVER_TRX_SQL})),
silver_inv AS (SELECT product_id, stock_quantity, reorder_level,
                      TRY_CAST(date__received AS TIMESTAMP) AS date_received,
                      TRY_CAST(last_order_date AS TIMESTAMP) AS last_order_date
               FROM ({_SILVER_INV_SQL}))
"""


@register("gold_from_silver", gold_sql(trx="silver_trx", inv="silver_inv", prefix=_SILVER_GOLD_PREFIX))
def gold_from_silver(spark, d):
    """Dirty bronze -> silver cleaning -> gold, without writing in between."""
    trx = cl.clean_transactions(fx.movements_dirty(spark, d))
    inv = cl.clean_inventory(fx.inventory_dirty(spark, d))
    sup = cl.clean_suppliers(fx.suppliers_by_product(spark, d))
    return fe.build_gold(trx, inv, sup)



_QUANTILES = [(c, q) for c in ("l_quantity", "l_extendedprice") for q in (0.25, 0.5, 0.99)]


@register("exact_quantiles", " UNION ALL ".join(
    f"""SELECT '{c}' AS name, {q}::DOUBLE AS q, quantile_disc(CAST({c} AS DOUBLE), {q}) AS lower_value,
  quantile_cont(CAST({c} AS DOUBLE), {q}) AS interpolated FROM lineitem""" for c, q in _QUANTILES))
def exact_quantiles(spark, d):
    """Exact quantiles of all lines, by narrowing the range, lower and interpolated."""
    li = fx.table(spark, d, "lineitem")
    out = None
    for c, q in _QUANTILES:
        row = spark.range(1).select(F.lit(c).alias("name"), F.lit(q).alias("q"), exact_quantile(li, c, q).alias("lower_value"),
                                    exact_quantile(li, c, q, interpolated=True).alias("interpolated"))
        out = row if out is None else out.unionAll(row)
    return out


@register("price_cast_impute_exact", fx.with_views("inventory_dirty") + """, t AS (
  SELECT "Product ID" AS product_id, TRY_CAST(trim(" Unit Price") AS DOUBLE) AS p FROM inventory_dirty)
SELECT product_id, coalesce(p, (SELECT quantile_cont(p, 0.5) FROM t)) AS unit_price FROM t""")
def price_cast_impute_exact(spark, d):
    """Price text -> double, gaps -> the exact interpolated median."""
    inv = cl.trim_strings(_norm(fx.inventory_dirty(spark, d)))
    col = cl.price_column(inv)
    return cl.impute_median(cl.cast_price(inv), col, method="interpolated").select("product_id", col)
