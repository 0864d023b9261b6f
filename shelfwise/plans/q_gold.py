"""Gold feature queries (F1-F23) over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.naming import resolve_inventory_roles, resolve_supplier_roles
from shelfwise.operators import features as fe
from shelfwise.operators import incremental as ic
from shelfwise.plans.catalog import register
from shelfwise.session import scratch_dir
from shelfwise.sources import fixtures as fx

# Written out, not taken from the code: the oracle must notice a wrong label.
_LABELS_SQL = "'SALE', 'SALES', 'OUT', 'KELUAR'"


def gold_sql(trx="movements", inv="inventory", sup="suppliers_by_product", mode="by_product",
             level=True, sup_id="supplier_id", prefix: str | None = None) -> str:
    """The gold table as one DuckDB statement (plain multi-pass formulation).

    ``prefix`` replaces the fixture ``WITH`` clause (for custom input views).
    """
    views = [trx, inv] + ([sup] if mode != "default" else [])
    if mode == "by_product":
        lead_cte = f""",
lead AS (SELECT product_id AS supplied_product, average_lead_time_days FROM (
  SELECT product_id, average_lead_time_days, row_number() OVER (PARTITION BY product_id
         ORDER BY {sup_id} ASC NULLS LAST, average_lead_time_days ASC NULLS LAST) AS rn
  FROM {sup}) WHERE rn = 1)"""
        lead_join = "LEFT JOIN lead l ON i.product_id = l.supplied_product"
        lead_val = "l.average_lead_time_days"
        ref = "l.supplied_product AS supplier_product_ref, "
        ref_out = "supplier_product_ref, "
    elif mode == "global_median":
        lead_cte = f""",
lead AS (SELECT coalesce(quantile_disc(CAST(average_lead_time_days AS DOUBLE), 0.5), 7.0::DOUBLE) AS m FROM {sup})"""
        lead_join = "CROSS JOIN lead l"
        lead_val = "l.m"
        ref = ref_out = ""
    else:
        lead_cte, lead_join, lead_val, ref, ref_out = "", "", "7.0::DOUBLE", "", ""
    lvl = "CAST(i.reorder_level AS DOUBLE) AS historical_reorder_level, " if level else ""
    lvl_out = "historical_reorder_level, " if level else ""
    rop = ("(daily_sales_velocity * procurement_lead_time * 2 + coalesce(historical_reorder_level, 0.0::DOUBLE)) / 2.0"
           if level else "daily_sales_velocity * procurement_lead_time * 2")
    prefix = prefix if prefix is not None else fx.with_views(*views)
    return prefix.rstrip() + f""",
flag AS (SELECT EXISTS (SELECT 1 FROM {trx} WHERE upper(transaction_type) IN ({_LABELS_SQL})) AS any_sale),
sales AS (SELECT m.* FROM {trx} m CROSS JOIN flag WHERE CASE WHEN flag.any_sale
            THEN coalesce(upper(m.transaction_type) IN ({_LABELS_SQL}), false)
            ELSE coalesce(m.quantity_change < 0, false) END),
sv AS (SELECT product_id, abs(sum(quantity_change)) AS total_sales,
              count(DISTINCT CAST(transaction_date AS DATE)) AS active_days
       FROM sales GROUP BY product_id),
net AS (SELECT product_id, sum(quantity_change) AS net_change FROM {trx} GROUP BY product_id){lead_cte},
base AS (
  SELECT i.product_id, {ref}CAST(i.stock_quantity AS DOUBLE) AS initial_stock_quantity,
         greatest(CAST(i.stock_quantity AS DOUBLE) + coalesce(n.net_change, 0.0::DOUBLE), 0.0::DOUBLE) AS stock_on_hand,
         s.total_sales, s.active_days,
         coalesce(CASE WHEN s.active_days > 0 THEN s.total_sales / s.active_days ELSE s.total_sales END, 0.0::DOUBLE)
           AS daily_sales_velocity,
         CAST(date_diff('day', CAST(i.last_order_date AS DATE), CAST(i.date_received AS DATE)) AS DOUBLE) AS actual_lead_time,
         {lead_val} AS avg_lead_time_days, {lvl}0 AS _z
  FROM {inv} i LEFT JOIN net n ON i.product_id = n.product_id
       LEFT JOIN sv s ON i.product_id = s.product_id
       {lead_join}),
f AS (SELECT *, (coalesce(actual_lead_time, avg_lead_time_days) + coalesce(avg_lead_time_days, 7.0::DOUBLE)) / 2.0
                AS procurement_lead_time FROM base),
g AS (SELECT *, CASE WHEN daily_sales_velocity > 0 THEN stock_on_hand / daily_sales_velocity END AS order_buffer_index,
             daily_sales_velocity * procurement_lead_time AS safety_stock FROM f)
SELECT product_id, {ref_out}initial_stock_quantity, stock_on_hand, total_sales, active_days, daily_sales_velocity,
       actual_lead_time, avg_lead_time_days, procurement_lead_time, order_buffer_index, safety_stock, {lvl_out}
       CAST(CASE WHEN stock_on_hand <= coalesce(safety_stock, 0.0::DOUBLE) THEN 1 ELSE 0 END AS INTEGER) AS stockout_risk,
       greatest({rop}, 0.0::DOUBLE) AS reorder_point
FROM g"""


def _gold(spark, d, trx=fx.movements, inv=fx.inventory, sup=fx.suppliers_by_product):
    return fe.build_gold(trx(spark, d), inv(spark, d), sup(spark, d))


def _sub(sql: str, cols: str) -> str:
    return f"SELECT {cols} FROM (\n{sql}\n) gold"


GOLD_SQL = gold_sql()


@register("gold_features", GOLD_SQL)
def gold_features(spark, d):
    """Flagship: the whole gold table (F1-F23 with role discovery D1)."""
    return _gold(spark, d)


@register("gold_fallback", gold_sql(trx="movements_nosale"))
def gold_fallback(spark, d):
    """No sale label anywhere: sales are the negative movements."""
    return _gold(spark, d, trx=fx.movements_nosale)


@register("gold_labels", gold_sql(trx="movements_labels"))
def gold_labels(spark, d):
    """All four sale labels, in any case, beside other and null types."""
    return _gold(spark, d, trx=fx.movements_labels)


@register("gold_unsold", gold_sql(trx="movements_partial"))
def gold_unsold(spark, d):
    """Products without any movement: the null side of F8 and F15."""
    return _gold(spark, d, trx=fx.movements_partial)


_DUP_SQL = fx.with_views("movements", "inventory_dup", "suppliers_by_product").rstrip() + """,
inv_latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id
  ORDER BY date_received DESC NULLS LAST) AS rn FROM inventory_dup) WHERE rn = 1)
"""


@register("gold_dup_products", gold_sql(inv="inv_latest", prefix=_DUP_SQL))
def gold_dup_products(spark, d):
    """An inventory that repeats products with other values: the latest received counts."""
    return _gold(spark, d, inv=fx.inventory_dup)


def _typed(fixture, name, kind):
    return lambda spark, d: fixture(spark, d).withColumn(name, F.col(name).cast(kind))


@register("gold_mixed_keys", f"SELECT * REPLACE (CAST(supplier_product_ref AS DOUBLE) AS supplier_product_ref) FROM ({GOLD_SQL})")
def gold_mixed_keys(spark, d):
    """Product keys as int, bigint and double: they match as numbers, and the
    inventory's type stays."""
    return _gold(spark, d, trx=_typed(fx.movements, "product_id", "int"),
                 sup=_typed(fx.suppliers_by_product, "product_id", "double"))


@register("gold_text_keys", GOLD_SQL)
def gold_text_keys(spark, d):
    """Zero-padded text keys in the movements against numbers elsewhere."""
    def padded(spark, d):
        return fx.movements(spark, d).withColumn("product_id", F.lpad(F.col("product_id").cast("string"), 12, "0"))
    return _gold(spark, d, trx=padded)


@register("gold_nulls", gold_sql(inv="inventory_nulls"))
def gold_nulls(spark, d):
    """Null stock and null dates: every null rule of SURVEY §2.4."""
    return _gold(spark, d, inv=fx.inventory_nulls)


@register("lead_global_median", gold_sql(inv="inventory_nolevel", sup="suppliers_global",
                                         mode="global_median", level=False))
def lead_global_median(spark, d):
    """F12 + F20: suppliers without product, inventory without reorder level."""
    return _gold(spark, d, inv=fx.inventory_nolevel, sup=fx.suppliers_global)


@register("lead_default", gold_sql(sup="suppliers_plain", mode="default"))
def lead_default(spark, d):
    """suppliers without lead time -> 7 days."""
    return _gold(spark, d, sup=fx.suppliers_plain)


# ----------------------------------------------------------- single operators

_SALES_WHERE = f"coalesce(upper(transaction_type) IN ({_LABELS_SQL}), false)"


@register("sales_filter", fx.with_views("movements") + f"SELECT * FROM movements WHERE {_SALES_WHERE}")
def sales_filter(spark, d):
    """rows whose upper-cased type is a sale label."""
    return fe.sales_rows(fx.movements(spark, d))


@register("sales_fallback", fx.with_views("movements_nosale")
          + "SELECT * FROM movements_nosale WHERE quantity_change < 0")
def sales_fallback(spark, d):
    """no sale label in the table -> rows with a negative quantity."""
    return fe.sales_rows(fx.movements_nosale(spark, d))


_SV_SQL = fx.with_views("movements") + f"""SELECT product_id, abs(sum(quantity_change)) AS total_sales,
       count(DISTINCT CAST(transaction_date AS DATE)) AS active_days,
       CASE WHEN count(DISTINCT CAST(transaction_date AS DATE)) > 0
            THEN abs(sum(quantity_change)) / count(DISTINCT CAST(transaction_date AS DATE))
            ELSE abs(sum(quantity_change)) END AS daily_sales_velocity
FROM movements WHERE {_SALES_WHERE} GROUP BY product_id"""


@register("sales_velocity", _SV_SQL)
def sales_velocity(spark, d):
    """Total sales, active days and daily velocity per product."""
    return fe.sales_velocity(fx.movements(spark, d))


@register("net_movement", fx.with_views("movements")
          + "SELECT product_id, sum(quantity_change) AS net_change FROM movements GROUP BY product_id")
def net_movement(spark, d):
    """F7."""
    return fe.net_movement(fx.movements(spark, d))


@register("stock_on_hand", fx.with_views("movements", "inventory_nulls") + """SELECT i.product_id,
       CAST(i.stock_quantity AS DOUBLE) AS initial_stock_quantity, n.net_change,
       greatest(CAST(i.stock_quantity AS DOUBLE) + coalesce(n.net_change, 0.0::DOUBLE), 0.0::DOUBLE) AS stock_on_hand
FROM inventory_nulls i LEFT JOIN (SELECT product_id, sum(quantity_change) AS net_change
                                  FROM movements GROUP BY product_id) n ON i.product_id = n.product_id""")
def stock_on_hand(spark, d):
    """F8/F9 (over the inventory with null stocks)."""
    return fe.stock_on_hand(fx.inventory_nulls(spark, d), fx.movements(spark, d))


@register("actual_lead_time", fx.with_views("inventory_nulls") + """SELECT product_id,
       CAST(date_diff('day', CAST(last_order_date AS DATE), CAST(date_received AS DATE)) AS DOUBLE) AS actual_lead_time
FROM inventory_nulls""")
def actual_lead_time(spark, d):
    """F10."""
    inv = fx.inventory_nulls(spark, d)
    roles = resolve_inventory_roles(inv.columns)
    return inv.select(F.col("product_id"), fe.actual_lead_time_col(inv, roles).alias("actual_lead_time"))


@register("lead_by_product", fx.with_views("suppliers_by_product") + """SELECT product_id AS supplied_product,
       average_lead_time_days AS avg_lead_time_days FROM (
  SELECT product_id, average_lead_time_days, row_number() OVER (PARTITION BY product_id
         ORDER BY supplier_id ASC NULLS LAST, average_lead_time_days ASC NULLS LAST) AS rn
  FROM suppliers_by_product) WHERE rn = 1""")
def lead_by_product(spark, d):
    """one lead time per supplier product (lowest supplier id)."""
    sup = fx.suppliers_by_product(spark, d)
    return fe.supplier_lead_by_product(sup, resolve_supplier_roles(sup.columns))


_GOLD_COLS = {
    "procurement_lead_time": "product_id, actual_lead_time, avg_lead_time_days, procurement_lead_time",
    "velocity_join": "product_id, total_sales, active_days, daily_sales_velocity",
    "order_buffer_index": "product_id, stock_on_hand, daily_sales_velocity, order_buffer_index",
    "safety_stock": "product_id, daily_sales_velocity, procurement_lead_time, safety_stock",
    "stockout_risk": "product_id, stock_on_hand, safety_stock, stockout_risk",
    "reorder_point_hist": "product_id, historical_reorder_level, reorder_point",
}


def _gold_projection(name: str, cols: str):
    def fn(spark, d):
        return _gold(spark, d).select(*[c.strip() for c in cols.split(",")])
    fn.__name__ = name
    fn.__doc__ = f"Gold projection: {cols}."
    return fn


for _name, _cols in _GOLD_COLS.items():
    register(_name, _sub(GOLD_SQL, _cols))(_gold_projection(_name, _cols))


@register("reorder_point_formula", _sub(gold_sql(inv="inventory_nolevel", level=False),
                                        "product_id, daily_sales_velocity, procurement_lead_time, reorder_point"))
def reorder_point_formula(spark, d):
    """no reorder level in the inventory -> velocity x lead x 2, floored."""
    return (_gold(spark, d, inv=fx.inventory_nolevel)
            .select("product_id", "daily_sales_velocity", "procurement_lead_time", "reorder_point"))


@register("dedup_by_key", fx.with_views("movements") + """SELECT product_id, transaction_type, quantity_change,
       transaction_date, supplier_id FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY transaction_date DESC NULLS LAST,
         transaction_type DESC NULLS LAST, quantity_change DESC NULLS LAST, supplier_id DESC NULLS LAST) AS rn
  FROM movements) WHERE rn = 1""")
def dedup_by_key(spark, d):
    """One row per key, latest first, then every column (deterministic)."""
    return fe.dedup_by_key(fx.movements(spark, d), ["product_id"], order_by=["transaction_date"])



def _in_three(spark, d, trx):
    """Gold after three increments of the movements, cut by the year of a row."""
    root = scratch_dir(spark, "gold-state")
    part = F.pmod(F.coalesce(F.year("transaction_date"), F.lit(0)), F.lit(3))
    for n in range(3):
        path = ic.advance(spark, root, trx(spark, d).where(part == n), version=n)
    return ic.gold_of_partials(spark.read.parquet(path), fx.inventory(spark, d), fx.suppliers_by_product(spark, d))


@register("gold_incremental", GOLD_SQL)
def gold_incremental(spark, d):
    """F3-F7, F23 from stored partials: each increment reads its own rows and the state."""
    return _in_three(spark, d, fx.movements)


@register("gold_incremental_fallback", gold_sql(trx="movements_nosale"))
def gold_incremental_fallback(spark, d):
    """The same where no increment has a sale label: the rule is decided by the state."""
    return _in_three(spark, d, fx.movements_nosale)
