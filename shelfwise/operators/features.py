"""Gold features: one row per product.

Plan shape (see README "Physical design"):

* movements are scanned once. ``movement_summary`` groups by
  (product, day) and then by product, with map-side partial aggregation at
  both levels, so a best-selling product (even one holding a third of all
  rows) is reduced inside each map task before anything is shuffled;
* the global "is there any sale at all?" fallback is an uncorrelated
  EXISTS subquery (``LIMIT 1``), not a driver ``count()``;
* suppliers are reduced to one row per product before the join, and the
  inventory is de-duplicated per product by an aggregate, so every join
  is one-to-one on ``product_id`` and all three sides arrive
  hash-partitioned on that key: the joins add no exchange of their own.

Column names follow the reference's gold table (SURVEY §1.3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import (
    SALE_LABELS,
    dtype_of,
    is_sale,
    qcol,
    safe_date,
    safe_double,
)
from shelfwise.functions.naming import (
    InventoryRoles,
    SupplierRoles,
    TransactionRoles,
    normalize_columns,
    normalized_names,
    resolve_inventory_roles,
    resolve_supplier_roles,
    resolve_transaction_roles,
)
from shelfwise.operators.cleaning import dedup_by_key

# Lead time used when suppliers carry none, and the factor
# of the "double coverage" reorder point.
DEFAULT_LEAD_TIME_DAYS = 7.0
COVERAGE_FACTOR = 2

PRODUCT = "product_id"


# --------------------------------------------------------------------------
# Sales rows
# --------------------------------------------------------------------------

def any_sale(trx: DataFrame, roles: TransactionRoles, labels=SALE_LABELS) -> Column:
    """Scalar: does any row of the whole table carry a sale label?

    An uncorrelated EXISTS (``CollectLimit 1``): it stops at the first
    matching row, so in the usual case it reads a single file split.
    """
    return trx.filter(is_sale(qcol(roles.type), labels)).select(F.lit(1)).limit(1).exists()


def sales_rows(trx: DataFrame, roles: TransactionRoles | None = None,
               labels=SALE_LABELS, fallback: bool = True) -> DataFrame:
    """rows that count as sales.

    upper(type) in ``labels``; when no row of the whole table has such a
    label (and ``fallback``), every row with quantity < 0 instead. The
    quantity column is cast to double (F1).
    """
    roles = roles or resolve_transaction_roles(trx.columns)
    q = safe_double(trx, roles.quantity)
    sale = is_sale(qcol(roles.type), labels)
    if fallback:
        cond = F.when(any_sale(trx, roles, labels), sale).otherwise(F.coalesce(q < 0, F.lit(False)))
    else:
        cond = sale
    cols = [q.alias(c) if c == roles.quantity else qcol(c) for c in trx.columns]
    return trx.filter(cond).select(*cols)


# --------------------------------------------------------------------------
# One pass over the movements
# --------------------------------------------------------------------------

def movement_summary(trx: DataFrame, roles: TransactionRoles | None = None,
                     labels=SALE_LABELS, fallback: bool = True) -> DataFrame:
    """One row per product: net_change (F7), total_sales, active_days.

    total_sales / active_days are null for a product with no sales row,
    exactly as the reference's left join of the sales aggregate gives.

    One scan, two aggregation levels, both reduced map side:
    1. (product, day of a sales row) -> sums. Rows that are not sales (and
       sales without a date) of a product share one null-day group, so this
       level only keeps one row per product and selling day;
    2. product -> sums, and active_days = groups with a sale and a day.
    Whether "sale" means a labelled row or (global fallback) a negative
    quantity is decided by the EXISTS flag, evaluated once per query.
    """
    roles = roles or resolve_transaction_roles(trx.columns)
    q = safe_double(trx, roles.quantity)
    sale = is_sale(qcol(roles.type), labels)
    if fallback:
        sale = F.when(any_sale(trx, roles, labels), sale).otherwise(F.coalesce(q < 0, F.lit(False)))
    base = trx.select(qcol(roles.product).alias(PRODUCT), q.alias("q"), sale.alias("s"),
                      safe_date(trx, roles.date).alias("day"))
    daily = base.groupBy(PRODUCT, F.when(F.col("s"), F.col("day")).alias("sday")).agg(
        F.sum("q").alias("net"),
        F.sum(F.when(F.col("s"), F.col("q"))).alias("sq"),
        F.count_if(F.col("s")).alias("sn"),
    )
    per_product = daily.groupBy(PRODUCT).agg(
        F.sum("net").alias("net_change"),
        F.sum("sq").alias("sq"),
        F.sum("sn").alias("sn"),
        F.count_if((F.col("sn") > 0) & F.col("sday").isNotNull()).alias("sdays"),
    )
    sold = F.col("sn") > 0
    return per_product.select(
        PRODUCT,
        "net_change",
        F.when(sold, F.abs(F.col("sq"))).alias("total_sales"),
        F.when(sold, F.col("sdays")).alias("active_days"),
    )


def velocity_col(total: Column, days: Column) -> Column:
    """total / active_days when active_days > 0, else total."""
    return F.when(days > 0, total / days).otherwise(total)


def sales_velocity(trx: DataFrame, roles: TransactionRoles | None = None,
                   labels=SALE_LABELS, fallback: bool = True) -> DataFrame:
    """F4-F6 for products that have at least one sales row."""
    roles = roles or resolve_transaction_roles(trx.columns)
    s = movement_summary(trx, roles, labels, fallback).filter(F.col("active_days").isNotNull())
    return s.select(PRODUCT, "total_sales", "active_days",
                    velocity_col(F.col("total_sales"), F.col("active_days")).alias("daily_sales_velocity"))


def net_movement(trx: DataFrame, roles: TransactionRoles | None = None) -> DataFrame:
    """sum of quantity change per product over every transaction type."""
    roles = roles or resolve_transaction_roles(trx.columns)
    return (trx.groupBy(qcol(roles.product).alias(PRODUCT))
               .agg(F.sum(safe_double(trx, roles.quantity)).alias("net_change")))


# --------------------------------------------------------------------------
# Inventory side
# --------------------------------------------------------------------------

_RANK = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType)


def key_type(*types: T.DataType) -> T.DataType:
    """The type in which product keys of different sources are compared.

    Equal types stay. Numbers meet in the widest of them (a decimal beside
    another type as double). A text meets a number as that number: texts that
    are none match nothing. Anything else meets as text."""
    if len(set(types)) == 1:
        return types[0]
    numbers = [t for t in types if isinstance(t, _RANK)]
    if not numbers or not all(isinstance(t, (*_RANK, T.StringType)) for t in types):
        return T.StringType()
    widest = max(numbers, key=lambda t: [isinstance(t, k) for k in _RANK].index(True))
    return T.DoubleType() if isinstance(widest, (T.DecimalType, T.FloatType)) and len(set(numbers)) > 1 else widest


def as_key(c: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """A key column in the type of ``key_type``; text that is no number becomes null."""
    if own == wanted:
        return c
    return c.try_cast(wanted) if isinstance(own, T.StringType) else c.cast(wanted)


def stock_on_hand_col(stock: Column, net: Column) -> Column:
    """greatest(stock + coalesce(net, 0), 0); a null stock gives 0."""
    return F.greatest(stock + F.coalesce(net, F.lit(0.0)), F.lit(0.0))


def actual_lead_time_col(inv: DataFrame, roles: InventoryRoles) -> Column:
    """days from last order to receipt, as double; null if a column is absent."""
    if roles.received and roles.last_order:
        return F.datediff(safe_date(inv, roles.received),
                          safe_date(inv, roles.last_order)).cast("double")
    return F.lit(None).cast("double")


def stock_on_hand(inv: DataFrame, trx: DataFrame,
                  inv_roles: InventoryRoles | None = None,
                  trx_roles: TransactionRoles | None = None) -> DataFrame:
    """Inventory LEFT JOIN net movement on product."""
    inv_roles = inv_roles or resolve_inventory_roles(inv.columns)
    trx_roles = trx_roles or resolve_transaction_roles(trx.columns)
    own, theirs = dtype_of(inv, inv_roles.product), dtype_of(trx, trx_roles.product)
    wanted = key_type(own, theirs)
    left = inv.select(qcol(inv_roles.product).alias(PRODUCT), as_key(qcol(inv_roles.product), own, wanted).alias("_key"),
                      safe_double(inv, inv_roles.stock).alias("initial_stock_quantity"))
    net = (trx.groupBy(as_key(qcol(trx_roles.product), theirs, wanted).alias("_key"))
              .agg(F.sum(safe_double(trx, trx_roles.quantity)).alias("net_change")))
    return (left.join(net, "_key", "left")
                .select(PRODUCT, "initial_stock_quantity", "net_change",
                        stock_on_hand_col(F.col("initial_stock_quantity"),
                                          F.col("net_change")).alias("stock_on_hand")))


# --------------------------------------------------------------------------
# Supplier lead time
# --------------------------------------------------------------------------

def supplier_lead_by_product(sup: DataFrame, roles: SupplierRoles,
                             wanted: T.DataType | None = None) -> DataFrame:
    """one row per supplier product: the lead time of the lowest
    supplier id (nulls last), smallest non-null lead on ties. With ``wanted``
    products are told apart as keys of that type (column ``_key``).

    Reducing before the join keeps it one-to-one (the reference joins every
    supplier row and keeps an arbitrary one).
    """
    lead = safe_double(sup, roles.lead_time)
    sid = qcol(roles.supplier_id) if roles.supplier_id else F.lit(None).cast("string")
    pick = F.min(F.struct(sid.isNull().alias("a"), sid.alias("b"),
                          lead.isNull().alias("c"), lead.alias("d")))
    lead_value = F.col("_p.d").alias("avg_lead_time_days")
    own = dtype_of(sup, roles.product)
    if wanted is None:
        return (sup.groupBy(qcol(roles.product).alias("supplied_product")).agg(pick.alias("_p"))
                   .select("supplied_product", lead_value))
    return (sup.groupBy(as_key(qcol(roles.product), own, wanted).alias("_key"))
               .agg(pick.alias("_p"), F.min(qcol(roles.product)).alias("supplied_product"))
               .select("_key", "supplied_product", lead_value))


def global_median_lead(sup: DataFrame, roles: SupplierRoles, accuracy: int = 10000) -> Column:
    """approximate median of the supplier lead times, as a scalar
    subquery (one mergeable sketch, no collect); all-null -> 7.0."""
    med = sup.agg(F.percentile_approx(safe_double(sup, roles.lead_time), 0.5, accuracy).alias("m"))
    return F.coalesce(med.scalar(), F.lit(DEFAULT_LEAD_TIME_DAYS))


def supplier_lead_mode(roles: SupplierRoles) -> str:
    if roles.product and roles.lead_time:
        return "by_product"
    if roles.lead_time:
        return "global_median"
    return "default"


def procurement_lead_time_col(actual: Column, avg: Column) -> Column:
    """(coalesce(actual, avg) + coalesce(avg, 7)) / 2."""
    return (F.coalesce(actual, avg) + F.coalesce(avg, F.lit(DEFAULT_LEAD_TIME_DAYS))) / 2.0


# --------------------------------------------------------------------------
# formulas
# --------------------------------------------------------------------------

def order_buffer_index_col(stock: Column, velocity: Column) -> Column:
    """F16: days of stock left; null when nothing sells."""
    return F.when(velocity > 0, stock / velocity).otherwise(F.lit(None).cast("double"))


def safety_stock_col(velocity: Column, procurement: Column) -> Column:
    """F17."""
    return velocity * procurement


def stockout_risk_col(stock: Column, safety: Column) -> Column:
    """1 when stock on hand <= coalesce(safety stock, 0)."""
    return F.when(stock <= F.coalesce(safety, F.lit(0.0)), F.lit(1)).otherwise(F.lit(0)).cast("int")


def reorder_point_col(velocity: Column, procurement: Column, level: Column | None) -> Column:
    """F19 (with a historical reorder level) / F20 (without), floored at 0."""
    formula = velocity * procurement * COVERAGE_FACTOR
    if level is not None:
        formula = (formula + F.coalesce(level, F.lit(0.0))) / 2.0
    return F.greatest(formula, F.lit(0.0))


# --------------------------------------------------------------------------
# The gold table
# --------------------------------------------------------------------------

def build_gold(trx: DataFrame, inv: DataFrame, sup: DataFrame,
               overrides: dict | None = None, labels=SALE_LABELS,
               fallback: bool = True, dedup: bool = True,
               median_accuracy: int = 10000, normalize: bool = True, summarise=None) -> DataFrame:
    """The gold feature table: one row per inventory product.

    Column names are first normalized (C2: runs of whitespace, '-' and '/'
    become one '_'), then roles are found on them (D1). ``overrides`` maps
    ``{"transactions"|"inventory"|"suppliers": {role: column}}`` with
    normalized names. Inventory rows repeating a product are reduced to
    one: the latest received, then the greatest by every column.
    ``summarise`` replaces ``movement_summary`` where ``trx`` is not a table of
    movements but has a ``product_id`` (see ``incremental``).
    Launches no job: the result is a lazy DataFrame.
    """
    overrides = overrides or {}
    if normalize:
        trx, inv, sup = (x if normalized_names(x.columns, collapse=True) == x.columns
                         else normalize_columns(x, collapse=True) for x in (trx, inv, sup))
    product = PRODUCT
    if summarise is None:
        tr = resolve_transaction_roles(trx.columns, overrides.get("transactions"))
        product = tr.product

        def summarise(rows: DataFrame) -> DataFrame:
            return movement_summary(rows, tr, labels, fallback)
    ir = resolve_inventory_roles(inv.columns, overrides.get("inventory"))
    sr = resolve_supplier_roles(sup.columns, overrides.get("suppliers"))
    mode = supplier_lead_mode(sr)

    # Key types may differ between sources (all inferred).
    own, moved = dtype_of(inv, ir.product), dtype_of(trx, product)
    supplied = [dtype_of(sup, sr.product)] if mode == "by_product" else []
    wanted = key_type(own, moved, *supplied)
    same = all(t == own for t in (moved, *supplied))
    key = PRODUCT if same else "_key"

    # Inventory: only the columns gold reads, one row per product.
    inv_cols = [
        qcol(ir.product).alias(PRODUCT),
        safe_double(inv, ir.stock).alias("initial_stock_quantity"),
        actual_lead_time_col(inv, ir).alias("actual_lead_time"),
    ]
    if ir.reorder_level:
        inv_cols.append(safe_double(inv, ir.reorder_level).alias("historical_reorder_level"))
    if dedup and ir.received:
        inv_cols.append(safe_date(inv, ir.received).alias("_received"))
    inv_p = inv.select(*inv_cols)
    if dedup:  # (_received is dropped by the final projection)
        inv_p = dedup_by_key(inv_p, [PRODUCT], order_by=["_received"] if ir.received else None)

    if same:
        mv = summarise(trx)
    else:  # movements are summed by the common key; the inventory keeps its own column
        inv_p = inv_p.withColumn(key, as_key(F.col(PRODUCT), own, wanted))
        trx = trx.withColumn(product, as_key(qcol(product), moved, wanted))
        mv = summarise(trx).withColumnRenamed(PRODUCT, key)
    df = inv_p.join(mv, key, "left")

    if mode == "by_product":
        if same:
            leads = supplier_lead_by_product(sup, sr)
            df = df.join(leads, df[PRODUCT] == leads["supplied_product"], "left")
        else:
            df = df.join(supplier_lead_by_product(sup, sr, wanted), key, "left")
        avg = F.col("avg_lead_time_days")
    elif mode == "global_median":
        avg = global_median_lead(sup, sr, median_accuracy)
    else:
        avg = F.lit(DEFAULT_LEAD_TIME_DAYS)

    # All formulas in one projection (Catalyst shares the repeated parts).
    stock = stock_on_hand_col(F.col("initial_stock_quantity"), F.col("net_change"))
    velocity = F.coalesce(velocity_col(F.col("total_sales"), F.col("active_days")), F.lit(0.0))
    procurement = procurement_lead_time_col(F.col("actual_lead_time"), avg)
    safety = safety_stock_col(velocity, procurement)
    level = F.col("historical_reorder_level") if ir.reorder_level else None
    out = {
        PRODUCT: F.col(PRODUCT),
        "supplier_product_ref": F.col("supplied_product"),
        "initial_stock_quantity": F.col("initial_stock_quantity"),
        "stock_on_hand": stock,
        "total_sales": F.col("total_sales"),
        "active_days": F.col("active_days"),
        "daily_sales_velocity": velocity,
        "actual_lead_time": F.col("actual_lead_time"),
        "avg_lead_time_days": avg,
        "procurement_lead_time": procurement,
        "order_buffer_index": order_buffer_index_col(stock, velocity),
        "safety_stock": safety,
        "historical_reorder_level": level,
        "stockout_risk": stockout_risk_col(stock, safety),
        "reorder_point": reorder_point_col(velocity, procurement, level),
    }
    return df.select(*[out[c].alias(c) for c in gold_columns(ir, sr)])


def gold_columns(ir: InventoryRoles, sr: SupplierRoles) -> list[str]:
    """output columns in the reference's order."""
    cols = [PRODUCT, "initial_stock_quantity", "stock_on_hand", "total_sales", "active_days",
            "daily_sales_velocity", "actual_lead_time", "avg_lead_time_days",
            "procurement_lead_time", "order_buffer_index", "safety_stock"]
    if ir.reorder_level:
        cols.append("historical_reorder_level")
    cols += ["stockout_risk", "reorder_point"]
    if supplier_lead_mode(sr) == "by_product":
        cols.insert(1, "supplier_product_ref")
    return cols
