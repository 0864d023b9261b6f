"""Inputs in the reference's shapes, derived from the driver's tables.

The reference reads three tables (stock movements, product inventory,
suppliers) that are not in its tree. These functions derive them from the
TPC-H-like parquet tables with plain projections, joins and aggregates, so
every query built on them grows with the data. Each Spark view has a DuckDB
twin (``SQL_VIEWS``) used by the oracle queries; the two must stay equal.

Mapping (FIXTURES.md §B):

* movements: one per lineitem. returnflag R -> RETURN (+qty), A -> OUT,
  N -> 'Sale' when linestatus O else 'SALE' (mixed case on purpose); the
  quantity change is negative except for returns; date = ship date.
* inventory: one per part: stock = size x 10, reorder level = size,
  price = retail price; date received / last order date = latest ship date
  and latest order date of the product's lines (lineitem JOIN orders).
* suppliers: distinct (part, supplier) pairs of the lines with a lead time
  of 1 + suppkey % 14 days; a global variant without product and a plain
  variant without lead time.
* the dirty variants inject padding, header spellings, unparsable text and
  exact duplicate rows (the first line of each order twice) without
  dropping any input row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, with the schema that its files have now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- movements

def _movement_cols():
    rf, ls, q = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    ttype = (F.when(rf == "R", "RETURN").when(rf == "A", "OUT")
              .when(ls == "O", "Sale").otherwise("SALE"))
    qchange = F.when(rf == "R", q).otherwise(-q)
    return ttype, qchange


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _movements(spark, sf_dir, _movement_cols()[0])


def _movements(spark: SparkSession, sf_dir: str, ttype) -> DataFrame:
    qchange = _movement_cols()[1]
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        ttype.alias("transaction_type"),
        qchange.alias("quantity_change"),
        F.col("l_shipdate").alias("transaction_date"),
        F.col("l_suppkey").alias("supplier_id"),
    )


def movements_nosale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No row carries a sale label, which only reading the types can tell: gold
    falls back to negative quantities."""
    rf = F.col("l_returnflag")
    kind = F.when(rf == "R", "IN").when(rf == "A", "MOVE").otherwise("transfer")
    return _movements(spark, sf_dir, kind)


def movements_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four sale labels in several spellings, other types and null types."""
    k = F.col("l_partkey") % 6
    kind = (F.when(k == 0, "sale").when(k == 1, "SALES").when(k == 2, "Keluar").when(k == 3, "OUT")
             .when(k == 4, "RETURN"))
    return _movements(spark, sf_dir, kind)


def movements_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth product never moves."""
    return movements(spark, sf_dir).where(F.col("product_id") % 5 != 0)


def movements_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements with an ``id`` that repeats (order and line number do) with typed dates."""
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                     F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
                     F.col("l_shipdate").cast("timestamp").alias("transaction_date"),
                     F.col("l_suppkey").alias("supplier_id"))


def movements_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-looking export: spaced headers, padded text, quantity and date as
    text with unparsable values, and the first line of every order exported
    twice (exact duplicates; no row is dropped)."""
    ttype, qchange = _movement_cols()
    li = table(spark, sf_dir, "lineitem")
    copies = F.when(F.col("l_linenumber") == 1, F.lit(2)).otherwise(F.lit(1))
    return li.select(
        F.col("l_partkey").alias(" Product ID"),
        F.concat(F.lit("  "), ttype, F.lit(" ")).alias("Transaction Type"),
        F.when(F.col("l_partkey") % 7 == 0, F.lit("n/a"))
         .otherwise(qchange.cast("string")).alias("Quantity"),
        F.when(F.col("l_partkey") % 11 == 0, F.lit("bad"))
         .otherwise(F.col("l_shipdate").cast("string")).alias("Transaction Date"),
        F.col("l_suppkey").alias("Supplier-ID"),
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")


# ---------------------------------------------------------------- inventory

def _product_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .groupBy("l_partkey")
              .agg(F.max("l_shipdate").alias("date_received"),
                   F.max("o_orderdate").alias("last_order_date")))


def inventory(spark: SparkSession, sf_dir: str, with_level: bool = True) -> DataFrame:
    part = table(spark, sf_dir, "part")
    dates = _product_dates(spark, sf_dir)
    cols = [F.col("p_partkey").alias("product_id"),
            (F.col("p_size").cast("double") * 10.0).alias("stock_quantity")]
    if with_level:
        cols.append(F.col("p_size").cast("double").alias("reorder_level"))
    cols += [F.col("p_retailprice").alias("unit_price"), "date_received", "last_order_date"]
    return part.join(dates, part.p_partkey == dates.l_partkey, "left").select(*cols)


def inventory_nolevel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(spark, sf_dir, with_level=False)


def inventory_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null stock for some products, null dates for others."""
    inv = inventory(spark, sf_dir)
    pk = F.col("product_id")
    return inv.select(
        "product_id",
        F.when(pk % 13 != 0, F.col("stock_quantity")).alias("stock_quantity"),
        "reorder_level", "unit_price",
        F.when(pk % 3 != 0, F.col("date_received")).alias("date_received"),
        F.when(pk % 3 != 0, F.col("last_order_date")).alias("last_order_date"),
    )


def inventory_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth product twice, the second row received a day later with other stock."""
    inv = inventory(spark, sf_dir)
    copies = F.when(F.col("product_id") % 4 == 0, F.lit(2)).otherwise(F.lit(1))
    inv = inv.withColumn("_c", F.explode(F.sequence(F.lit(1), copies)))
    later = F.col("_c") == 2
    return inv.select(
        "product_id", (F.col("stock_quantity") + F.when(later, 5.0).otherwise(0.0)).alias("stock_quantity"),
        "reorder_level", "unit_price",
        F.when(later, F.col("date_received") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("date_received"))
         .alias("date_received"), "last_order_date")


def inventory_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-looking CSV export: odd headers, padded names, price as text, and
    the parts of size 1 exported twice (exact duplicates)."""
    part = table(spark, sf_dir, "part")
    dates = _product_dates(spark, sf_dir)
    copies = F.when(F.col("p_size") == 1, F.lit(2)).otherwise(F.lit(1))
    return part.join(dates, part.p_partkey == dates.l_partkey, "left").select(
        F.col("p_partkey").alias("Product ID"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")).alias("Product Name"),
        (F.col("p_size").cast("double") * 10.0).alias("Stock-Quantity"),
        F.col("p_size").alias("Reorder Level"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("n/a"))
         .otherwise(F.col("p_retailprice").cast("string")).alias(" Unit Price"),
        F.col("date_received").cast("string").alias("Date  Received"),
        F.col("last_order_date").cast("string").alias("Last/Order Date"),
        F.explode(F.sequence(F.lit(1), copies)).alias("_copy"),
    ).drop("_copy")


# ---------------------------------------------------------------- suppliers

def _lead(suppkey):
    return (F.lit(1) + suppkey % 14).cast("double")


def suppliers_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pairs = li.select(F.col("l_suppkey").alias("supplier_id"),
                      F.col("l_partkey").alias("product_id")).distinct()
    return pairs.select("supplier_id", "product_id",
                        _lead(F.col("supplier_id")).alias("average_lead_time_days"))


def suppliers_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers keyed by a bare ``id``, with lead time but no product."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("supplier_name"),
                    _lead(F.col("s_suppkey")).alias("average_lead_time_days"))


def suppliers_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
                    F.col("s_acctbal").alias("account_balance"))


# ------------------------------------------------------------- DuckDB twins

_MOVEMENT_TYPE_SQL = """CASE WHEN l_returnflag = 'R' THEN 'RETURN' WHEN l_returnflag = 'A' THEN 'OUT'
         WHEN l_linestatus = 'O' THEN 'Sale' ELSE 'SALE' END"""
_MOVEMENT_Q_SQL = "CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END"
_DATES_SQL = """(SELECT l_partkey, max(l_shipdate) AS date_received, max(o_orderdate) AS last_order_date
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey)"""

SQL_VIEWS = {
    "movements": f"""SELECT l_partkey AS product_id, {_MOVEMENT_TYPE_SQL} AS transaction_type,
       {_MOVEMENT_Q_SQL} AS quantity_change, l_shipdate AS transaction_date, l_suppkey AS supplier_id
  FROM lineitem""",
    "movements_nosale": f"""SELECT l_partkey AS product_id,
       CASE l_returnflag WHEN 'R' THEN 'IN' WHEN 'A' THEN 'MOVE' ELSE 'transfer' END AS transaction_type,
       {_MOVEMENT_Q_SQL} AS quantity_change, l_shipdate AS transaction_date, l_suppkey AS supplier_id FROM lineitem""",
    "movements_labels": f"""SELECT l_partkey AS product_id, CASE l_partkey % 6 WHEN 0 THEN 'sale' WHEN 1 THEN 'SALES'
         WHEN 2 THEN 'Keluar' WHEN 3 THEN 'OUT' WHEN 4 THEN 'RETURN' END AS transaction_type,
       {_MOVEMENT_Q_SQL} AS quantity_change, l_shipdate AS transaction_date, l_suppkey AS supplier_id FROM lineitem""",
    "movements_partial": """SELECT * FROM movements WHERE product_id % 5 <> 0""",
    "inventory_dup": """SELECT * FROM inventory UNION ALL
SELECT product_id, stock_quantity + 5, reorder_level, unit_price, date_received + INTERVAL 1 DAY, last_order_date
  FROM inventory WHERE product_id % 4 = 0""",
    "movements_dirty": f"""WITH b AS (
  SELECT l_partkey AS " Product ID", concat('  ', {_MOVEMENT_TYPE_SQL}, ' ') AS "Transaction Type",
         CASE WHEN l_partkey % 7 = 0 THEN 'n/a' ELSE CAST({_MOVEMENT_Q_SQL} AS VARCHAR) END AS "Quantity",
         CASE WHEN l_partkey % 11 = 0 THEN 'bad' ELSE CAST(l_shipdate AS VARCHAR) END AS "Transaction Date",
         l_suppkey AS "Supplier-ID", l_linenumber AS _ln
  FROM lineitem)
SELECT * EXCLUDE (_ln) FROM b UNION ALL SELECT * EXCLUDE (_ln) FROM b WHERE _ln = 1""",
    "inventory": f"""SELECT p_partkey AS product_id, CAST(p_size AS DOUBLE) * 10 AS stock_quantity,
       CAST(p_size AS DOUBLE) AS reorder_level, p_retailprice AS unit_price, d.date_received, d.last_order_date
  FROM part LEFT JOIN {_DATES_SQL} d ON p_partkey = d.l_partkey""",
    "inventory_nolevel": """SELECT product_id, stock_quantity, unit_price, date_received, last_order_date
  FROM inventory""",
    "inventory_nulls": """SELECT product_id,
       CASE WHEN product_id % 13 <> 0 THEN stock_quantity END AS stock_quantity,
       reorder_level, unit_price,
       CASE WHEN product_id % 3 <> 0 THEN date_received END AS date_received,
       CASE WHEN product_id % 3 <> 0 THEN last_order_date END AS last_order_date
  FROM inventory""",
    "inventory_dirty": f"""WITH b AS (
  SELECT p_partkey AS "Product ID", concat(' ', p_name, '  ') AS "Product Name",
         CAST(p_size AS DOUBLE) * 10 AS "Stock-Quantity", p_size AS "Reorder Level",
         CASE WHEN p_partkey % 7 = 0 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS " Unit Price",
         CAST(d.date_received AS VARCHAR) AS "Date  Received",
         CAST(d.last_order_date AS VARCHAR) AS "Last/Order Date"
  FROM part LEFT JOIN {_DATES_SQL} d ON p_partkey = d.l_partkey)
SELECT * FROM b UNION ALL SELECT * FROM b WHERE "Reorder Level" = 1""",
    "suppliers_by_product": """SELECT supplier_id, product_id, CAST(1 + supplier_id % 14 AS DOUBLE) AS average_lead_time_days
  FROM (SELECT DISTINCT l_suppkey AS supplier_id, l_partkey AS product_id FROM lineitem)""",
    "suppliers_global": """SELECT s_suppkey AS id, s_name AS supplier_name,
       CAST(1 + s_suppkey % 14 AS DOUBLE) AS average_lead_time_days FROM supplier""",
    "suppliers_plain": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS account_balance
  FROM supplier""",
}

# Views other views depend on must come first in a WITH list.
_VIEW_DEPS = {
    "movements_partial": ["movements"],
    "inventory_dup": ["inventory"],
    "inventory_nolevel": ["inventory"],
    "inventory_nulls": ["inventory"],
}


def with_views(*names: str) -> str:
    """A ``WITH`` clause defining the named fixture views (and their deps)."""
    order: list[str] = []

    def add(n):
        for d in _VIEW_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{SQL_VIEWS[n]}\n)" for n in order) + "\n"
