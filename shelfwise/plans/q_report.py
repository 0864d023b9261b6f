"""Profiling (V1-V5) and recommendation (R1-R6) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import profiling as pf
from shelfwise.operators import recommend as rc
from shelfwise.plans.catalog import register
from shelfwise.plans.q_gold import GOLD_SQL, _gold
from shelfwise.sources import fixtures as fx


def _gold_cte(extra: str = "") -> str:
    # GOLD_SQL is "WITH ... SELECT ..."; wrap it as a named view.
    return f"WITH gold AS (\n{GOLD_SQL}\n){extra}\n"


@register("row_counts", fx.with_views("movements", "inventory", "suppliers_by_product") + """
SELECT 'movements' AS "table", count(*) AS "rows" FROM movements
UNION ALL SELECT 'inventory', count(*) FROM inventory
UNION ALL SELECT 'suppliers', count(*) FROM suppliers_by_product""")
def row_counts(spark, d):
    """V1: rows per input table."""
    return pf.row_counts(movements=fx.movements(spark, d), inventory=fx.inventory(spark, d),
                         suppliers=fx.suppliers_by_product(spark, d))


@register("risk_summary", _gold_cte() + """SELECT count(*) AS total,
       CAST(count_if(stockout_risk = 1) AS BIGINT) AS at_risk, CAST(count_if(stockout_risk = 0) AS BIGINT) AS safe,
       round(100.0 * count_if(stockout_risk = 1) / greatest(count(*), 1), 1) AS pct_at_risk,
       round(100.0 * count_if(stockout_risk = 0) / greatest(count(*), 1), 1) AS pct_safe
FROM gold""")
def risk_summary(spark, d):
    """V2: class balance of the stock-out label."""
    return pf.risk_summary(_gold(spark, d))


_PROFILE_SQL = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM gold"""
    for c in ("daily_sales_velocity", "stock_on_hand", "procurement_lead_time",
              "order_buffer_index", "safety_stock", "reorder_point"))


@register("profile", _gold_cte() + _PROFILE_SQL)
def profile(spark, d):
    """V3: describe() of the six headline features, numeric long form."""
    p = pf.profile(_gold(spark, d))
    return p.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})  # their last bits depend on the order of sums


# The gold table contract as Spark reports it.
GOLD_SCHEMA = [("product_id", "bigint", True), ("supplier_product_ref", "bigint", True),
               ("initial_stock_quantity", "double", True), ("stock_on_hand", "double", False),
               ("total_sales", "double", True), ("active_days", "bigint", True),
               ("daily_sales_velocity", "double", False), ("actual_lead_time", "double", True),
               ("avg_lead_time_days", "double", True), ("procurement_lead_time", "double", True),
               ("order_buffer_index", "double", True), ("safety_stock", "double", True),
               ("historical_reorder_level", "double", True), ("stockout_risk", "int", False),
               ("reorder_point", "double", False)]
_SCHEMA_SQL = "\nUNION ALL ".join(
    f"""SELECT {i + 1} AS position, '{c}' AS "column", '{t}' AS type, {str(n).lower()} AS nullable,
       count({c}) AS non_nulls FROM gold""" for i, (c, t, n) in enumerate(GOLD_SCHEMA))


@register("schema_table", _gold_cte() + _SCHEMA_SQL)
def schema_table(spark, d):
    """V4: the gold schema with the non-null count of every column."""
    return pf.schema_table(_gold(spark, d))


@register("sample_rows", _gold_cte() + "SELECT * FROM gold ORDER BY product_id LIMIT 5")
def sample_rows(spark, d):
    """V5: five gold rows, lowest product ids first."""
    return pf.sample_rows(_gold(spark, d), 5, ["product_id"])


# ------------------------------------------------------------ recommendations

def scored(spark, d):
    """Deterministic stand-in for model output (FIXTURES.md §B4): the label
    flipped for every tenth product and a scaled reorder point, so that all
    three priorities occur."""
    g = _gold(spark, d)
    pid = F.col("product_id")
    return g.select("*",
                    F.when(pid % 10 == 0, 1 - F.col("stockout_risk"))
                     .otherwise(F.col("stockout_risk")).alias("predicted_stockout"),
                    (F.col("reorder_point") * (pid % 4) / 2.0).alias("predicted_rop"))


_SCORED = """, scored AS (SELECT *, CASE WHEN product_id % 10 = 0 THEN 1 - stockout_risk ELSE stockout_risk END
                       AS predicted_stockout, reorder_point * (product_id % 4) / 2.0 AS predicted_rop FROM gold)"""
_I = {  # written out: the oracle must notice a wrong text
    "HIGH": "Produk ini berisiko tinggi mengalami stockout. "
            "Disarankan segera melakukan restock untuk menghindari kehilangan penjualan.",
    "MEDIUM": "Produk menunjukkan potensi stockout dalam waktu dekat. "
              "Monitoring dan restock dalam waktu dekat sangat disarankan.",
    "LOW": "Stok produk masih dalam kondisi aman. Belum diperlukan tindakan restock dalam waktu dekat."}
_PRIORITY = """CASE WHEN predicted_stockout = 1 AND predicted_rop > stock_on_hand THEN 'HIGH'
            WHEN predicted_stockout = 1 THEN 'MEDIUM' ELSE 'LOW' END"""
_ORDER = """CASE WHEN predicted_rop - stock_on_hand IS NOT NULL
            THEN greatest(predicted_rop - stock_on_hand, 0.0::DOUBLE) END"""
_RECS = f""", recs AS (SELECT *, {_ORDER} AS recommended_order,
       CASE priority WHEN 'HIGH' THEN '{_I['HIGH']}' WHEN 'MEDIUM' THEN '{_I['MEDIUM']}'
                     ELSE '{_I['LOW']}' END AS insight
  FROM (SELECT *, {_PRIORITY} AS priority FROM scored))"""


@register("priority", _gold_cte(_SCORED) + f"""SELECT product_id, predicted_stockout, predicted_rop, stock_on_hand,
       {_PRIORITY} AS priority FROM scored""")
def priority(spark, d):
    """R1."""
    return scored(spark, d).select("product_id", "predicted_stockout", "predicted_rop", "stock_on_hand",
                                   rc.priority_col().alias("priority"))


@register("recommended_order", _gold_cte(_SCORED) + f"""SELECT product_id, predicted_rop, stock_on_hand,
       {_ORDER} AS recommended_order FROM scored""")
def recommended_order(spark, d):
    """R2 (independent of the priority: a LOW row may still order)."""
    return scored(spark, d).select("product_id", "predicted_rop", "stock_on_hand",
                                   rc.recommended_order_col().alias("recommended_order"))


@register("insight", _gold_cte(_SCORED + _RECS) + "SELECT product_id, priority, insight FROM recs")
def insight(spark, d):
    """R3."""
    return rc.recommend(scored(spark, d)).select("product_id", "priority", "insight")


@register("recommend", _gold_cte(_SCORED + _RECS) + "SELECT * FROM recs")
def recommend(spark, d):
    """Every scored column plus priority, recommended_order, insight."""
    return rc.recommend(scored(spark, d))


@register("priority_summary", _gold_cte(_SCORED + _RECS) + """SELECT CAST(count_if(priority = 'HIGH') AS BIGINT) AS high,
       CAST(count_if(priority = 'MEDIUM') AS BIGINT) AS medium, CAST(count_if(priority = 'LOW') AS BIGINT) AS low,
       count(*) AS total FROM recs""")
def priority_summary(spark, d):
    """R4."""
    return rc.priority_summary(rc.recommend(scored(spark, d)))


@register("recommend_sample", _gold_cte(_SCORED + _RECS) + """SELECT product_id, stock_on_hand, predicted_rop, priority,
       recommended_order, insight FROM recs ORDER BY product_id LIMIT 10""")
def recommend_sample(spark, d):
    """Ten recommendations, lowest product ids first."""
    return pf.sample_rows(rc.recommend(scored(spark, d)), 10, ["product_id"],
                          cols=["product_id", *rc.SAMPLE_COLUMNS])
