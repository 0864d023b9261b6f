"""Restocking recommendations (R1-R5) as native column rules.

The reference applies Python row functions over a pandas frame; here every
rule is a ``CASE`` expression that runs inside whole-stage codegen. pandas
NaN means "missing", so NaN inputs are turned into nulls first; the
outcomes then equal the pandas ones (NaN > x is false -> MEDIUM/LOW;
max(NaN, 0) stays missing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import nan_to_null, qcol

HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"

# The advice text per priority, as printed by the reference
# (Indonesian). Pass ``texts=`` to use other wording.
DEFAULT_INSIGHTS = {
    HIGH: ("Produk ini berisiko tinggi mengalami stockout. "
           "Disarankan segera melakukan restock untuk menghindari kehilangan penjualan."),
    MEDIUM: ("Produk menunjukkan potensi stockout dalam waktu dekat. "
             "Monitoring dan restock dalam waktu dekat sangat disarankan."),
    LOW: ("Stok produk masih dalam kondisi aman. "
          "Belum diperlukan tindakan restock dalam waktu dekat."),
}


def _num(name: str) -> Column:
    return nan_to_null(qcol(name).cast("double"))


def priority_col(stockout: str = "predicted_stockout", rop: str = "predicted_rop",
                 stock: str = "stock_on_hand") -> Column:
    """Stock-out predicted and ROP above stock -> HIGH; stock-out -> MEDIUM; else LOW."""
    out = _num(stockout) == 1
    return (F.when(out & (_num(rop) > _num(stock)), F.lit(HIGH))
             .when(out, F.lit(MEDIUM))
             .otherwise(F.lit(LOW)))


def recommended_order_col(rop: str = "predicted_rop", stock: str = "stock_on_hand") -> Column:
    """R2: max(ROP - stock, 0); missing when either input is missing."""
    gap = _num(rop) - _num(stock)
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0)))


def insight_col(priority: Column, texts: dict | None = None) -> Column:
    """One advice text per priority."""
    t = {**DEFAULT_INSIGHTS, **(texts or {})}
    return (F.when(priority == HIGH, F.lit(t[HIGH]))
             .when(priority == MEDIUM, F.lit(t[MEDIUM]))
             .otherwise(F.lit(t[LOW])))


def recommend(scored: DataFrame, texts: dict | None = None, stockout: str = "predicted_stockout",
              rop: str = "predicted_rop", stock: str = "stock_on_hand") -> DataFrame:
    """Every input column plus priority, recommended_order, insight."""
    pr = priority_col(stockout, rop, stock)
    return (scored.select("*", pr.alias("priority"),
                          recommended_order_col(rop, stock).alias("recommended_order"))
                  .withColumn("insight", insight_col(F.col("priority"), texts)))


def priority_summary(recs: DataFrame) -> DataFrame:
    """Number of HIGH / MEDIUM / LOW rows (zeros shown), one aggregate."""
    p = F.col("priority")
    return recs.agg(F.count_if(p == HIGH).alias("high"), F.count_if(p == MEDIUM).alias("medium"),
                    F.count_if(p == LOW).alias("low"), F.count(F.lit(1)).alias("total"))


SAMPLE_COLUMNS = ("stock_on_hand", "predicted_rop", "priority", "recommended_order", "insight")
