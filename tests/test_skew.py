"""A hot product holding about a third of all movements: results equal a
brute-force pandas computation of the same formulas on the small input."""

import math

import pandas as pd
from pyspark.sql import functions as F

from shelfwise.functions.columns import SALE_LABELS
from shelfwise.operators import cleaning as cl
from shelfwise.operators import features as fe
from shelfwise.sources import fixtures as fx
from tests.conftest import SF_SMALL


def hot(spark):
    li = fx.table(spark, SF_SMALL, "lineitem")
    rf, ls, q = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    return li.select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("l_partkey")).alias("product_id"),
        F.when(rf == "R", "RETURN").when(rf == "A", "OUT").when(ls == "O", "Sale").otherwise("SALE")
         .alias("transaction_type"),
        F.when(rf == "R", q).otherwise(-q).alias("quantity_change"),
        F.col("l_shipdate").alias("transaction_date"),
    )


def brute_force(trx: pd.DataFrame, inv: pd.DataFrame, lead: dict) -> pd.DataFrame:
    sale = trx["transaction_type"].str.upper().isin(SALE_LABELS)
    sales = trx[sale]
    net = trx.groupby("product_id")["quantity_change"].sum()
    tot = sales.groupby("product_id")["quantity_change"].sum().abs()
    days = sales.assign(d=sales["transaction_date"].dt.date).groupby("product_id")["d"].nunique()
    out = []
    for r in inv.itertuples():
        p = r.product_id
        stock = max(r.stock_quantity + net.get(p, 0.0), 0.0)
        t, dd = tot.get(p), days.get(p)
        v = 0.0 if t is None else (t / dd if dd > 0 else t)
        actual = (r.date_received.normalize() - r.last_order_date.normalize()).days
        avg = lead.get(p)
        proc = (actual + (7.0 if avg is None else avg)) / 2.0
        safety = v * proc
        out.append({"product_id": p, "stock_on_hand": stock, "daily_sales_velocity": v,
                    "active_days": dd, "stockout_risk": int(stock <= safety),
                    "reorder_point": max((v * proc * 2 + r.reorder_level) / 2.0, 0.0)})
    return pd.DataFrame(out).set_index("product_id")


def test_hot_product_gold_equals_brute_force(spark):
    trx = hot(spark)
    share = trx.filter("product_id = 0").count() / trx.count()
    assert share > 0.3
    inv = fx.inventory(spark, SF_SMALL)
    sup = fx.suppliers_by_product(spark, SF_SMALL)
    g = fe.build_gold(trx, inv, sup).toPandas().set_index("product_id")
    lead = {r["supplied_product"]: r["avg_lead_time_days"]
            for r in fe.supplier_lead_by_product(sup, fe.resolve_supplier_roles(sup.columns)).collect()}
    inv_pd = inv.toPandas().dropna(subset=["date_received"])
    bf = brute_force(trx.toPandas(), inv_pd, lead)
    for p, row in bf.iterrows():
        got = g.loc[p]
        for c in ("stock_on_hand", "daily_sales_velocity", "stockout_risk", "reorder_point"):
            assert math.isclose(got[c], row[c], rel_tol=1e-12, abs_tol=1e-12), (p, c, got[c], row[c])
    assert g.loc[0, "active_days"] == bf.loc[0, "active_days"] > 100


def test_hot_key_dedup(spark):
    rows = [(0, i) for i in range(3000)] + [(k, k) for k in range(1, 6000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(8)
    out = {r["k"]: r["v"] for r in cl.dedup_by_key(df, ["k"]).collect()}
    assert out[0] == 2999 and len(out) == 6000
