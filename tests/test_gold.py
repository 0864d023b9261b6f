"""Micro-golden gold table (FIXTURES.md §C1, §C4) and gold invariants."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import features as fe
from shelfwise.functions.naming import resolve_transaction_roles
from tests.conftest import SF_SMALL, rows

INV = [("P1", 100.0, 20.0, "2024-01-11", "2024-01-01"),
       ("P2", None, None, None, None),
       ("P3", 10.0, 4.0, None, None),
       ("P4", 50.0, None, "2024-01-01", "2024-01-05"),
       ("P5", 5.0, 10.0, "2024-01-04", "2024-01-01")]
INV_SCHEMA = "product_id string, stock_quantity double, reorder_level double, date_received string, last_order_date string"
TRX = [("P1", "SALE", -30.0, "2024-01-02"), ("P1", "sale", -10.0, "2024-01-02"),
       ("P1", "OUT", -20.0, "2024-01-03"), ("P1", "RETURN", 5.0, "2024-01-04"),
       ("P4", "SALE", -8.0, "2024-01-02"), ("P5", "SALE", -20.0, None)]
TRX_SCHEMA = "product_id string, transaction_type string, quantity_change double, transaction_date string"
SUP = [("S1", "P1", 6.0), ("S2", "P1", 9.0), ("S3", "P3", 5.0), ("S4", "P4", 2.0)]
SUP_SCHEMA = "supplier_id string, product_id string, average_lead_time_days double"

# p: stock_on_hand, total_sales, active_days, velocity, actual, avg, procurement,
#    buffer, safety, risk, reorder_point
EXPECTED = {
    "P1": (45.0, 60.0, 2, 30.0, 10.0, 6.0, 8.0, 1.5, 240.0, 1, 250.0),
    "P2": (0.0, None, None, 0.0, None, None, None, None, None, 1, 0.0),
    "P3": (10.0, None, None, 0.0, None, 5.0, 5.0, None, 0.0, 0, 2.0),
    "P4": (42.0, 8.0, 1, 8.0, -4.0, 2.0, -1.0, 5.25, -8.0, 0, 0.0),
    "P5": (0.0, 20.0, 0, 20.0, 3.0, None, 5.0, 0.0, 100.0, 1, 105.0),
}
COLS = ("stock_on_hand", "total_sales", "active_days", "daily_sales_velocity", "actual_lead_time",
        "avg_lead_time_days", "procurement_lead_time", "order_buffer_index", "safety_stock",
        "stockout_risk", "reorder_point")


@pytest.fixture()
def tables(spark):
    return (spark.createDataFrame(TRX, TRX_SCHEMA), spark.createDataFrame(INV, INV_SCHEMA),
            spark.createDataFrame(SUP, SUP_SCHEMA))


def test_micro_golden(tables):
    trx, inv, sup = tables
    g = fe.build_gold(trx, inv, sup)
    assert g.columns == ["product_id", "supplier_product_ref", "initial_stock_quantity", "stock_on_hand",
                         "total_sales", "active_days", "daily_sales_velocity", "actual_lead_time",
                         "avg_lead_time_days", "procurement_lead_time", "order_buffer_index",
                         "safety_stock", "historical_reorder_level", "stockout_risk", "reorder_point"]
    got = {r["product_id"]: tuple(r[c] for c in COLS) for r in g.collect()}
    assert got == EXPECTED
    refs = {r["product_id"]: r["supplier_product_ref"] for r in g.collect()}
    assert refs == {"P1": "P1", "P2": None, "P3": "P3", "P4": "P4", "P5": None}


def test_without_reorder_level(tables):
    trx, inv, sup = tables
    g = fe.build_gold(trx, inv.drop("reorder_level"), sup)
    assert "historical_reorder_level" not in g.columns
    got = {r["product_id"]: r["reorder_point"] for r in g.collect()}
    assert got == {"P1": 480.0, "P2": 0.0, "P3": 0.0, "P4": 0.0, "P5": 200.0}


def test_supplier_modes(spark, tables):
    trx, inv, _ = tables
    glob = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 9.0), (4, None)], "id long, lead_time double")
    g = fe.build_gold(trx, inv, glob)
    assert "supplier_product_ref" not in g.columns
    assert {r["avg_lead_time_days"] for r in g.collect()} == {4.0}
    plain = spark.createDataFrame([(1, "a")], "supplier_id long, name string")
    assert {r["avg_lead_time_days"] for r in fe.build_gold(trx, inv, plain).collect()} == {7.0}
    allnull = spark.createDataFrame([(1, None)], "id long, lead_time double")
    assert {r["avg_lead_time_days"] for r in fe.build_gold(trx, inv, allnull).collect()} == {7.0}


def test_fallback_and_label(spark):
    base = [("A", "IN", -2.0, "2024-01-01"), ("A", "in", 5.0, "2024-01-01"), ("A", "MOVE", -1.0, "2024-01-02")]
    trx = spark.createDataFrame(base, TRX_SCHEMA)
    assert sorted(r["quantity_change"] for r in fe.sales_rows(trx).collect()) == [-2.0, -1.0]
    trx2 = spark.createDataFrame(base + [("B", "sale", 3.0, "2024-01-03")], TRX_SCHEMA)
    assert [r["quantity_change"] for r in fe.sales_rows(trx2).collect()] == [3.0]
    assert fe.sales_rows(trx, fallback=False).count() == 0
    s = {r["product_id"]: r for r in fe.movement_summary(trx).collect()}
    assert (s["A"]["total_sales"], s["A"]["active_days"], s["A"]["net_change"]) == (3.0, 2, 2.0)


def test_null_type_is_not_a_sale(spark):
    trx = spark.createDataFrame([("A", None, -2.0, "2024-01-01"), ("A", "SALES", -1.0, None)], TRX_SCHEMA)
    s = fe.movement_summary(trx).collect()[0]
    assert (s["total_sales"], s["active_days"]) == (1.0, 0)


def test_key_types_are_reconciled(spark, tables):
    trx, inv, sup = tables
    inv_num = spark.createDataFrame([(1, 10.0)], "product_id long, stock_quantity double")
    trx_txt = spark.createDataFrame([("1", "SALE", -4.0, "2024-01-01")], TRX_SCHEMA)
    g = fe.build_gold(trx_txt, inv_num, sup).collect()[0]
    assert (g["product_id"], g["stock_on_hand"], g["total_sales"]) == (1, 6.0, 4.0)


def test_duplicate_inventory_rows_collapse(spark, tables):
    trx, inv, sup = tables
    dup = inv.unionByName(inv.filter("product_id = 'P1'").withColumn("stock_quantity", F.lit(1.0)))
    g = fe.build_gold(trx, dup, sup)
    assert g.count() == 5
    assert [r["initial_stock_quantity"] for r in g.filter("product_id = 'P1'").collect()] == [100.0]


def test_invariants_and_layout_independence(spark):
    from shelfwise.sources import fixtures as fx
    trx = fx.movements(spark, SF_SMALL)
    g = fe.build_gold(trx, fx.inventory(spark, SF_SMALL), fx.suppliers_by_product(spark, SF_SMALL))
    bad = g.filter((F.col("stock_on_hand") < 0) | (F.col("reorder_point") < 0)
                   | (~F.col("stockout_risk").isin(0, 1))
                   | ((F.col("active_days") > 0)
                      & (F.abs(F.col("daily_sales_velocity") * F.col("active_days") - F.col("total_sales")) > 1e-6)))
    assert bad.count() == 0
    g2 = fe.build_gold(trx.repartition(7).sortWithinPartitions(F.rand(3)),
                       fx.inventory(spark, SF_SMALL).repartition(3), fx.suppliers_by_product(spark, SF_SMALL))
    assert rows(g, ["product_id"]) == rows(g2, ["product_id"])


def test_movement_roles_from_columns(spark, tables):
    trx, _, _ = tables
    r = resolve_transaction_roles(trx.columns)
    assert r.quantity == "quantity_change"


def test_raw_headers_are_normalized(spark):
    trx = spark.createDataFrame(TRX, "`Product ID` string, `Transaction-Type` string, "
                                     "`Quantity  Change` double, `Transaction/Date` string")
    inv = spark.createDataFrame(INV, "` Product ID` string, `Stock Quantity` double, `Reorder - Level` double, "
                                     "`Date Received` string, `Last Order Date` string")
    sup = spark.createDataFrame(SUP, "`Supplier ID` string, `Product ID` string, `Lead-Time Days` double")
    got = {r["product_id"]: tuple(r[c] for c in COLS) for r in fe.build_gold(trx, inv, sup).collect()}
    assert got == EXPECTED


def test_duplicate_inventory_latest_received_wins(spark, tables):
    trx, inv, sup = tables
    newer = spark.createDataFrame([("P4", 1.0, None, "2024-01-09", "2024-01-05")], INV_SCHEMA)
    g = fe.build_gold(trx, inv.unionByName(newer), sup).filter("product_id = 'P4'").collect()
    assert len(g) == 1 and g[0]["initial_stock_quantity"] == 1.0 and g[0]["actual_lead_time"] == 4.0


def test_options_and_overrides(spark, tables):
    trx, inv, sup = tables
    # fallback off: a table without labels has no sales at all
    nolabel = trx.withColumn("transaction_type", F.lit("MOVE"))
    g = {r["product_id"]: r for r in fe.build_gold(nolabel, inv, sup, fallback=False).collect()}
    assert g["P1"]["total_sales"] is None and g["P1"]["daily_sales_velocity"] == 0.0
    # with the fallback, negative quantities count
    g = {r["product_id"]: r for r in fe.build_gold(nolabel, inv, sup).collect()}
    assert g["P1"]["total_sales"] == 60.0
    # dedup off keeps repeated inventory rows
    dup = inv.unionByName(inv.filter("product_id = 'P2'"))
    assert fe.build_gold(trx, dup, sup, dedup=False).count() == 6
    # an override picks another column for a role
    inv2 = inv.withColumn("product_name", F.lit("x")).select("product_name", *inv.columns)
    with_override = fe.build_gold(trx, inv2, sup, overrides={"inventory": {"product": "product_id"}})
    assert sorted(r["product_id"] for r in with_override.collect()) == ["P1", "P2", "P3", "P4", "P5"]
