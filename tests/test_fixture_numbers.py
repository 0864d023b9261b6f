"""The summary numbers FIXTURES.md §B3-§B5 states for the driver tables,
checked on the Spark results directly (no DuckDB)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfwise.operators import modeling as md

# sf: products, avg stockout_risk, share with stock 0, negative safety stock, avg reorder point
GOLD = {"0.001": (200, 0.795, 0.57, 35, 1297.15055), "0.01": (2000, 0.839, 0.4945, 290, 1397.31662)}
PRIORITY = {"0.001": (108, 37, 55), "0.01": (1171, 371, 458)}


@pytest.mark.parametrize("sf", sorted(GOLD))
def test_gold_summary(spark, sf):
    g = E.queries()["gold_features"](spark, f"/root/testdata/sf{sf}")
    r = g.agg(F.count(F.lit(1)).alias("n"), F.avg("stockout_risk").alias("risk"),
              F.avg((F.col("stock_on_hand") == 0).cast("int")).alias("zero"),
              F.count_if(F.col("safety_stock") < 0).alias("neg"), F.avg("reorder_point").alias("rop")).first()
    n, risk, zero, neg, rop = GOLD[sf]
    assert (r["n"], r["neg"]) == (n, neg)
    assert r["risk"] == pytest.approx(risk, abs=1e-9) and r["zero"] == pytest.approx(zero, abs=1e-9)
    assert r["rop"] == pytest.approx(rop, abs=1e-5)


@pytest.mark.parametrize("sf", sorted(PRIORITY))
def test_priority_counts(spark, sf):
    r = E.queries()["priority_summary"](spark, f"/root/testdata/sf{sf}").first()
    assert (r["high"], r["medium"], r["low"]) == PRIORITY[sf]


def test_split_size(spark):
    g = E.queries()["gold_features"](spark, "/root/testdata/sf0.01")
    train, test = md.split(g)
    assert (train.count(), test.count()) == (1605, 395)
