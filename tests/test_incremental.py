"""Gold from stored partials equals gold from all movements."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shelfwise.operators import features as fe
from shelfwise.operators import incremental as ic
from tests.conftest import rows

TRX = "product_id long, transaction_type string, quantity_change double, transaction_date date, supplier_id long"
INV = "product_id long, stock_quantity double, reorder_level double, date_received date, last_order_date date"
SUP = "supplier_id long, product_id long, average_lead_time_days double"


def _tables(spark, kinds):
    rng = random.Random(5)
    day = dt.date(1968, 12, 1)                                   # days before and after 1970, and none
    trx = [(rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice(kinds), rng.choice([-3.0, -1.0, 2.0, None]),
            rng.choice([day + dt.timedelta(days=rng.randrange(800)), None]), 1) for _ in range(600)]
    inv = [(p, 10.0 * p, 2.0, dt.date(2024, 1, 9), dt.date(2024, 1, 2)) for p in range(1, 7)]
    sup = [(1, p, 4.0) for p in range(1, 5)]
    return spark.createDataFrame(trx, TRX), spark.createDataFrame(inv, INV), spark.createDataFrame(sup, SUP)


def _stored(spark, parts, root):
    for n, part in enumerate(parts):
        path = ic.advance(spark, root, part, n)
    return spark.read.parquet(path)


def test_increments_equal_one_pass(spark, tmp_dir):
    for name, kinds in (("labels", ["sale", "OUT", "RETURN", None]), ("none", ["IN", "move", None])):
        trx, inv, sup = _tables(spark, kinds)
        parts = [trx.where(F.pmod(F.hash(*trx.columns), F.lit(4)) == n) for n in range(4)]
        state = _stored(spark, parts, f"{tmp_dir}/{name}")
        want = rows(fe.build_gold(trx, inv, sup), ["product_id"])
        assert rows(ic.gold_of_partials(state, inv, sup), ["product_id"]) == want
        assert rows(ic.summary_of_partials(state)) == rows(fe.movement_summary(trx))


def test_a_late_label_changes_the_rule_of_all_products(spark, tmp_dir):
    old, inv, sup = _tables(spark, ["move"])
    late = spark.createDataFrame([(2, "Sale", -5.0, dt.date(2024, 1, 1), 1)], TRX)
    state = _stored(spark, [old, late], tmp_dir)
    got = rows(ic.gold_of_partials(state, inv, sup), ["product_id"])
    assert got == rows(fe.build_gold(old.unionAll(late), inv, sup), ["product_id"])
    assert [r["product_id"] for r in got if r["total_sales"] is not None] == [2]


def test_a_version_may_run_again_and_an_empty_increment_adds_nothing(spark, tmp_dir):
    trx, inv, sup = _tables(spark, ["sale", "IN"])
    ic.advance(spark, tmp_dir, trx.where("product_id = 1"), 0)
    for _ in range(2):
        path = ic.advance(spark, tmp_dir, trx.where("NOT product_id <=> 1"), 1)
    again = ic.advance(spark, tmp_dir, trx.limit(0), 2)
    want = rows(fe.movement_summary(trx))
    assert rows(ic.summary_of_partials(spark.read.parquet(path))) == want
    assert rows(ic.summary_of_partials(spark.read.parquet(again))) == want


def test_state_has_the_size_of_the_products_and_is_all_that_is_read(spark, tmp_dir):
    trx, inv, sup = _tables(spark, ["sale"])
    trx.write.parquet(f"{tmp_dir}/new")
    ic.advance(spark, f"{tmp_dir}/state", trx, 0)
    state = spark.read.parquet(f"{tmp_dir}/state/v0")
    assert state.count() <= 3 * trx.select("product_id").distinct().count()      # spans before, after 1970, and none
    merged = ic.merge_partials(state, ic.movement_partials(spark.read.parquet(f"{tmp_dir}/new")))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in ln for ln in plan.splitlines()) == 2


def test_text_keys_meet_numbers(spark, tmp_dir):
    trx, inv, sup = _tables(spark, ["sale", "IN"])
    text = trx.withColumn("product_id", F.concat(F.lit("0"), F.col("product_id").cast("string")))
    state = _stored(spark, [text.where("quantity_change < 0"), text.where("NOT coalesce(quantity_change < 0, false)")], tmp_dir)
    assert rows(ic.gold_of_partials(state, inv, sup), ["product_id"]) == rows(fe.build_gold(text, inv, sup), ["product_id"])


def test_a_row_is_as_long_as_its_product_has_days(spark, tmp_dir):
    """Stored days are lists, each day once however many increments it sells in."""
    day = dt.date(2024, 1, 1)
    part = spark.createDataFrame([(p, "SALE", -1.0, day + dt.timedelta(days=p % 3), 1) for p in range(50)], TRX)
    state = _stored(spark, [part, part], tmp_dir)
    assert {(len(r["label_days"]), len(r["minus_days"])) for r in state.collect()} == {(1, 1)}
    one = state.where("product_id = 4").first()
    assert one["label_days"] == [(day - dt.date(1970, 1, 1)).days + 1] and one["label_n"] == 2
