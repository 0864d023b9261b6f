"""Bucketed zones without exchanges; drifting JSON as VARIANT."""

from pyspark.sql import functions as F

from shelfwise.operators import features as fe
from shelfwise.operators import incremental as ic
from shelfwise.plans.q_io import bucketed_inputs
from shelfwise.sources import fixtures as fx
from shelfwise.sources import variant as va
from shelfwise.sources import zones as zo
from tests.conftest import SF_SMALL, rows


def test_gold_of_bucketed_zones_has_no_exchange(spark):
    partials, inv, sup = bucketed_inputs(spark, SF_SMALL, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gold = ic.gold_of_partials(partials, inv, sup)
        plan = gold._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 2 and "BroadcastHashJoin" not in plan
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
        got = rows(gold, ["product_id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = fe.build_gold(fx.movements(spark, SF_SMALL), fx.inventory(spark, SF_SMALL), fx.suppliers_by_product(spark, SF_SMALL))
    assert got == rows(want, ["product_id"]) and len(got) > 100


def test_movements_can_be_bucketed_too(spark, tmp_dir):
    zo.write_bucketed(fx.movements(spark, SF_SMALL), "zone_of_movements", "product_id", 4, path=f"{tmp_dir}/m")
    back = zo.read_bucketed(spark, "zone_of_movements")
    summary = fe.movement_summary(back)
    assert "hashpartitioning" not in summary._jdf.queryExecution().executedPlan().toString()
    assert rows(summary) == rows(fe.movement_summary(fx.movements(spark, SF_SMALL)))


LINES = ['{"id": 1, "lead": 7, "tags": ["a"]}', '{"id": "2", "lead": "8"}', '{"id": 3, "lead": {"days": 9}}', "",
         '{"id": 4, "lead": "soon"}', "{cut off", '{"id": 5}', "[1, 2]", '{"id": null, "lead": 1.5}', "  "]


def test_fields_that_drift(spark, tmp_dir):
    for n, part in enumerate((LINES[:4], LINES[4:])):
        with open(f"{tmp_dir}/{n}.json", "w") as f:
            f.write("\n".join(part) + "\n")
        landed = va.land_json_variant(spark, f"{tmp_dir}/{n}.json", f"{tmp_dir}/zone")
    assert landed.count() == 8 and [r[0] for r in landed.where(f"{va.BAD} IS NOT NULL").select(va.BAD).collect()] == ["{cut off"]
    good = landed.where(f"{va.BAD} IS NULL")
    out = va.variant_fields(good, {"id": ("long", ["$.id"]), "lead": ("double", ["$.lead", "$.lead.days"])})
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, 7.0), (2, 8.0), (3, 9.0), (4, None), (5, None), (None, None), (None, 1.5)], key=str)
    kinds = {(r["path"], r["type"]): r["rows"] for r in va.type_counts(good, ["$.lead"]).collect()}
    assert kinds[("$.lead", "STRING")] == 2 and sum(kinds.values()) == 7
    schema = spark.range(1).select(va.merged_schema(good).alias("s")).first()["s"]
    assert "VARIANT" in schema


def test_nothing_landed(spark, tmp_dir):
    with open(f"{tmp_dir}/empty.json", "w") as f:
        f.write("\n\n")
    landed = va.land_json_variant(spark, f"{tmp_dir}/empty.json", f"{tmp_dir}/zone")
    assert landed.collect() == [] and landed.columns == [va.VALUE, va.BAD]
    assert va.variant_fields(landed, {"id": ("long", ["$.id"])}).collect() == []
    assert landed.select(F.col(va.BAD)).dtypes == [(va.BAD, "string")]
