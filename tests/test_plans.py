"""Plan checks: no Python in the hot path, no jobs while building, one fact
scan, no extra exchange for the product joins, and the registry against
its DuckDB oracles at sf0.001."""

import duckdb
import pytest

from shelfwise.operators import features as fe
from shelfwise.operators import recommend as rc
from shelfwise.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _gold(spark):
    return fe.build_gold(fx.movements(spark, SF_SMALL), fx.inventory(spark, SF_SMALL),
                         fx.suppliers_by_product(spark, SF_SMALL))


def test_no_python_udf_in_gold(spark):
    from shelfwise.plans.q_report import scored
    plan = _plan(rc.recommend(scored(spark, SF_SMALL)))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_building_launches_no_job(spark):
    trx, inv, sup = (fx.movements(spark, SF_SMALL), fx.inventory(spark, SF_SMALL),
                     fx.suppliers_by_product(spark, SF_SMALL))
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    sc.setJobGroup("build-only", "build gold without running it")
    try:
        g = fe.build_gold(trx, inv, sup)
        rc.recommend(g.withColumnRenamed("stockout_risk", "predicted_stockout")
                      .withColumnRenamed("reorder_point", "predicted_rop"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup("build-only")) == []


def test_one_fact_scan_and_copartitioned_joins(spark, tmp_dir):
    # Inputs as plain Parquet tables, as in a real silver zone.
    for name, fn in (("trx", fx.movements), ("inv", fx.inventory), ("sup", fx.suppliers_by_product)):
        fn(spark, SF_SMALL).write.parquet(f"{tmp_dir}/{name}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        g = fe.build_gold(*(spark.read.parquet(f"{tmp_dir}/{n}") for n in ("trx", "inv", "sup")))
        plan = _plan(g)
        scans = [ln for ln in plan.splitlines() if "FileScan" in ln and f"{tmp_dir}/trx]" in ln]
        # the movements are aggregated from one scan; the other scan is the
        # LIMIT 1 probe of the fallback flag (one column), evaluated once.
        assert len(scans) == 2
        assert sum("quantity_change" in ln for ln in scans) == 1
        assert "CollectLimit 1" in plan
        # movements (2 levels), inventory dedup and supplier pick shuffle;
        # the two joins on product_id add no exchange of their own.
        assert plan.count("Exchange hashpartitioning") == 4
        assert plan.count("SortMergeJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _registry():
    """The library's own queries (the optional ones have tests of their own)."""
    from shelfwise.plans import catalog
    return catalog.queries(), catalog.oracle_sql()


SLOW = {"train_risk", "evaluate_risk", "train_reorder", "score", "model_recommend"}


def test_registry_shape():
    qs, oracle = _registry()
    assert set(oracle) <= set(qs)
    assert set(qs) - set(oracle) == SLOW
    assert len(qs) >= 60


def test_entry_smoke(spark):
    import __spark_entry__ as E
    assert set(_registry()[0]) <= set(E.queries()) and set(_registry()[1]) <= set(E.oracle_sql())
    df = E.entry(spark)
    assert df.count() == 200
    assert df.columns[0] == "product_id"


@pytest.mark.parametrize("name", sorted(_registry()[1]))
def test_query_matches_oracle(spark, name):
    from tools.oracle_check import digest
    qs, oracle = _registry()
    df = qs[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for t in fx.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(oracle[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_auc_reads_its_input_once(spark):
    """The quantile subquery and the main branch share the shuffle of the distinct scores."""
    from shelfwise.plans.q_model import auc
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan, gold = _plan(auc(spark, SF_SMALL)), _plan(_gold(spark))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "ReusedExchange" in plan and "scalar-subquery" in plan
    assert plan.count("FileScan") == gold.count("FileScan")


def test_fallback_probe_is_in_the_plan(spark):
    """The no-sale fixture can't be folded: the plan holds the existence test."""
    plan = _plan(fe.build_gold(fx.movements_nosale(spark, SF_SMALL), fx.inventory(spark, SF_SMALL),
                               fx.suppliers_by_product(spark, SF_SMALL)))
    assert "Subquery" in plan and plan.count("FileScan") > _plan(_gold(spark)).count("FileScan") - 1
