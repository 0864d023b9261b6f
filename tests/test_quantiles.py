"""Exact quantiles against sorted lists and another engine."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import cleaning as cl
from shelfwise.operators.quantiles import exact_quantile


def get(spark, df, *args, **kw):
    return spark.range(1).select(exact_quantile(df, *args, **kw).alias("q")).first()["q"]


def want(values, q, interpolated):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return None
    if not interpolated:
        return v[max(math.ceil(q * len(v)), 1) - 1]
    at = q * (len(v) - 1)
    lo = math.floor(at)
    return v[lo] + (v[lo + 1] - v[lo]) * (at - lo) if at > lo else v[lo]


CASES = {
    "one": [4.0], "two": [1.0, 2.0], "few": [5.0, None, 1.0, 9.0, math.nan, 7.0], "ties": [1.0] * 500 + [2.0] * 500 + [3.0],
    "same": [7.0] * 300, "null": [None, None], "none": [], "odd": [float(i) for i in range(1001)],
    "skew": [1e-9 * i for i in range(3000)] + [1e12, -1e12], "infinite": [math.inf, -math.inf, 0.0, 1.0],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_small(spark, name):
    df = spark.createDataFrame([(v,) for v in CASES[name]], "x double").repartition(3)
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        assert get(spark, df, "x", q) == want(CASES[name], q, False)
        got = get(spark, df, "x", q, interpolated=True)
        expect = want(CASES[name], q, True)
        assert got == expect or got == pytest.approx(expect) or math.isnan(got) and math.isnan(expect)


def test_narrowing_with_a_coarse_sketch(spark):
    """A sketch that is far off still gives the exact value."""
    rng = random.Random(2)
    values = [rng.choice([rng.gauss(0, 1), float(rng.randrange(20)), 3.0]) for _ in range(40_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    for q in (0.003, 0.5, 0.77, 0.999):
        assert get(spark, df, "x", q, accuracy=50) == want(values, q, False)
        assert get(spark, df, "x", q, interpolated=True, accuracy=50) == pytest.approx(want(values, q, True), abs=1e-12)


def test_large_table_and_three_scans(spark):
    path = "/root/testdata/sf0.1/lineitem.parquet"
    df = spark.read.parquet(path)
    con = duckdb.connect()
    for name in ("l_quantity", "l_extendedprice"):
        disc, cont = con.execute(f"SELECT quantile_disc({name}::DOUBLE, 0.5), quantile_cont({name}::DOUBLE, 0.5) "
                                 f"FROM read_parquet('{path}')").fetchone()
        assert get(spark, df, name) == disc
        assert get(spark, df, name, interpolated=True) == pytest.approx(cont, abs=1e-9)
    out = spark.range(1).select(exact_quantile(df, "l_extendedprice").alias("q"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "SortExec" not in plan and "rangepartitioning" not in plan
    assert final.count("FileScan parquet") <= 3 * max(1, final.count("+- == Final Plan =="))


def test_imputation_takes_either_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,), (20.0,)], "x double")
    assert sorted(r[0] for r in cl.impute_median(df, "x").collect()) == [1.0, 2.0, 2.0, 10.0, 20.0]
    assert sorted(r[0] for r in cl.impute_median(df, "x", method="lower").collect()) == [1.0, 2.0, 2.0, 10.0, 20.0]
    assert sorted(r[0] for r in cl.impute_median(df, "x", method="interpolated").collect()) == [1.0, 2.0, 6.0, 10.0, 20.0]
    with pytest.raises(ValueError):
        cl.impute_median(df, "x", method="other")
    assert cl.impute_median(df.where("x IS NULL"), "x", method="lower").select(F.max("x")).first()[0] is None
