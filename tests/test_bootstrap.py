"""Poisson bootstrap against plain resampling by the same hashes."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import bootstrap as bs
from shelfwise.operators import metrics as mt
from shelfwise.session import stored_rows


def copies(key, replicate, seed=42):
    if replicate == 0:
        return 1
    u = int(hashlib.md5(f"{seed}|{replicate}|{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2 ** 52
    k, p, total = 0, math.exp(-1), math.exp(-1)
    while total <= u and k < 60:
        k += 1
        p /= k
        total += p
    return k


def data(n=200):
    rng = random.Random(6)
    return [(i, rng.gauss(10, 3), rng.choice([0, 1]), round(rng.gauss(0, 1), 1)) for i in range(n)]


def test_weights_are_poisson():
    drawn = [copies(k, r) for k in range(200) for r in range(1, 41)]
    assert abs(np.mean(drawn) - 1) < 0.04 and abs(np.var(drawn) - 1) < 0.08
    cdf = bs.poisson_cdf()
    assert cdf == sorted(cdf) and cdf[0] == pytest.approx(math.exp(-1)) and 1 - cdf[-1] < 1e-15 and len(cdf) < 25


def test_regression(spark):
    rows = [(k, y, y + s) for k, y, _, s in data()] + [(900, None, 1.0), (901, 1.0, None)]
    df = spark.createDataFrame(rows, "k long, y double, p double").repartition(5)
    got = {r[bs.REPLICATE]: r for r in bs.regression_by_replicate(df, "y", "p", "k", 20).collect()}
    assert sorted(got) == list(range(21))
    for b in got:
        w = np.array([copies(k, b) for k, _, _ in rows[:200]])
        y = np.repeat([r[1] for r in rows[:200]], w)
        e = y - np.repeat([r[2] for r in rows[:200]], w)
        assert got[b]["mae"] == pytest.approx(np.abs(e).mean()) and got[b]["rmse"] == pytest.approx(math.sqrt((e * e).mean()))
        assert got[b]["r2"] == pytest.approx(1 - (e * e).sum() / ((y - y.mean()) ** 2).sum())
    plain = mt.regression_metrics(df, "y", "p").first()
    assert got[0]["mae"] == pytest.approx(plain["mae"]) and got[0]["r2"] == pytest.approx(plain["r2"])


def test_auc(spark):
    rows = [(k, c, s + c / 2) for k, _, c, s in data()]
    df = spark.createDataFrame(rows, "k long, c int, s double").repartition(5)
    got = {r[bs.REPLICATE]: r["auc"] for r in bs.auc_by_replicate(df, "c", "s", "k", 10, buckets=16).collect()}
    for b in got:
        w = [copies(k, b) for k, _, _ in rows]
        up = [(s, n) for (_, c, s), n in zip(rows, w) if c == 1 and n]
        down = [(s, n) for (_, c, s), n in zip(rows, w) if c == 0 and n]
        x = sum(n * m * ((s > t) + (s == t) / 2) for s, n in up for t, m in down)
        assert got[b] == pytest.approx(x / (sum(n for _, n in up) * sum(m for _, m in down)))
    assert got[0] == pytest.approx(mt.auc(df, "c", "s").first()["auc"])
    one = bs.auc_by_replicate(df.where("c = 1"), "c", "s", "k", 2, buckets=4).collect()
    assert {r["auc"] for r in one} == {None}


def test_intervals(spark):
    rows = [(k, y, y + s) for k, y, _, s in data()]
    df = spark.createDataFrame(rows, "k long, y double, p double")
    by = bs.regression_by_replicate(df, "y", "p", "k", 40)
    for layout in (df, df.repartition(3, "y")):
        got = {r["metric"]: r for r in bs.intervals(bs.regression_by_replicate(layout, "y", "p", "k", 40), 0.9).collect()}
        assert set(got) == {"mae", "rmse", "r2"}
        for m, r in got.items():
            drawn = [x[m] for x in by.collect() if x[bs.REPLICATE] > 0]
            assert r["lower"] == pytest.approx(np.quantile(drawn, 0.05)) and r["upper"] == pytest.approx(np.quantile(drawn, 0.95))
            assert r["lower"] <= r["estimate"] <= r["upper"]
    assert bs.intervals(bs.regression_by_replicate(df.limit(0), "y", "p", "k", 5)).collect() == []


def test_weights_are_native_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "k long, y double, p double")
    plan = bs.regression_by_replicate(df, "y", "p", "k", 3)._jdf.queryExecution().executedPlan().toString()
    assert "md5" in plan and "lambda" not in plan and "conv(" not in plan
    got = bs.replicated(df.withColumn("k", F.lit(None).cast("long")), "k", 60).collect()
    assert {r[bs.REPLICATE]: r[bs.WEIGHT] for r in got} == {b: copies(None, b) for b in range(61) if copies(None, b)}


def test_stored_rows_are_read_not_made_again(spark, tmp_dir):
    spark.range(1000, numPartitions=1).write.parquet(f"{tmp_dir}/source")
    df = stored_rows(spark.read.parquet(f"{tmp_dir}/source").withColumn("x", F.col("id") * 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_dir}/source" not in plan and df.where("x = 2 * id").count() == 1000
    assert len(df.inputFiles()) > 1
