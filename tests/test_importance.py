"""Permutation importance against a plain computation and with trained forests."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import importance as im
from shelfwise.operators import modeling as md
from shelfwise.plans.q_gold import _gold
from tests.conftest import SF_SMALL, rows


def digest(*parts):
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def brute(data, names, predict, buckets, seed):
    """(loss, increase) by feature; data: key -> dict."""
    def mean(of):
        return sum((d["y"] - predict(v)) ** 2 for d, v in of) / len(of)
    base = mean([(d, d) for d in data.values()])
    out = {}
    for f in names:
        groups = {}
        for k in data:
            groups.setdefault(int(digest(str(k))[:7], 16) % buckets, []).append(k)
        taken = {}
        for keys in groups.values():
            keys.sort(key=lambda k: digest(str(seed), f, str(k)))
            taken |= {k: data[n][f] for k, n in zip(keys, keys[1:] + keys[:1])}
        loss = mean([(d, d | {f: taken[k]}) for k, d in data.items()])
        out[f] = (loss, loss - base)
    return out


@pytest.mark.parametrize("buckets", [1, 7])
def test_values(spark, buckets):
    rng = random.Random(1)
    data = {k: {"a": rng.random(), "b": float(rng.randrange(3)), "c": 1.0} for k in range(300)}
    for d in data.values():
        d["y"] = 3 * d["a"] + d["b"] + rng.gauss(0, 0.1)
    df = spark.createDataFrame([(k, d["a"], d["b"], d["c"], d["y"]) for k, d in data.items()], "k long, a double, b double, c double, y double")
    want = brute(data, ["a", "b", "c"], lambda v: 3 * v["a"] + v["b"], buckets, 42)
    for layout in (df, df.repartition(7, "b")):
        got = im.permutation_importance(layout, lambda d: d.withColumn("prediction", 3 * F.col("a") + F.col("b")), ["a", "b", "c"],
                                        "y", "k", buckets=buckets)
        got = {r["feature"]: (r["loss"], r["increase"]) for r in got.collect()}
        assert got.keys() == want.keys()
        for f in want:
            assert got[f] == pytest.approx(want[f])
    assert got["c"][1] == 0.0 and got["a"][1] > 0.5


def test_it_is_a_permutation_with_nulls(spark):
    df = spark.createDataFrame([(k, None if k % 3 == 0 else float(k), k % 2) for k in range(50)] + [(None, 5.5, 0), (7, 7.5, 1)],
                               "k long, x double, z long")
    out = im.permuted(df, ["x", "z"], "k", 3).collect()
    assert sorted(str(r["x"]) for r in out) == sorted(str(r["_permuted"]["x"]) for r in out)
    assert sorted(r["z"] for r in out) == sorted(r["_permuted"]["z"] for r in out)
    assert sum(r["x"] != r["_permuted"]["x"] for r in out) > 30
    one = df.where("k = 7 AND x = 7.0")
    assert im.permuted(one, ["x"], "k", 3).first()["_permuted"]["x"] == 7.0
    assert im.permuted(df.limit(0), ["x"], "k", 3).collect() == []


def test_with_forests(spark):
    gold = _gold(spark, SF_SMALL).persist()
    features = md.select_features(gold)
    rop = md.train_reorder(gold, num_trees=10)
    filled = md.fill_zero(gold.select("product_id", "reorder_point", "stockout_risk", *features))
    got = rows(im.permutation_importance(filled, rop.transform, features, "reorder_point", "product_id"), ["feature"])
    assert len(got) == len(features) and max(r["increase"] for r in got) > 0
    best = max(got, key=lambda r: r["increase"])["feature"]
    assert best in ("daily_sales_velocity", "total_sales", "procurement_lead_time", "active_days", "actual_lead_time")
    risk = md.train_risk(gold, num_trees=10)

    def probability(df):
        return risk.transform(df).withColumn("prediction", md.positive_probability())

    by_loss = rows(im.permutation_importance(filled, probability, features, "stockout_risk", "product_id", loss=im.log_loss), ["feature"])
    assert {r["feature"] for r in by_loss} == set(features) and all(r["loss"] >= 0 for r in by_loss)


def test_forest_rows_are_dealt_evenly(spark):
    """However few parts the rows come in, tasks of a forest have a bounded number; few rows stay as they are."""
    n = 5 * md.ROWS_PER_TASK
    gold = spark.range(n, numPartitions=1).withColumnRenamed("id", "product_id")
    with md.training_rows(gold) as (rows, seen):
        sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert seen == sum(sizes) == n and len(sizes) == 5 and max(sizes) < 1.2 * md.ROWS_PER_TASK
        assert rows.is_cached
    assert not rows.is_cached and not gold.is_cached
    few = gold.limit(10)
    assert md.dealt(few, 10) is few
