"""Recommendations (FIXTURES.md §C2), metrics against MLlib, the hash split."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from shelfwise.operators import metrics as mt
from shelfwise.operators import modeling as md
from shelfwise.operators import profiling as pf
from shelfwise.operators import recommend as rc

C2 = [(1, 50.0, 40.0, "HIGH", 10.0), (1, 40.0, 40.0, "MEDIUM", 0.0), (1, 10.0, 40.0, "MEDIUM", 0.0),
      (0, 90.0, 40.0, "LOW", 50.0), (1, float("nan"), 40.0, "MEDIUM", None), (None, 90.0, 40.0, "LOW", 50.0)]


def test_rules_micro_golden(spark):
    df = spark.createDataFrame([r[:3] for r in C2],
                               "predicted_stockout int, predicted_rop double, stock_on_hand double")
    out = rc.recommend(df).collect()
    assert [(r["priority"], r["recommended_order"]) for r in out] == [(r[3], r[4]) for r in C2]
    assert {r["insight"] for r in out} == set(rc.DEFAULT_INSIGHTS.values())
    s = rc.priority_summary(rc.recommend(df)).collect()[0].asDict()
    assert s == {"high": 1, "medium": 3, "low": 2, "total": 6}
    plan = rc.recommend(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_custom_texts(spark):
    df = spark.createDataFrame([(1, 50.0, 40.0)], "predicted_stockout int, predicted_rop double, stock_on_hand double")
    assert rc.recommend(df, texts={"HIGH": "order now"}).collect()[0]["insight"] == "order now"


def test_auc_equals_mllib(spark):
    data = [(float(i % 7) / 3.0, 1.0 if (i * 37) % 11 < 5 else 0.0) for i in range(400)]
    df = spark.createDataFrame(data, "score double, label double")
    ours = mt.auc(df, "label", "score").collect()[0]["auc"]
    ref = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score").evaluate(df)
    assert math.isclose(ours, ref, rel_tol=1e-12)
    # few buckets: ties across and inside buckets still exact
    assert math.isclose(mt.auc(df, "label", "score", buckets=2).collect()[0]["auc"], ref, rel_tol=1e-12)


def test_auc_hot_score(spark):
    data = [(0.5, float(i % 2)) for i in range(300)] + [(0.9, 1.0), (0.1, 0.0)]
    df = spark.createDataFrame(data, "score double, label double")
    ref = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score").evaluate(df)
    assert math.isclose(mt.auc(df, "label", "score").collect()[0]["auc"], ref, rel_tol=1e-12)


def test_regression_metrics_equal_mllib(spark):
    data = [(float(i), float(i) * 0.9 + (i % 5)) for i in range(100)]
    df = spark.createDataFrame(data, "y double, p double")
    ours = mt.regression_metrics(df, "y", "p").collect()[0]
    for m in ("mae", "rmse", "r2"):
        ref = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=m).evaluate(df)
        assert math.isclose(ours[m], ref, rel_tol=1e-9)


def test_split_is_layout_independent(spark):
    df = spark.range(1000).withColumnRenamed("id", "product_id")
    a, _ = md.split(df)
    b, _ = md.split(df.repartition(7).orderBy(F.rand(1)))
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert 750 < a.count() < 850
    with_null = spark.createDataFrame([(None,), (1,)], "product_id long")
    tr, te = md.split(with_null)
    assert tr.count() + te.count() == 2


def test_profile_equals_describe(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None), (5.0, 8.0)], "a double, b double")
    got = {r["feature"]: r for r in pf.profile(df, ["a", "b"]).collect()}
    d = {r["summary"]: r for r in df.describe("a", "b").collect()}
    for c in ("a", "b"):
        assert got[c]["count"] == int(d["count"][c])
        assert got[c]["mean"] == pytest.approx(float(d["mean"][c]))
        assert got[c]["stddev"] == pytest.approx(float(d["stddev"][c]))
        assert got[c]["min"] == float(d["min"][c]) and got[c]["max"] == float(d["max"][c])


def test_risk_summary_and_counts(spark):
    g = spark.createDataFrame([(1,), (1,), (0,)], "stockout_risk int")
    r = pf.risk_summary(g).collect()[0]
    assert (r["total"], r["at_risk"], r["safe"], r["pct_at_risk"]) == (3, 2, 1, 66.7)
    c = {r["table"]: r["rows"] for r in pf.row_counts(a=g, b=g.limit(1)).collect()}
    assert c == {"a": 3, "b": 1}
    s = pf.schema_table(g, counts=False).collect()
    assert [(r["column"], r["type"]) for r in s] == [("stockout_risk", "int")]
    s = pf.schema_table(g.union(spark.createDataFrame([(None,)], "stockout_risk int"))).collect()
    assert [(r["position"], r["column"], r["type"], r["non_nulls"]) for r in s] == [(1, "stockout_risk", "int", 3)]


def test_models_train_and_score(spark):
    from tests.conftest import SF_SMALL
    from shelfwise.plans.q_gold import _gold
    g = _gold(spark, SF_SMALL)
    train, test = md.split(g)
    risk = md.train_risk(train, num_trees=10)
    rop = md.train_reorder(train, num_trees=10)
    imp = md.importances(risk, spark).collect()
    assert [r["feature"] for r in imp] == list(md.FEATURES)
    assert math.isclose(sum(r["importance"] for r in imp), 1.0, rel_tol=1e-9)
    pred = risk.transform(md.fill_zero(test))
    ours = mt.auc(pred.select("stockout_risk", md.positive_probability().alias("p")), "stockout_risk", "p")
    assert math.isclose(ours.collect()[0]["auc"], md.evaluate_auc(pred), rel_tol=1e-9)
    sc = md.score(g, risk, rop)
    assert sc.count() == g.count()
    assert set(sc.columns) >= {"product_id", "stock_on_hand", "predicted_stockout", "predicted_rop"}
    # same data, same seed -> same model
    again = md.train_risk(train, num_trees=10)
    assert (again.stages[-1].featureImportances.toArray().tolist()
            == risk.stages[-1].featureImportances.toArray().tolist())


def test_count_le_binary_search(spark):
    bounds = [1.0, 2.0, 2.0, 5.0, 9.0]
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, 1.5, 2.0, 4.0, 5.0, 9.0, 10.0)], "x double")
    got = df.select(mt.count_le(F.array(*[F.lit(b) for b in bounds]), F.col("x"), len(bounds)).alias("c"))
    assert [r["c"] for r in got.collect()] == [sum(b <= x for b in bounds)
                                               for x in (0.5, 1.0, 1.5, 2.0, 4.0, 5.0, 9.0, 10.0)]


def test_auc_buckets_balanced_on_clustered_scores(spark):
    # 95% of the distinct scores sit in the lowest 0.1% of the range
    n = 20000
    df = (spark.range(n).select(
        F.when(F.col("id") % 20 == 0, F.col("id").cast("double"))
         .otherwise(F.col("id") / (n * 1000.0)).alias("score"),
        (F.col("id") % 3 == 0).cast("double").alias("label")))
    # numBins=0: MLlib's exact curve (its default down-samples to 1000 bins)
    ref = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(df)
    assert math.isclose(mt.auc(df, "label", "score", buckets=64).collect()[0]["auc"], ref, rel_tol=1e-12)
    probs = [i / 64 for i in range(1, 64)]
    bounds = df.agg(F.percentile_approx("score", probs, 10000).alias("q")).scalar()
    sizes = (df.withColumn("_q", bounds)
               .groupBy(mt.count_le(F.col("_q"), F.col("score"), 63).alias("b")).count().collect())
    assert max(r["count"] for r in sizes) < 3 * n / 64


def test_regression_metrics_constant_label(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    r = mt.regression_metrics(df, "y", "p").collect()[0]
    assert (r["mae"], r["r2"], r["n"]) == (0.5, None, 2) and math.isclose(r["rmse"], math.sqrt(0.5))
    empty = mt.regression_metrics(spark.createDataFrame([], "y double, p double"), "y", "p").collect()[0]
    assert (empty["mae"], empty["rmse"], empty["r2"], empty["n"]) == (None, None, None, 0)
