"""Modeling queries (M1-M10) and the metric formulas."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise.operators import bootstrap as bs
from shelfwise.operators import forest as fo
from shelfwise.operators import importance as im
from shelfwise.operators import metrics as mt
from shelfwise.operators import modeling as md
from shelfwise.operators import recommend as rc
from shelfwise.plans.catalog import register
from shelfwise.plans.q_gold import _gold
from shelfwise.plans.q_report import _gold_cte
from shelfwise.session import stored_rows

_FEATS = md.FEATURES
_FILLED_SQL = ", ".join(
    f"coalesce({c}, 0) AS {c}" for c in _FEATS)
_ASSEMBLED_SQL = ", ".join(
    f"CAST(coalesce({c}, 0) AS DOUBLE) AS x_{c}" for c in _FEATS)
_BUCKET_SQL = "(('0x' || substr(md5(coalesce(CAST(product_id AS VARCHAR), '')), 1, 7))::BIGINT % 100)"


@register("features_filled", _gold_cte() + f"SELECT product_id, {_FILLED_SQL} FROM gold")
def features_filled(spark, d):
    """M1/M2: the eight features, nulls as 0."""
    g = _gold(spark, d)
    return md.fill_zero(g.select("product_id", *md.select_features(g)))


@register("assembled", _gold_cte() + f"SELECT product_id, {_ASSEMBLED_SQL} FROM gold")
def assembled(spark, d):
    """M3: the assembled feature vector, shown as one column per slot."""
    g = _gold(spark, d)
    feats = md.select_features(g)
    v = md.assemble(md.fill_zero(g), feats).select("product_id", vector_to_array("features").alias("v"))
    return v.select("product_id", *[F.col("v")[i].alias(f"x_{c}") for i, c in enumerate(feats)])


@register("split_counts", _gold_cte() + f"""SELECT CASE WHEN {_BUCKET_SQL} < 80 THEN 'train' ELSE 'test' END AS part,
       count(*) AS "rows", CAST(sum(stockout_risk) AS BIGINT) AS at_risk FROM gold GROUP BY 1""")
def split_counts(spark, d):
    """M4: rows per side of the hash split (and positives per side)."""
    return (_gold(spark, d).groupBy(md.split_label().alias("part"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("stockout_risk").alias("at_risk")))


_SCORE = "coalesce(safety_stock, 0.0::DOUBLE) - stock_on_hand"


@register("auc", _gold_cte() + f""", s AS (SELECT CAST(stockout_risk AS DOUBLE) AS y, {_SCORE} AS sc FROM gold),
r AS (SELECT y, rank() OVER (ORDER BY sc) + (count(*) OVER (PARTITION BY sc) - 1) / 2.0 AS rk FROM s)
SELECT round((sum(CASE WHEN y = 1 THEN rk END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
             / (count_if(y = 1) * count_if(y <> 1)), 9) AS auc FROM r""")
def auc(spark, d):
    """M6: AUC of a deterministic score (safety stock minus stock) for the risk label."""
    g = _gold(spark, d).select("stockout_risk",
                               (F.coalesce(F.col("safety_stock"), F.lit(0.0)) - F.col("stock_on_hand"))
                               .alias("risk_score"))
    return mt.rounded(mt.auc(g, "stockout_risk", "risk_score"))


@register("regression_metrics", _gold_cte() + """, e AS (SELECT reorder_point AS y,
       reorder_point - historical_reorder_level AS err FROM gold WHERE historical_reorder_level IS NOT NULL)
SELECT round(avg(abs(err)), 9) AS mae, round(sqrt(sum(err * err) / count(*)), 9) AS rmse,
       round(1 - sum(err * err) / (var_pop(y) * count(*)), 9) AS r2, count(*) AS n FROM e""")
def regression_metrics(spark, d):
    """M8: MAE / RMSE / R² of the historical reorder level as a predictor of the reorder point."""
    return mt.rounded(mt.regression_metrics(_gold(spark, d), "reorder_point", "historical_reorder_level"))


# ------------------------------------------------------------ trained models

_MODELS: dict = {}


def _models(spark, d):
    """Both forests trained on the train split, and its number of rows, once for each
    application and input: several queries ask for the same ones."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _MODELS:
        train, _ = md.split(_gold(spark, d))
        with md.training_rows(train) as (rows, n):
            _MODELS[key] = (md.train_risk(rows), md.train_reorder(rows), n)
    return _MODELS[key]


@register("score_contract", _gold_cte() + """SELECT product_id, stock_on_hand, true AS label_ok, true AS probability_ok,
       true AS rop_ok FROM gold""")
def score_contract(spark, d):
    """Every product once, its stock as in gold, a 0/1 label that goes with its
    probability, and a reorder point."""
    p, x = F.col("stockout_probability"), F.col("predicted_stockout")
    return score(spark, d).select(
        "product_id", "stock_on_hand",
        F.coalesce(x.isin(0, 1) & ((x == 1) == (p > 0.5)) | (p == 0.5), F.lit(False)).alias("label_ok"),
        F.coalesce(p.between(0, 1), F.lit(False)).alias("probability_ok"),
        F.coalesce(~F.isnan("predicted_rop") & (F.col("predicted_rop") >= 0), F.lit(False)).alias("rop_ok"))


@register("importances_contract", """SELECT * FROM (VALUES (0, 'initial_stock_quantity'), (1, 'stock_on_hand'),
  (2, 'total_sales'), (3, 'active_days'), (4, 'daily_sales_velocity'), (5, 'actual_lead_time'), (6, 'avg_lead_time_days'),
  (7, 'procurement_lead_time')) t(position, feature), (SELECT 1.0::DOUBLE AS total, true AS none_negative)""")
def importances_contract(spark, d):
    """M5/M9: the eight features in order, importances that add up to 1."""
    i = train_risk(spark, d)
    total = i.agg(F.round(F.sum("importance"), 6).alias("total"), (F.min("importance") >= 0).alias("none_negative")).first()
    return i.select("position", "feature", F.lit(total["total"]).alias("total"),
                    F.lit(total["none_negative"]).alias("none_negative"))


@register("evaluate_contract", _gold_cte() + f"""SELECT count(*) AS n, 0.0::DOUBLE AS auc_gap, 0.0::DOUBLE AS mae_gap,
       0.0::DOUBLE AS r2_gap FROM gold WHERE {_BUCKET_SQL} >= 80""")
def evaluate_contract(spark, d):
    """M6-M8 on the forests' own predictions: our metrics less MLlib's, over the test rows."""
    risk, rop, n = _models(spark, d)
    filled = md.fill_zero(md.dealt(md.split(_gold(spark, d))[1], n))
    p1 = risk.transform(filled).select(*filled.columns, md.positive_probability().alias("p"))
    # Predicted once: five measures read these columns.
    p2 = stored_rows(rop.transform(p1).select("stockout_risk", "p", "reorder_point", "prediction"), "predictions")
    ours = mt.auc(p2.select("stockout_risk", "p"), "stockout_risk", "p").first()["auc"]
    theirs = BinaryClassificationEvaluator(labelCol="stockout_risk", rawPredictionCol="p", numBins=0).evaluate(p2)
    ml = md.evaluate_regression(p2)
    reg = mt.regression_metrics(p2, "reorder_point", "prediction")
    return reg.select("n", F.lit(abs(round(ours - theirs, 6))).alias("auc_gap"),
                      F.abs(F.round(F.col("mae") - ml["mae"], 6)).alias("mae_gap"),
                      F.abs(F.round(F.col("r2") - ml["r2"], 6)).alias("r2_gap"))


@register("train_risk")
def train_risk(spark, d):
    """M5/M9: classifier importances (feature order, summing to 1)."""
    risk, _, _ = _models(spark, d)
    return md.importances(risk, spark)


@register("evaluate_risk")
def evaluate_risk(spark, d):
    """M6 on the forest: AUC of the positive-class probability on the test split."""
    risk, _, n = _models(spark, d)
    _, test = md.split(_gold(spark, d))
    pred = risk.transform(md.fill_zero(md.dealt(test, n))).select(
        "stockout_risk", md.positive_probability().alias("p"))
    return mt.rounded(mt.auc(pred, "stockout_risk", "p"))


@register("train_reorder")
def train_reorder(spark, d):
    """M7/M8: regressor MAE / RMSE / R² on the test split."""
    _, rop, n = _models(spark, d)
    _, test = md.split(_gold(spark, d))
    return mt.rounded(mt.regression_metrics(rop.transform(md.fill_zero(md.dealt(test, n))), "reorder_point", "prediction"))


@register("score")
def score(spark, d):
    """Every gold product scored by both forests."""
    risk, rop, n = _models(spark, d)
    return md.score(md.dealt(_gold(spark, d), n), risk, rop)


@register("model_recommend")
def model_recommend(spark, d):
    """M10 -> R6: recommendations from the forests' predictions."""
    risk, rop, n = _models(spark, d)
    return rc.recommend(md.score(md.dealt(_gold(spark, d), n), risk, rop))


# Two trees, as a node table: tree, node, feature, threshold, left, right, value, weights of both classes.
_TWO_TREES = [
    (0, 0, "order_days", 9.0, 1, 2, None, None), (0, 1, None, None, -1, -1, 40.0, [1.0, 3.0]),
    (0, 2, "stock_on_hand", 250.0, 3, 4, None, None), (0, 3, None, None, -1, -1, 25.0, [1.0, 1.0]),
    (0, 4, None, None, -1, -1, 5.0, [9.0, 1.0]),
    (1, 0, "daily_sales_velocity", 26.0, 1, 2, None, None), (1, 1, None, None, -1, -1, 10.0, [4.0, 1.0]),
    (1, 2, None, None, -1, -1, 60.0, [0.0, 2.0])]


@register("forest_walk", _gold_cte() + """SELECT product_id,
  (CASE WHEN coalesce(order_buffer_index, 0) <= 9 THEN 40 WHEN stock_on_hand <= 250 THEN 25 ELSE 5 END
   + CASE WHEN daily_sales_velocity <= 26 THEN 10 ELSE 60 END) / 2.0::DOUBLE AS mean,
  (CASE WHEN coalesce(order_buffer_index, 0) <= 9 THEN 0.75 WHEN stock_on_hand <= 250 THEN 0.5 ELSE 0.1 END::DOUBLE
   + CASE WHEN daily_sales_velocity <= 26 THEN 0.2 ELSE 1 END::DOUBLE) / 2 AS share_of_1 FROM gold""")
def forest_walk(spark, d):
    """M10 by iterated joins with a node table, over the whole gold table."""
    nodes = spark.createDataFrame(_TWO_TREES, "tree int, node int, feature string, threshold double, left int, right int, "
                                              "value double, classes array<double>")
    g = _gold(spark, d).withColumnRenamed("order_buffer_index", "order_days")
    out = fo.walk_forest(g, nodes, "product_id", ["order_days", "stock_on_hand", "daily_sales_velocity"])
    return out.select("product_id", "mean", F.col("votes")[1].alias("share_of_1"))


_PERMUTED = ("daily_sales_velocity", "procurement_lead_time", "active_days", "stock_on_hand")
_TAKEN_SQL = ",\n  ".join(
    f"""CASE WHEN lead(product_id) OVER w_{f} IS NULL THEN first_value({f}) OVER w_{f} ELSE lead({f}) OVER w_{f} END AS p_{f}"""
    for f in _PERMUTED)
_WINDOWS_SQL = ",\n  ".join(f"w_{f} AS (PARTITION BY bucket ORDER BY md5('42|{f}|' || product_id))" for f in _PERMUTED)


def _loss_sql(permuted: str | None) -> str:
    take = lambda f: f"p_{f}" if f == permuted else f"coalesce({f}, 0)"
    return (f"avg(power(reorder_point - (2 * {take('daily_sales_velocity')} * {take('procurement_lead_time')}"
            f" + {take('active_days')} / 100.0::DOUBLE - {take('stock_on_hand')} / 1000.0::DOUBLE), 2))")


@register("permutation_importance", _gold_cte() + f""", f AS (SELECT product_id, reorder_point,
  {", ".join(f"CAST(coalesce({f}, 0) AS DOUBLE) AS {f}" for f in _PERMUTED)},
  ('0x' || substr(md5(product_id::VARCHAR), 1, 7))::BIGINT % 16 AS bucket FROM gold),
p AS (SELECT *, {_TAKEN_SQL} FROM f WINDOW {_WINDOWS_SQL}),
l AS (SELECT {_loss_sql(None)} AS base, {", ".join(f"{_loss_sql(f)} AS l_{f}" for f in _PERMUTED)} FROM p)
""" + "\nUNION ALL ".join(f"SELECT '{f}' AS feature, round(l_{f}, 4) AS loss, round(l_{f} - base, 4) AS increase FROM l"
                          for f in _PERMUTED))
def permutation_importance(spark, d):
    """M9 for any scorer: what a formula of four features loses when one of them is dealt to other products."""
    g = md.fill_zero(_gold(spark, d).select("product_id", "reorder_point", *[F.col(f).cast("double").alias(f) for f in _PERMUTED]))
    formula = (2 * F.col("daily_sales_velocity") * F.col("procurement_lead_time") + F.col("active_days") / 100.0
               - F.col("stock_on_hand") / 1000.0)
    out = im.permutation_importance(g, lambda df: df.withColumn("prediction", formula), list(_PERMUTED), "reorder_point",
                                    "product_id", buckets=16)
    return out.select("feature", F.round("loss", 4).alias("loss"), F.round("increase", 4).alias("increase"))


_BOOTSTRAP_SQL = """, x AS (SELECT product_id, reorder_point AS y, historical_reorder_level AS p, stockout_risk AS one,
    coalesce(safety_stock, 0.0::DOUBLE) - stock_on_hand AS sc FROM gold),
cdf AS (SELECT k, sum(exp(-1 - lgamma(k + 1))) OVER (ORDER BY k) AS c FROM range(25) t(k)),
u AS (SELECT x.*, b, ('0x' || substr(md5('42|' || b || '|' || product_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM x, range(41) r(b)),
w AS (SELECT u.* EXCLUDE (u), CASE WHEN b = 0 THEN 1 ELSE (SELECT count(*) FROM cdf WHERE c <= u.u) END AS w FROM u),
reg AS (SELECT b, sum(w * abs(y - p)) / sum(w) AS mae, sqrt(sum(w * (y - p) * (y - p)) / sum(w)) AS rmse,
    1 - sum(w * (y - p) * (y - p)) / (sum(w * y * y) - sum(w * y) * sum(w * y) / sum(w)) AS r2
  FROM w WHERE y - p IS NOT NULL GROUP BY b),
sc AS (SELECT b, sc, sum(w * one) AS pos, sum(w * (1 - one)) AS neg FROM w GROUP BY b, sc),
run AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY b ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS before FROM sc),
auc AS (SELECT b, sum(pos * (before + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg))::DOUBLE AS auc FROM run GROUP BY b),
m AS (SELECT 'mae' AS metric, b, mae AS x FROM reg UNION ALL SELECT 'rmse', b, rmse FROM reg
  UNION ALL SELECT 'r2', b, r2 FROM reg UNION ALL SELECT 'auc', b, auc FROM auc)
SELECT metric, round(max(x) FILTER (b = 0), 6) AS estimate, round(quantile_cont(x, 0.025) FILTER (b > 0), 6) AS "lower",
  round(quantile_cont(x, 0.975) FILTER (b > 0), 6) AS "upper" FROM m GROUP BY metric"""


@register("metric_intervals", _gold_cte() + _BOOTSTRAP_SQL)
def metric_intervals(spark, d):
    """M6/M8: 95 % intervals of AUC, MAE, RMSE and R² by 40 Poisson bootstrap replicates over the gold table."""
    g = _gold(spark, d).withColumn("score", F.coalesce("safety_stock", F.lit(0.0)) - F.col("stock_on_hand"))
    g = stored_rows(g.select("product_id", "reorder_point", "historical_reorder_level", "stockout_risk", "score"), "bootstrap")
    reg = bs.regression_by_replicate(g, "reorder_point", "historical_reorder_level", "product_id", 40)
    auc_ = bs.auc_by_replicate(g, "stockout_risk", "score", "product_id", 40, buckets=64)
    out = bs.intervals(reg).unionByName(bs.intervals(auc_))
    return out.select("metric", *[F.round(c, 6).alias(c) for c in ("estimate", "lower", "upper")])
