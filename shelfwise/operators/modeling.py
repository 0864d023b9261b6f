"""Random-forest models for both gold targets (M1-M10), with MLlib.

Training is MLlib's distributed tree induction; everything around it is
DataFrame code: feature selection, null filling, a layout-independent hash
split, scoring both models in one pass, and importances as a table.

Note on leakage (kept from the reference's feature list): stockout_risk is
a deterministic formula of the chosen features, and reorder_point of those
plus the reorder level, so very high scores are expected.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import qcol

# The candidate features and the two targets of the reference.
FEATURES = ("initial_stock_quantity", "stock_on_hand", "total_sales", "active_days",
            "daily_sales_velocity", "actual_lead_time", "avg_lead_time_days", "procurement_lead_time")
RISK_LABEL = "stockout_risk"
ROP_LABEL = "reorder_point"
NUM_TREES = 100
SEED = 42
TRAIN_PERCENT = 80
ROWS_PER_TASK = 20_000   # of forest induction and scoring: 100 trees make a row dear


def select_features(df: DataFrame, candidates=FEATURES) -> list[str]:
    """M1: the candidate features present in ``df``, in candidate order."""
    return [c for c in candidates if c in df.columns]


def fill_zero(df: DataFrame) -> DataFrame:
    """M2: nulls -> 0 in numeric columns (strings, timestamps untouched)."""
    return df.fillna(0)


def assembler(features: list[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output)


def assemble(df: DataFrame, features: list[str], output: str = "features") -> DataFrame:
    """M3: the features as one vector column."""
    return assembler(features, output).transform(df)


def split_bucket(key: str, buckets: int = 100) -> Column:
    """Stable bucket of a key: first 7 hex digits of md5(key as text) mod
    ``buckets``; a null key hashes as the empty text, so every row lands in
    exactly one side of a split."""
    text = F.coalesce(qcol(key).cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")
    return h % buckets


def split_label(key: str = "product_id", train_percent: int = TRAIN_PERCENT) -> Column:
    """'train' / 'test' by the hash bucket of ``key``."""
    return F.when(split_bucket(key) < train_percent, F.lit("train")).otherwise(F.lit("test"))


def split(df: DataFrame, key: str = "product_id", train_percent: int = TRAIN_PERCENT):
    """M4: (train, test) by a hash bucket of ``key``.

    Unlike ``randomSplit`` the result does not depend on the partitioning
    or on the row order, so re-runs and retried tasks give the same rows.
    """
    b = split_bucket(key)
    return df.filter(b < train_percent), df.filter(b >= train_percent)


def dealt(df: DataFrame, rows: int, key: str = "product_id") -> DataFrame:
    """``df`` in even parts by ``key``, of about ``ROWS_PER_TASK`` of its ``rows``, each in the order of the key.

    The work of a forest is in its trees, not in the bytes of its rows, so parts that are planned by size
    are too few for it (and parts of a fixed number each send all trees' statistics). Rows that make one part
    stay as they are."""
    parts = -(-rows // ROWS_PER_TASK)
    return df.repartition(parts, qcol(key)).sortWithinPartitions(qcol(key)) if parts > 1 else df


@contextmanager
def training_rows(train: DataFrame, key: str = "product_id") -> Iterator[tuple[DataFrame, int]]:
    """(``train`` kept for the passes of tree induction and dealt to tasks evenly, its number of rows)."""
    kept = [train.persist()]
    try:
        n = train.count()
        even = dealt(train, n, key)
        if even is not train:
            kept.append(even.persist())
            even.count()
            train.unpersist()
        yield even, n
    finally:
        for df in kept:
            df.unpersist()


def _pipeline(estimator, features: list[str]) -> Pipeline:
    return Pipeline(stages=[assembler(features), estimator])


def train_risk(train: DataFrame, features: list[str] | None = None, label: str = RISK_LABEL,
               num_trees: int = NUM_TREES, seed: int = SEED, **params) -> PipelineModel:
    """M5: random-forest classifier of the stock-out label (fill + assemble + forest)."""
    features = features or select_features(train)
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees,
                                seed=seed, **params)
    return _pipeline(rf, features).fit(fill_zero(train))


def train_reorder(train: DataFrame, features: list[str] | None = None, label: str = ROP_LABEL,
                  num_trees: int = NUM_TREES, seed: int = SEED, **params) -> PipelineModel:
    """M7: random-forest regressor of the reorder point."""
    from pyspark.ml.regression import RandomForestRegressor
    features = features or select_features(train)
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                               seed=seed, **params)
    return _pipeline(rf, features).fit(fill_zero(train))


def evaluate_auc(pred: DataFrame, label: str = RISK_LABEL, raw: str = "rawPrediction") -> float:
    """M6 with MLlib's evaluator (an action; see ``metrics.auc`` for the lazy form)."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw).evaluate(pred)


def evaluate_regression(pred: DataFrame, label: str = ROP_LABEL, prediction: str = "prediction") -> dict:
    """M8 with MLlib's evaluator: MAE and R²."""
    ev = RegressionEvaluator(labelCol=label, predictionCol=prediction)
    return {m: ev.setMetricName(m).evaluate(pred) for m in ("mae", "r2")}


def positive_probability(prob_col: str = "probability") -> Column:
    return vector_to_array(F.col(prob_col))[1]


def importances(model: PipelineModel, spark: SparkSession | None = None) -> DataFrame:
    """M9: (feature, importance) of the fitted forest, in feature order.

    A model attribute with one value per feature (not data), so it is built
    on the driver.
    """
    assembler_stage, forest = model.stages[0], model.stages[-1]
    names = assembler_stage.getInputCols()
    values = forest.featureImportances.toArray().tolist()
    spark = spark or SparkSession.getActiveSession()
    schema = T.StructType([T.StructField("position", T.IntegerType()),
                           T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame([(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values))], schema)


def score(gold: DataFrame, risk_model: PipelineModel, rop_model: PipelineModel,
          keep: tuple[str, ...] = ("product_id", "stock_on_hand")) -> DataFrame:
    """The missing link between models and recommendations.

    Both models score the same filled feature rows in one pass; the
    output carries predicted_stockout (0/1), its probability, predicted_rop
    and the columns in ``keep`` (stock_on_hand is needed by the rules).
    """
    filled = fill_zero(gold)
    p1 = risk_model.transform(filled)
    p1 = p1.select(*[qcol(c) for c in gold.columns],
                   F.col("prediction").cast("int").alias("predicted_stockout"),
                   positive_probability().alias("stockout_probability"))
    p2 = rop_model.transform(p1).withColumnRenamed("prediction", "predicted_rop")
    return p2.select(*[qcol(c) for c in keep], "predicted_stockout", "stockout_probability", "predicted_rop")
