"""Trained forests as relations.

``forest_nodes`` turns a fitted MLlib forest into a table with one row per
node, and ``walk_forest`` scores rows by following that table: every row
starts at the root of every tree, and a join by (tree, node) moves it one
level down until it is at a leaf. The table can be queried, stored beside the
scores it explains, or walked by any SQL engine.

The node table is as large as the model (trees times two to the depth), whatever
the data, so it may be sent to the tasks: ``MAX_BROADCAST`` nodes at most, above
that it is joined by shuffles. A row is a row for each tree on its way down;
the votes are added up on the map side first. To score very many rows the
model's own ``transform`` is faster; both give the same scores.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import qcol
from shelfwise.session import scratch_dir

MAX_BROADCAST = 200_000
LEAF = -1


def forest_nodes(model: PipelineModel, spark: SparkSession | None = None) -> DataFrame:
    """(``tree``, ``node``, ``feature``, ``threshold``, ``left``, ``right``, ``value``, ``classes``): a row with
    ``feature`` at most ``threshold`` goes left. Leaves have children -1, ``value`` (the mean of a
    regression) and ``classes`` (training weight of each class; of a regression, MLlib's sums).

    The nodes are those that MLlib writes for the model, which is how they leave the driver."""
    spark = spark or SparkSession.getActiveSession()
    assembler, forest = model.stages[0], model.stages[-1]
    path = scratch_dir(spark, "forest")
    forest.write().save(path)
    names = F.array(*[F.lit(n) for n in assembler.getInputCols()])
    n = F.col("nodeData")
    inner = n["leftChild"] != LEAF
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"),
        F.when(inner, F.element_at(names, n["split"]["featureIndex"] + 1)).alias("feature"),
        F.when(inner, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("value"),
        n["impurityStats"].alias("classes"))


def walk_forest(df: DataFrame, nodes: DataFrame, key: str, features: list[str]) -> DataFrame:
    """(``key``, ``mean``, ``votes``): the mean of the leaves' values over all trees, and for each class the
    mean of its share in the leaves. ``key`` names rows; the features are read with nulls as 0."""
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("tree").alias("trees")).first()
    small = size["n"] <= MAX_BROADCAST
    table = nodes.select("tree", F.col("node").alias("_node"), "feature", "threshold", "left", "right", "value", "classes")
    table = F.broadcast(table) if small else table
    values = F.map_from_arrays(F.array(*[F.lit(f) for f in features]),
                               F.array(*[F.coalesce(qcol(f).cast("double"), F.lit(0.0)) for f in features]))
    at = df.select(qcol(key).alias("_key"), values.alias("x"),
                   F.explode(F.sequence(F.lit(0), F.lit(size["trees"] - 1))).alias("tree"), F.lit(0).alias("_node"))
    for _ in range(_depth(nodes)):
        down = F.when(F.col("left") == LEAF, F.col("_node")).when(
            F.col("x")[F.col("feature")] <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(table, ["tree", "_node"]).select("_key", "x", "tree", down.alias("_node"))
    leaves = at.join(table, ["tree", "_node"])
    total = F.aggregate("classes", F.lit(0.0), lambda a, c: a + c)
    shares = leaves.select("_key", "value", F.posexplode(F.transform("classes", lambda c: c / total)).alias("class", "share"))
    votes = shares.groupBy("_key", "class").agg((F.sum("share") / size["trees"]).alias("share"),
                                                (F.sum("value") / size["trees"]).alias("mean"))
    return votes.groupBy("_key").agg(
        F.min("mean").alias("mean"),
        F.transform(F.sort_array(F.collect_list(F.struct("class", "share"))), lambda v: v["share"]).alias("votes")
    ).withColumnRenamed("_key", key)


def score_by_nodes(gold: DataFrame, risk_nodes: DataFrame, rop_nodes: DataFrame, features: list[str],
                   key: str = "product_id", keep: tuple[str, ...] = ("stock_on_hand",)) -> DataFrame:
    """What ``modeling.score`` gives, from the node tables of both forests. ``key`` is unique."""
    risk = walk_forest(gold, risk_nodes, key, features).select(
        qcol(key).alias("_risk_key"), (F.col("votes")[1] > F.col("votes")[0]).cast("int").alias("predicted_stockout"),
        F.col("votes")[1].alias("stockout_probability"))
    rop = walk_forest(gold, rop_nodes, key, features).select(qcol(key).alias("_rop_key"), F.col("mean").alias("predicted_rop"))
    out = gold.join(risk, qcol(key).eqNullSafe(F.col("_risk_key"))).join(rop, qcol(key).eqNullSafe(F.col("_rop_key")))
    return out.select(key, *[qcol(c) for c in keep], "predicted_stockout", "stockout_probability", "predicted_rop")


def _depth(nodes: DataFrame) -> int:
    """Steps from a root to the deepest leaf, by going down the table level by level."""
    steps = 0
    level = nodes.where("node = 0").select("tree", "left", "right")
    while True:
        level = level.select("tree", F.explode(F.array("left", "right")).alias("node")).where(F.col("node") != LEAF)
        if level.isEmpty():
            return steps
        steps += 1
        level = level.join(nodes, ["tree", "node"]).select("tree", "left", "right")


# The same walk for an engine that knows no Spark: {nodes}, {rows} and {key} are put in,
# {features} as ``'name': value`` pairs.
WALK_SQL = """
WITH RECURSIVE at_node AS (
  SELECT r.{key} AS key, map {{{features}}} AS x, t.tree, 0 AS node
  FROM {rows} r, (SELECT DISTINCT tree FROM {nodes}) t
  UNION ALL
  SELECT a.key, a.x, a.tree, CASE WHEN a.x[n.feature] <= n.threshold THEN n."left" ELSE n."right" END
  FROM at_node a JOIN {nodes} n ON n.tree = a.tree AND n.node = a.node WHERE n."left" <> -1),
leaves AS (SELECT a.key, n.value, n.classes FROM at_node a JOIN {nodes} n ON n.tree = a.tree AND n.node = a.node
  WHERE n."left" = -1)
SELECT key AS {key}, avg(value) AS mean, avg(classes[2] / list_sum(classes)) AS share_of_1 FROM leaves GROUP BY key"""
