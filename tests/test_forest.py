"""Forests as node tables: walked by joins and by SQL, they give MLlib's own scores."""

import duckdb
import pytest

from shelfwise.operators import forest as fo
from shelfwise.operators import modeling as md
from shelfwise.plans.q_gold import _gold

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def trained(spark):
    gold = _gold(spark, SF_SMALL).persist()
    train = md.split(gold)[0]
    risk, rop = md.train_risk(train, num_trees=12), md.train_reorder(train, num_trees=12)
    return gold, risk, rop, fo.forest_nodes(risk, spark).persist(), fo.forest_nodes(rop, spark).persist()


def close(a, b):
    return a == b or a is not None and b is not None and abs(a - b) < 1e-9 * max(1.0, abs(a))


def test_nodes_give_the_models_scores(spark, trained):
    gold, risk, rop, risk_nodes, rop_nodes = trained
    want = {r["product_id"]: r for r in md.score(gold, risk, rop).collect()}
    got = {r["product_id"]: r for r in fo.score_by_nodes(gold, risk_nodes, rop_nodes, md.select_features(gold)).collect()}
    assert want.keys() == got.keys() and len(got) > 100
    for p, w in want.items():
        assert got[p]["predicted_stockout"] == w["predicted_stockout"]
        assert close(got[p]["stockout_probability"], w["stockout_probability"])
        assert close(got[p]["predicted_rop"], w["predicted_rop"])


def test_another_engine_walks_the_same_nodes(spark, trained):
    gold, risk, rop, risk_nodes, rop_nodes = trained
    features = md.select_features(gold)
    want = {r["product_id"]: r for r in md.score(gold, risk, rop).collect()}
    con = duckdb.connect()
    con.register("gold_rows", gold.select("product_id", *features).toPandas())
    pairs = ", ".join(f"'{f}': coalesce(r.{f}, 0)::DOUBLE" for f in features)
    for name, nodes in (("risk", risk_nodes), ("rop", rop_nodes)):
        con.register(f"{name}_nodes", nodes.toArrow())
        rows = con.execute(fo.WALK_SQL.format(nodes=f"{name}_nodes", rows="gold_rows", key="product_id",
                                              features=pairs)).fetchall()
        assert len(rows) == len(want)
        for key, mean, share in rows:
            if name == "risk":
                assert close(share, want[key]["stockout_probability"])
            else:
                assert close(mean, want[key]["predicted_rop"])


def test_the_table_is_the_forest(trained):
    _, risk, _, nodes, _ = trained
    forest = risk.stages[-1]
    rows = nodes.collect()
    assert len(rows) == forest.totalNumNodes and len({r["tree"] for r in rows}) == forest.getNumTrees
    names = {r["feature"] for r in rows if r["left"] != fo.LEAF}
    assert names <= set(md.FEATURES)
    used = {n for n, v in zip(risk.stages[0].getInputCols(), forest.featureImportances.toArray()) if v > 0}
    assert names == used
    ids = {(r["tree"], r["node"]) for r in rows}
    assert all((r["tree"], c) in ids for r in rows if r["left"] != fo.LEAF for c in (r["left"], r["right"]))
    assert fo._depth(nodes) == max(t.depth for t in forest.trees)


def test_large_models_are_joined_by_shuffles_and_nulls_read_as_zero(spark, trained, monkeypatch):
    gold, risk, rop, risk_nodes, rop_nodes = trained
    features = md.select_features(gold)
    rows = spark.createDataFrame([(None, None), (1, 5.0)], "product_id long, stock_on_hand double")
    for f in features:
        if f != "stock_on_hand":
            rows = rows.selectExpr("*", f"cast(null as double) AS {f}")
    plain = {r["product_id"]: r for r in fo.score_by_nodes(rows, risk_nodes, rop_nodes, features).collect()}
    monkeypatch.setattr(fo, "MAX_BROADCAST", 0)
    again = {r["product_id"]: r for r in fo.score_by_nodes(rows, risk_nodes, rop_nodes, features).collect()}
    want = {r["product_id"]: r for r in md.score(rows, risk, rop).collect()}
    for p in (None, 1):                       # the models fill a null key with 0, too
        assert close(plain[p]["predicted_rop"], want[p or 0]["predicted_rop"]) and close(again[p]["predicted_rop"], plain[p]["predicted_rop"])
        assert close(plain[p]["stockout_probability"], want[p or 0]["stockout_probability"])
    assert fo.walk_forest(rows.limit(0), risk_nodes, "product_id", features).collect() == []
