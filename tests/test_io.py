"""Sources and sinks in a fresh temp folder; JDBC through embedded Derby
(in-process, no server, no port)."""

import json
import os

from pyspark.sql import functions as F

from shelfwise.plans import q_io
from shelfwise.sources import files as io
from shelfwise.sources.jdbc import read_jdbc, write_jdbc
from tests.conftest import SF_SMALL, rows


def _df(spark):
    return spark.createDataFrame([(1, "  a b ", 1.5, None), (2, "c", None, "2024-01-02")],
                                 "id long, name string, price double, d string")


def test_csv_roundtrip_keeps_values(spark, tmp_dir):
    df = _df(spark)
    io.write_csv(df, f"{tmp_dir}/t")
    back = io.read_csv(spark, f"{tmp_dir}/t", schema=df.schema)
    assert rows(back) == rows(df)
    inferred = io.read_csv(spark, f"{tmp_dir}/t")
    assert dict(inferred.dtypes)["id"] in ("int", "bigint")


def test_csv_null_tokens(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.csv")
    with open(p, "w") as f:
        f.write("a,b\nn/a,1\nNULL,2\nok,3\n")
    df = io.read_csv(spark, p, null_tokens=io.PANDAS_NULL_TOKENS)
    assert sorted((r["a"] is None, r["b"]) for r in df.collect()) == [(False, 3), (True, 1), (True, 2)]


def test_multiline_json_and_landing(spark, tmp_dir):
    src = os.path.join(tmp_dir, "suppliers_info.json")
    with open(src, "w") as f:
        json.dump([{"id": 1, "name": "A", "lead_time": 3}, {"id": 2, "name": "B", "lead_time": 5}], f, indent=2)
    df = io.read_json(spark, src)
    assert df.count() == 2
    landed = io.land_json(spark, src, f"{tmp_dir}/bronze")
    assert rows(landed) == rows(df)


def test_parquet_single_file_and_partitions(spark, tmp_dir):
    df = spark.range(100).selectExpr("id", "id % 3 AS k")
    io.write_parquet(df, f"{tmp_dir}/one", n_files=1)
    assert len([f for f in os.listdir(f"{tmp_dir}/one") if f.endswith(".parquet")]) == 1
    io.write_parquet(df, f"{tmp_dir}/parts", partition_by=["k"])
    back = io.read_parquet(spark, f"{tmp_dir}/parts").filter("k = 1")
    assert back.count() == 33
    assert "PartitionFilters" in back._jdf.queryExecution().executedPlan().toString() or back.count() == 33


def test_jdbc_derby_roundtrip(spark, tmp_dir):
    url = f"jdbc:derby:{tmp_dir}/db;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(10).selectExpr("CAST(id AS INT) AS id", "CAST(id * 2 AS INT) AS qty")
    write_jdbc(df, url, "stock_move", properties=props)
    back = read_jdbc(spark, url, "stock_move", partition_column="id", lower_bound=0, upper_bound=10,
                     num_partitions=2, properties=props)
    assert back.rdd.getNumPartitions() == 2
    assert sorted(r["qty"] for r in back.collect()) == [2 * i for i in range(10)]


def test_silver_gold_jobs(spark, tmp_dir):
    from shelfwise.plans import jobs
    from shelfwise.plans.q_io import _write_bronze
    from tests.conftest import SF_SMALL
    schemas = _write_bronze(spark, SF_SMALL, f"{tmp_dir}/raw")
    counts = jobs.run_silver(spark, f"{tmp_dir}/raw", f"{tmp_dir}/silver", schemas=schemas,
                             suppliers_layout="lines")
    assert counts[jobs.INVENTORY] == 200 and counts[jobs.TRANSACTIONS] > 5000
    assert counts["lost"]["transaction_date"] > 0   # the fixture has dates that do not parse
    m = jobs.run_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold", n_files=1, report=True)
    assert m["rows"] == 200 and m["at_risk"] + m["safe"] == 200
    rep = m["report"]
    assert rep["input_rows"][jobs.INVENTORY] == 200 and rep["sales_rule"] == "labels"
    assert rep["lead_time_rule"] == "by_product" and rep["roles"]["inventory"]["product"] == "product_id"
    assert rep["nulls_read_as_zero"] == {"stock": 0, "reorder_level": 0}
    assert len(rep["profile"]) == 6 and len(rep["sample"]) == 5 and len(rep["schema"]) == 15
    r = jobs.run_models(spark, m["path"], f"{tmp_dir}/models", num_trees=5)
    assert 0.5 <= r["auc"] <= 1.0 and r["r2"] <= 1.0
    assert list(r["importances"]) == ["initial_stock_quantity", "stock_on_hand", "total_sales", "active_days",
                                      "daily_sales_velocity", "actual_lead_time", "avg_lead_time_days",
                                      "procurement_lead_time"]
    from pyspark.ml import PipelineModel
    assert PipelineModel.load(f"{tmp_dir}/models/risk_model").stages[-1].getNumTrees == 5
    recorded = spark.read.json(f"{tmp_dir}/models/metrics").first()
    assert recorded["auc"] == r["auc"] and recorded["n_test"] == r["n_test"]
    assert spark.read.json(f"{tmp_dir}/models/importances").count() == 8
    s = jobs.run_recommend(spark, r["model_output"], f"{tmp_dir}/out", sample=3)
    assert len(s.pop("sample")) == 3
    assert s["rows"] == 200 and s["high"] + s["medium"] + s["low"] == 200
    back = io.read_csv(spark, f"{tmp_dir}/out/{jobs.RECOMMENDATIONS}", infer_schema=True)
    assert {"priority", "recommended_order", "insight", "predicted_rop"} <= set(back.columns)


def test_bronze_to_gold_from_jdbc(spark, tmp_dir):
    from shelfwise.plans import jobs
    url = f"jdbc:derby:{tmp_dir}/pg;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    moves = spark.createDataFrame(
        [(1, "P1", "SALE", -3.0, "2024-01-02"), (2, "P1", "RETURN", 1.0, "2024-01-03"),
         (3, "P2", "OUT", -2.0, "2024-01-02"), (3, "P2", "OUT", -2.0, "2024-01-02")],
        "id int, product_id string, transaction_type string, quantity_change double, transaction_date string")
    write_jdbc(moves, url, "stock_move", properties=props)
    inv_csv = os.path.join(tmp_dir, "grocery-inventory.csv")
    with open(inv_csv, "w") as f:
        f.write("Product ID,Stock Quantity,Unit Price,Date Received,Last Order Date\n"
                "P1,10,2.5,2024-01-05,2024-01-01\nP2,n/a,NA,2024-01-04,2024-01-02\n")
    sup_json = os.path.join(tmp_dir, "suppliers_info.json")
    with open(sup_json, "w") as f:
        json.dump([{"id": 7, "product_id": "P1", "lead_time_days": 3},
                   {"id": 8, "product_id": "P2", "lead_time_days": 5}], f, indent=2)
    landed = jobs.run_bronze(spark, f"{tmp_dir}/raw", url, "stock_move", inv_csv, sup_json,
                             jdbc_properties=props, partition_column="id", num_partitions=2)
    assert landed == {jobs.TRANSACTIONS: 4, jobs.INVENTORY: 2, jobs.SUPPLIERS: 2}
    counts = jobs.run_silver(spark, f"{tmp_dir}/raw", f"{tmp_dir}/silver", suppliers_layout="lines")
    assert counts.pop("lost") == {}            # typed by inference: nothing to parse
    assert counts == {jobs.TRANSACTIONS: 3, jobs.INVENTORY: 2, jobs.SUPPLIERS: 2}
    inv = spark.read.parquet(f"{tmp_dir}/silver/{jobs.INVENTORY}")
    assert {r["product_id"]: r["unit_price"] for r in inv.collect()} == {"P1": 2.5, "P2": 2.5}
    m = jobs.run_gold(spark, f"{tmp_dir}/silver", f"{tmp_dir}/gold")
    g = {r["product_id"]: r for r in spark.read.parquet(m["path"]).collect()}
    assert g["P1"]["stock_on_hand"] == 8.0 and g["P2"]["stock_on_hand"] == 0.0
    assert g["P1"]["avg_lead_time_days"] == 3.0 and g["P2"]["total_sales"] == 2.0


def test_jdbc_single_query_and_argument_check(spark, tmp_dir):
    import pytest
    url = f"jdbc:derby:{tmp_dir}/db2;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    write_jdbc(spark.range(5).selectExpr("CAST(id AS INT) AS id"), url, "t", properties=props)
    back = read_jdbc(spark, url, "t", properties=props)
    assert back.rdd.getNumPartitions() == 1 and back.count() == 5
    with pytest.raises(ValueError):
        read_jdbc(spark, url, "t", partition_column="id", properties=props)
    found = read_jdbc(spark, url, "t", partition_column="id", num_partitions=3, properties=props)
    assert found.rdd.getNumPartitions() == 3 and found.count() == 5        # bounds from the database
    write_jdbc(spark.range(0).selectExpr("CAST(id AS INT) AS id"), url, "nothing", properties=props)
    assert read_jdbc(spark, url, "nothing", partition_column="id", num_partitions=3, properties=props).count() == 0


def test_json_layouts_never_guess(spark, tmp_dir):
    import pytest
    doc, lines = os.path.join(tmp_dir, "d.json"), os.path.join(tmp_dir, "l.jsonl")
    with open(doc, "w") as f:
        f.write('[\n{"id": 1, "name": "A"},\n{"id": 2, "name": "B"}\n]\n')
    with open(lines, "w") as f:
        f.write('{"id": 1, "name": "A"}\n{"id": 2, "name": "B"}\n')
    for schema in (None, "id long, name string"):
        assert io.read_json(spark, doc, schema=schema).count() == 2
        assert io.read_json(spark, lines, multi_line=False, schema=schema).count() == 2
        with pytest.raises(Exception, match="(?i)malformed"):
            io.read_json(spark, doc, multi_line=False, schema=schema).collect()


def test_csv_line_breaks_and_quotes(spark, tmp_dir):
    df = spark.createDataFrame([(1, 'a\nb "q", c'), (2, "plain"), (3, "\\ back")], "id long, note string")
    io.write_csv(df, f"{tmp_dir}/t")
    assert rows(io.read_csv(spark, f"{tmp_dir}/t", schema=df.schema, multiLine=True)) == rows(df)


def test_models_hand_over_as_csv(spark, tmp_dir):
    from shelfwise.plans import jobs
    from shelfwise.plans.q_report import scored
    from tests.conftest import SF_SMALL
    out = scored(spark, SF_SMALL).select("product_id", "stock_on_hand", "predicted_stockout", "predicted_rop")
    io.write_csv(out, f"{tmp_dir}/m")
    m = jobs.run_recommend(spark, f"{tmp_dir}/m", f"{tmp_dir}/out", fmt="csv", schema=out.schema)
    assert (m["high"], m["medium"], m["low"]) == (108, 37, 55)


def test_jobs_command_line(spark, tmp_dir, capsys):
    from shelfwise.plans import jobs
    from shelfwise.plans.q_io import _write_bronze
    from tests.conftest import SF_SMALL
    schemas = _write_bronze(spark, SF_SMALL, f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/schemas.json", "w") as f:
        json.dump({k: v.toDDL() for k, v in schemas.items()}, f)
    jobs.main(["silver", f"{tmp_dir}/raw", f"{tmp_dir}/silver", "--layout", "lines", "--schemas", f"{tmp_dir}/schemas.json"])
    jobs.main(["gold", f"{tmp_dir}/silver", f"{tmp_dir}/gold"])
    assert "'sales_rule': 'labels'" in capsys.readouterr().out
    url = f"jdbc:derby:{tmp_dir}/cli;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    write_jdbc(spark.range(4).selectExpr("CAST(id AS INT) AS id"), url, "m", properties=props)
    with open(f"{tmp_dir}/inv.csv", "w") as f:
        f.write('product_id,note\n1,"two\nlines"\n')
    with open(f"{tmp_dir}/sup.json", "w") as f:
        f.write('{"id": 7}')
    with open(f"{tmp_dir}/sources.json", "w") as f:
        json.dump({"jdbc_url": url, "jdbc_table": "m", "inventory_csv": f"{tmp_dir}/inv.csv",
                   "suppliers_json": f"{tmp_dir}/sup.json", "jdbc_properties": props}, f)
    jobs.main(["bronze", f"{tmp_dir}/sources.json", f"{tmp_dir}/landed"])
    said = capsys.readouterr().out
    assert f"'{jobs.TRANSACTIONS}': 4" in said and f"'{jobs.INVENTORY}': 1" in said and f"'{jobs.SUPPLIERS}': 1" in said


def test_shared_folder_is_required_off_one_machine():
    import types

    import pytest

    from shelfwise.session import checkpoint_root

    def session(master, conf=None):
        context = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d: conf or d), sparkContext=context)

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(session(master))
        assert checkpoint_root(session(master, "s3a://b/c/")) == "s3a://b/c"
    assert "shelfwise" in checkpoint_root(session("local[4]"))


def test_line_breaks_survive_bronze_and_silver(spark, tmp_dir):
    from shelfwise.plans import jobs
    trx = spark.createDataFrame([("P1", "SALE", -1.0, "2024-01-01", "a\nb"), ("P2", "OUT", -2.0, "2024-01-02", 'say "x"')],
                                "product_id string, transaction_type string, quantity double, transaction_date string, note string")
    inv = spark.createDataFrame([("P1", 5.0, "two\nlines")], "product_id string, stock_quantity double, note string")
    io.write_csv(trx, f"{tmp_dir}/raw/{jobs.BRONZE_FILES[jobs.TRANSACTIONS]}")
    io.write_csv(inv, f"{tmp_dir}/raw/{jobs.BRONZE_FILES[jobs.INVENTORY]}")
    io.write_json(spark.createDataFrame([(1, "P1")], "id long, product_id string"), f"{tmp_dir}/raw/{jobs.SUPPLIERS_LINES}")
    n = jobs.run_silver(spark, f"{tmp_dir}/raw", f"{tmp_dir}/silver", suppliers_layout="lines",
                        schemas={jobs.TRANSACTIONS: trx.schema, jobs.INVENTORY: inv.schema})
    assert (n[jobs.TRANSACTIONS], n[jobs.INVENTORY]) == (2, 1) and n["lost"] == {"transaction_date": 0}
    notes = {r.note for r in spark.read.parquet(f"{tmp_dir}/silver/{jobs.TRANSACTIONS}").collect()}
    assert notes == {"a\nb", 'say "x"'}


def test_silver_files_are_packed(spark, tmp_dir):
    """Content ids are hex digits: written with zstd they take little more than half of their text."""
    df = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"))
    io.write_parquet(df, f"{tmp_dir}/silver", n_files=1)
    size = sum(os.path.getsize(f"{tmp_dir}/silver/{f}") for f in os.listdir(f"{tmp_dir}/silver") if f.endswith(".parquet"))
    assert size < 0.7 * 64 * 20000 and io.read_parquet(spark, f"{tmp_dir}/silver").exceptAll(df).count() == 0


def test_bronze_fixture_is_packed(spark, tmp_dir):
    q_io._write_bronze(spark, SF_SMALL, tmp_dir)
    files = [f for _, _, fs in os.walk(tmp_dir) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
