"""End-to-end jobs: sources -> bronze -> silver -> gold -> models -> recommendations.

Each job reads its inputs, composes the lazy operators and runs exactly one
write per output; the gold table is built once, not once per report. Row
counts and class balance are read back from the written files (only the
columns they need), never by recomputing the lineage; the bronze job counts
rows while it writes them.

    python -m shelfwise.plans.jobs bronze  SOURCES.json BRONZE_DIR
    python -m shelfwise.plans.jobs silver  BRONZE_DIR SILVER_DIR [--layout lines] [--schemas FILE.json]
    python -m shelfwise.plans.jobs gold    SILVER_DIR GOLD_DIR
    python -m shelfwise.plans.jobs models  GOLD_DIR   MODEL_DIR [--format csv]
    python -m shelfwise.plans.jobs recommend MODEL_OUTPUT OUT_DIR [--format csv]

SOURCES.json holds the keyword arguments of ``run_bronze``; a schemas file maps
table names to DDL strings.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import is_sale, qcol, safe_double
from shelfwise.functions.naming import (
    normalize_columns,
    resolve_inventory_roles,
    resolve_supplier_roles,
    resolve_transaction_roles,
)
from shelfwise.operators import cleaning as cl
from shelfwise.operators import features as fe
from shelfwise.operators import metrics as mt
from shelfwise.operators import modeling as md
from shelfwise.operators import profiling as pf
from shelfwise.operators import recommend as rc
from shelfwise.sources import files as io
from shelfwise.sources.jdbc import read_jdbc

# Table names of the zones.
TRANSACTIONS, INVENTORY, SUPPLIERS = "stock_transactions", "grocery_inventory", "suppliers"
BRONZE_FILES = {TRANSACTIONS: "stock_transactions.csv", INVENTORY: "grocery-inventory.csv",
                SUPPLIERS: "suppliers_info.json"}
# Suppliers in bronze: a document as its source wrote it, or JSON lines as
# run_bronze lands them. The names differ, so a reader need not guess.
SUPPLIERS_LINES = "suppliers_info.jsonl"
GOLD_TABLE = "gold_features"
REJECTS_TABLE = "stock_transactions_rejects"
MODEL_OUTPUT = "model_output"
RECOMMENDATIONS = "business_recommendations"


def _write_and_measure(df: DataFrame, write, read_back, *metrics) -> dict:
    """Write once, then aggregate the metrics over the written output."""
    write(df)
    return read_back().agg(F.count(F.lit(1)).alias("rows"), *metrics).first().asDict()


def _write_and_count(df: DataFrame, write) -> int:
    """Write once and count the rows on their way (no second read of the output)."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _counting_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` with its settings, for ``Observation``: in Spark
    4.1 a session that has used one can't serialize MLlib forests any more."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def run_bronze(spark: SparkSession, bronze_dir: str, jdbc_url: str, jdbc_table: str,
               inventory_csv: str, suppliers_json: str, jdbc_properties: dict | None = None,
               partition_column: str | None = None, bounds: tuple | None = None,
               num_partitions: int | None = None, pandas_nulls: bool = True,
               schemas: dict | None = None, multi_line_csv: bool = True) -> dict:
    """Land the three sources in the bronze zone.

    The movements table is read over JDBC in ``num_partitions`` parallel
    ranges of ``partition_column`` (with bounds that the database finds,
    unless given; a single query without a column) and written as CSV; the
    inventory CSV is re-written (pandas' missing-value markers become empty
    fields when ``pandas_nulls``, as the reference's pandas round trip did;
    quoted line breaks stay, unless ``multi_line_csv`` is off, which splits large
    files over tasks); the supplier JSON document is parsed and written
    as JSON lines. ``schemas`` skips inference. Returns the rows landed per
    table, counted while they are written.
    """
    spark = _counting_session(spark)
    b = bronze_dir.rstrip("/")
    schemas = schemas or {}
    lo, hi = bounds if bounds else (None, None)
    trx = read_jdbc(spark, jdbc_url, jdbc_table, partition_column, lo, hi, num_partitions,
                    properties=jdbc_properties)
    tokens = io.PANDAS_NULL_TOKENS if pandas_nulls else None
    inv = io.read_csv(spark, inventory_csv, schema=schemas.get(INVENTORY), null_tokens=tokens, multiLine=multi_line_csv)
    sup = io.read_json(spark, suppliers_json, schema=schemas.get(SUPPLIERS))
    return {
        TRANSACTIONS: _write_and_count(trx, lambda d: io.write_csv(d, f"{b}/{BRONZE_FILES[TRANSACTIONS]}")),
        INVENTORY: _write_and_count(inv, lambda d: io.write_csv(d, f"{b}/{BRONZE_FILES[INVENTORY]}")),
        SUPPLIERS: _write_and_count(sup, lambda d: io.write_json(d, f"{b}/{SUPPLIERS_LINES}")),
    }


def run_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, schemas: dict | None = None,
               null_tokens=None, id_method: str = "hash", suppliers_layout: str = "document",
               n_files: int | None = None, multi_line_csv: bool = True, keep_rejects: bool = False) -> dict:
    """Read the three bronze files, clean them, write Parquet to silver.

    ``schemas`` (name -> StructType/DDL) skips inference, which otherwise
    reads each file once more in full. ``suppliers_layout`` names the supplier
    file: ``"document"`` (``suppliers_info.json``, as its source wrote it) or
    ``"lines"`` (``suppliers_info.jsonl``, as ``run_bronze`` lands it). Returns
    rows written per table, and under ``lost`` how many non-empty texts of
    each parsed column did not parse, both counted on their way in the one pass
    that writes. With ``keep_rejects`` the movements keep these texts in a column
    of their own, and the quarantine table (``rejects``) is made from it.
    ``multi_line_csv`` keeps quoted line breaks, as ``run_bronze`` lands them;
    each file is then one task's work, so turn it off for a few huge files
    without such text.
    """
    spark = _counting_session(spark)
    schemas = schemas or {}
    b, s = bronze_dir.rstrip("/"), silver_dir.rstrip("/")
    if suppliers_layout not in ("document", "lines"):
        raise ValueError("suppliers_layout must be 'document' or 'lines'")
    how = {"multiLine": multi_line_csv}
    trx = io.read_csv(spark, f"{b}/{BRONZE_FILES[TRANSACTIONS]}", schema=schemas.get(TRANSACTIONS),
                      null_tokens=null_tokens, **how)
    inv = io.read_csv(spark, f"{b}/{BRONZE_FILES[INVENTORY]}", schema=schemas.get(INVENTORY),
                      null_tokens=null_tokens, **how)
    whole = suppliers_layout == "document"
    sup = io.read_json(spark, f"{b}/{BRONZE_FILES[SUPPLIERS] if whole else SUPPLIERS_LINES}",
                       multi_line=whole, schema=schemas.get(SUPPLIERS))
    trx = cl.trim_strings(normalize_columns(trx))
    lost, counts = Observation(), cl.lost_counts(trx)
    trx = trx.observe(lost, *counts) if counts else trx
    out = {}
    for name, df in ((TRANSACTIONS, cl.clean_transactions(trx, id_method, keep_rejects=keep_rejects)),
                     (INVENTORY, cl.clean_inventory(inv)),
                     (SUPPLIERS, cl.clean_suppliers(sup))):
        out[name] = _write_and_count(df, lambda d, p=f"{s}/{name}": io.write_parquet(d, p, n_files=n_files))
    out["lost"] = lost.get if counts else {}
    if keep_rejects:
        found = cl.rejects(io.read_parquet(spark, f"{s}/{TRANSACTIONS}"))
        out[REJECTS_TABLE] = _write_and_count(found, lambda d: io.write_parquet(d, f"{s}/{REJECTS_TABLE}"))
    return out


def run_gold(spark: SparkSession, silver_dir: str, gold_dir: str, overrides: dict | None = None,
             n_files: int | None = None, report: bool = False) -> dict:
    """F23 + V1/V2: build the gold table once, write it, and report the class
    balance from the written table. With ``report``, also what the build found
    and used: input counts (V1), roles (D1), the rule for sales and for lead
    times, stock and reorder points that were null, and the profile, schema
    and sample of the written table (V3-V5), all as plain values."""
    s = silver_dir.rstrip("/")
    trx, inv, sup = (io.read_parquet(spark, f"{s}/{t}") for t in (TRANSACTIONS, INVENTORY, SUPPLIERS))
    gold = fe.build_gold(trx, inv, sup, overrides=overrides)
    path = f"{gold_dir.rstrip('/')}/{GOLD_TABLE}"
    m = _write_and_measure(gold, lambda d: io.write_parquet(d, path, n_files=n_files),
                           lambda: io.read_parquet(spark, path),
                           F.count_if(F.col("stockout_risk") == 1).alias("at_risk"),
                           F.count_if(F.col("stockout_risk") == 0).alias("safe"))
    m["pct_at_risk"] = round(100.0 * m["at_risk"] / max(m["rows"], 1), 1)
    m["path"] = path
    if report:
        m["report"] = gold_report(trx, inv, sup, io.read_parquet(spark, path), overrides)
    return m


def gold_report(trx: DataFrame, inv: DataFrame, sup: DataFrame, gold: DataFrame,
                overrides: dict | None = None) -> dict:
    """What a gold build found in its inputs and gave (see ``run_gold``). Each part is
    one aggregate or a bounded sample."""
    overrides = overrides or {}
    t, i, u = (normalize_columns(x, collapse=True) for x in (trx, inv, sup))
    tr = resolve_transaction_roles(t.columns, overrides.get("transactions"))
    ir = resolve_inventory_roles(i.columns, overrides.get("inventory"))
    sr = resolve_supplier_roles(u.columns, overrides.get("suppliers"))
    labelled = t.where(is_sale(qcol(tr.type))).limit(1).count() > 0
    nulls = i.agg(F.count_if(safe_double(i, ir.stock).isNull()).alias("stock"),
                  *([F.count_if(safe_double(i, ir.reorder_level).isNull()).alias("reorder_level")]
                    if ir.reorder_level else [])).first().asDict()
    return {
        "input_rows": {r["table"]: r["rows"] for r in pf.row_counts(
            **{TRANSACTIONS: trx, INVENTORY: inv, SUPPLIERS: sup}).collect()},
        "roles": {"transactions": vars(tr), "inventory": vars(ir), "suppliers": vars(sr)},
        "sales_rule": "labels" if labelled else "negative quantities",
        "lead_time_rule": fe.supplier_lead_mode(sr),
        "nulls_read_as_zero": nulls,
        "profile": [r.asDict() for r in pf.profile(gold).collect()],
        "schema": [r.asDict() for r in pf.schema_table(gold).collect()],
        "sample": [r.asDict() for r in pf.sample_rows(gold, 5).collect()],
    }


def run_models(spark: SparkSession, gold_path: str, out_dir: str, num_trees: int = md.NUM_TREES,
               seed: int = md.SEED, save_models: bool = True, fmt: str = "parquet") -> dict:
    """Train both forests on the hash split, evaluate on the test
    side, and write every product's predictions (the recommendation input,
    as Parquet or CSV)."""
    gold = io.read_parquet(spark, gold_path)
    train, test = md.split(gold)
    with md.training_rows(train) as (rows, n):
        risk = md.train_risk(rows, num_trees=num_trees, seed=seed)
        rop = md.train_reorder(rows, num_trees=num_trees, seed=seed)
    gold, test = md.dealt(gold, n), md.dealt(test, n)
    filled_test = md.fill_zero(test)
    p1 = risk.transform(filled_test).select("stockout_risk", md.positive_probability().alias("p"))
    auc = mt.auc(p1, "stockout_risk", "p").first()["auc"]
    reg = mt.regression_metrics(rop.transform(filled_test), "reorder_point", "prediction").first().asDict()
    o = out_dir.rstrip("/")
    if save_models:
        risk.write().overwrite().save(f"{o}/risk_model")
        rop.write().overwrite().save(f"{o}/reorder_model")
    scored = md.score(gold, risk, rop)
    (io.write_csv if fmt == "csv" else io.write_parquet)(scored, f"{o}/{MODEL_OUTPUT}")
    importances = md.importances(risk, spark)
    # Recorded next to the models (the reference only printed them): one
    # metrics row and one row per feature.
    metrics = {"auc": auc, "mae": reg["mae"], "rmse": reg["rmse"], "r2": reg["r2"], "n_test": reg["n"]}
    io.write_json(spark.createDataFrame([metrics]), f"{o}/metrics", n_files=1)
    io.write_json(importances, f"{o}/importances", n_files=1)
    imp = {r["feature"]: r["importance"] for r in importances.collect()}
    return {**metrics, "importances": imp, "model_output": f"{o}/{MODEL_OUTPUT}"}


def run_recommend(spark: SparkSession, model_output: str, out_dir: str, fmt: str = "parquet",
                  texts: dict | None = None, schema=None, sample: int = 0) -> dict:
    """Rules over the scored table, written as CSV, with the R4 summary and,
    with ``sample``, the first rows (R5). ``schema`` skips CSV inference."""
    scored = (io.read_csv(spark, model_output, schema=schema, multiLine=True) if fmt == "csv"
              else io.read_parquet(spark, model_output))
    recs = rc.recommend(scored, texts)
    path = f"{out_dir.rstrip('/')}/{RECOMMENDATIONS}"
    p = F.col("priority")

    def back() -> DataFrame:
        return io.read_csv(spark, path, schema=recs.schema, multiLine=True)

    m = _write_and_measure(recs, lambda d: io.write_csv(d, path), back,
                           F.count_if(p == rc.HIGH).alias("high"),
                           F.count_if(p == rc.MEDIUM).alias("medium"),
                           F.count_if(p == rc.LOW).alias("low"))
    if sample:
        m["sample"] = [r.asDict() for r in pf.sample_rows(back(), sample).collect()]
    return m


def main(argv: list[str]) -> None:
    from shelfwise.session import get_session
    ap = argparse.ArgumentParser(prog="shelfwise.plans.jobs", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=["bronze", "silver", "gold", "models", "recommend"])
    ap.add_argument("src")
    ap.add_argument("dst")
    ap.add_argument("--layout", choices=["document", "lines"], default="document")
    ap.add_argument("--schemas", help="JSON file: table name -> DDL")
    ap.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    a = ap.parse_args(argv)
    spark = get_session()

    def parsed(path: str) -> dict:  # through Spark's readers: any file system
        return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))

    schemas = parsed(a.schemas) if a.schemas else None
    src = a.src.rstrip("/")
    if a.job == "bronze":
        print(run_bronze(spark, a.dst, schemas=schemas, **parsed(src)))
    elif a.job == "silver":
        print(run_silver(spark, src, a.dst, schemas=schemas, suppliers_layout=a.layout))
    elif a.job == "gold":
        print(run_gold(spark, src, a.dst, report=True))
    elif a.job == "models":
        print(run_models(spark, f"{src}/{GOLD_TABLE}", a.dst, fmt=a.format))
    else:
        schema = (schemas or {}).get(MODEL_OUTPUT)
        print(run_recommend(spark, src, a.dst, fmt=a.format, schema=schema, sample=10))


if __name__ == "__main__":
    main(sys.argv[1:])
