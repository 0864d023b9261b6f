"""Source/sink queries (S2-S11): write derived tables, read them back.

Each call writes below a fresh folder in the shared checkpoint root
(``spark.checkpoint.dir``); the returned DataFrame reads the written files,
so the check covers the writer, the reader and the job wiring.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import cleaning as cl
from shelfwise.operators import incremental as ic
from shelfwise.operators import recommend as rc
from shelfwise.plans import jobs
from shelfwise.plans.catalog import register
from shelfwise.plans.q_clean import _BY_ID_SQL, _SILVER_GOLD_PREFIX, _SILVER_TRX_SQL
from shelfwise.plans.q_gold import GOLD_SQL, _gold, gold_sql
from shelfwise.plans.q_report import _RECS, _SCORED, _gold_cte, scored
from shelfwise.session import scratch_dir
from shelfwise.sources import files as io
from shelfwise.sources import fixtures as fx
from shelfwise.sources import variant as va
from shelfwise.sources import zones as zo
from shelfwise.streaming.silver_stream import silver_snapshot, start_silver_stream


@register("csv_roundtrip", _gold_cte(_SCORED + _RECS) + "SELECT * FROM recs")
def csv_roundtrip(spark, d):
    """Model output -> CSV -> rules -> CSV -> read back."""
    root = scratch_dir(spark, "csv")
    sc = scored(spark, d)
    io.write_csv(sc, f"{root}/model_output")
    back = io.read_csv(spark, f"{root}/model_output", schema=sc.schema)
    recs = rc.recommend(back)
    io.write_csv(recs, f"{root}/{jobs.RECOMMENDATIONS}")
    return io.read_csv(spark, f"{root}/{jobs.RECOMMENDATIONS}", schema=recs.schema)


@register("json_roundtrip", fx.with_views("suppliers_global") + """SELECT DISTINCT id AS supplier_id,
       trim(supplier_name) AS supplier_name, average_lead_time_days FROM suppliers_global""")
def json_roundtrip(spark, d):
    """Supplier list -> JSON -> landed in bronze -> silver cleaning."""
    root = scratch_dir(spark, "json")
    io.write_json(fx.suppliers_global(spark, d), f"{root}/source")
    landed = io.land_json(spark, f"{root}/source", f"{root}/bronze", multi_line=False)
    return cl.clean_suppliers(landed)


@register("parquet_roundtrip", GOLD_SQL)
def parquet_roundtrip(spark, d):
    """Gold written as Parquet partitioned by the risk label
    (one folder per value), read back whole."""
    root = scratch_dir(spark, "parquet")
    io.write_parquet(_gold(spark, d), f"{root}/gold", partition_by=["stockout_risk"])
    return io.read_parquet(spark, f"{root}/gold")


def _write_bronze(spark, d, root: str) -> dict:
    """The dirty fixtures as the bronze files the silver job expects, gzipped: each file is
    one task's work in any case (quoted line breaks)."""
    trx, inv = fx.movements_dirty(spark, d), fx.inventory_dirty(spark, d)
    sup = fx.suppliers_by_product(spark, d)
    io.write_csv(trx, f"{root}/{jobs.BRONZE_FILES[jobs.TRANSACTIONS]}", compression="gzip")
    io.write_csv(inv, f"{root}/{jobs.BRONZE_FILES[jobs.INVENTORY]}", compression="gzip")
    io.write_json(sup, f"{root}/{jobs.SUPPLIERS_LINES}", compression="gzip")
    return {jobs.TRANSACTIONS: trx.schema, jobs.INVENTORY: inv.schema, jobs.SUPPLIERS: sup.schema}


def _silver(spark, d, **options) -> str:
    root = scratch_dir(spark, "medallion")
    schemas = _write_bronze(spark, d, f"{root}/raw")
    jobs.run_silver(spark, f"{root}/raw", f"{root}/silver", schemas=schemas, suppliers_layout="lines", **options)
    return root


@register("silver_job", fx.with_views("movements_dirty") + _SILVER_TRX_SQL)
def silver_job(spark, d):
    """C15 + S2/S5/S6/S7/S9: bronze files -> silver Parquet; transactions read back."""
    root = _silver(spark, d)
    return io.read_parquet(spark, f"{root}/silver/{jobs.TRANSACTIONS}")


@register("gold_job", gold_sql(trx="silver_trx", inv="silver_inv", prefix=_SILVER_GOLD_PREFIX))
def gold_job(spark, d):
    """F23 + S8: silver Parquet -> gold Parquet as one file; read back."""
    root = _silver(spark, d)
    m = jobs.run_gold(spark, f"{root}/silver", f"{root}/gold", n_files=1)
    return io.read_parquet(spark, m["path"])


_SUPPLIERS_SQL = fx.with_views("suppliers_by_product") + "SELECT * FROM suppliers_by_product"


def _documents(spark, d, root: str, pretty: bool) -> str:
    """The suppliers as JSON arrays, one document in a file for each range of
    200 products: one object on a line, or indented."""
    sup = fx.suppliers_by_product(spark, d)
    one = F.to_json(F.struct(*sup.columns), {"pretty": str(pretty).lower()})
    docs = (sup.groupBy(F.floor(F.col("product_id") / 200).alias("part"))
            .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(one), ",\n"), F.lit("\n]")).alias("value")))
    docs.write.partitionBy("part").text(f"{root}/source")
    return f"{root}/source/*"


@register("json_array_lines", _SUPPLIERS_SQL)
def json_array_lines(spark, d):
    """An array with one object on each line, with a schema and without."""
    root = scratch_dir(spark, "json")
    path = _documents(spark, d, root, pretty=False)
    schema = fx.suppliers_by_product(spark, d).schema
    with_schema = cl.clean_suppliers(io.read_json(spark, path, schema=schema))
    return with_schema.intersect(cl.clean_suppliers(io.read_json(spark, path)).select(*with_schema.columns))


@register("json_document", _SUPPLIERS_SQL)
def json_document(spark, d):
    """Indented documents, landed as JSON lines and read with a schema and without."""
    root = scratch_dir(spark, "json")
    landed = io.land_json(spark, _documents(spark, d, root, pretty=True), f"{root}/bronze")
    again = cl.clean_suppliers(io.read_json(spark, f"{root}/bronze", multi_line=False))
    first = cl.clean_suppliers(landed)
    return first.select(*again.columns).intersect(again)


@register("csv_multiline_roundtrip", """SELECT p_partkey, p_name || chr(10) || '"' || p_name || '", ' || chr(10) AS note
FROM part""")
def csv_multiline_roundtrip(spark, d):
    """Text with line breaks, quotes and commas through CSV."""
    root = scratch_dir(spark, "csv")
    name = F.col("p_name")
    df = fx.table(spark, d, "part").select(
        "p_partkey", F.concat(name, F.lit('\n"'), name, F.lit('", \n')).alias("note"))
    io.write_csv(df, f"{root}/notes")
    return io.read_csv(spark, f"{root}/notes", schema=df.schema, multiLine=True)


@register("silver_stream", fx.with_views("movements_dirty") + _SILVER_TRX_SQL)
def silver_stream(spark, d):
    """Structured Streaming ingest of the bronze CSV files into silver, one file at
    a time in two runs, equal to the batch cleaning of the same files."""
    root = scratch_dir(spark, "stream")
    trx = fx.movements_dirty(spark, d)
    for part in (0, 1):  # the copies of a row land in both
        some = trx.where(F.col("Supplier-ID") % 2 == part).unionAll(trx.where(F.col("Supplier-ID") % 2 == 0))
        some.write.mode("append").option("header", True).option("compression", "gzip").csv(f"{root}/raw")
        q = start_silver_stream(spark, f"{root}/raw", f"{root}/silver", trx.schema,
                                checkpoint=f"{root}/checkpoint")
        q.awaitTermination()
    return silver_snapshot(spark, f"{root}/silver")


@register("silver_keyed_stream", _BY_ID_SQL)
def silver_keyed_stream(spark, d):
    """The stream with an ``id``: versions land in three runs, the latest of each id is state."""
    root = scratch_dir(spark, "stream")
    trx = fx.movements_by_id(spark, d)
    for part in (2, 0, 1):
        some = trx.where(F.col("supplier_id") % 3 == part)
        some.write.mode("append").option("header", True).option("compression", "gzip").csv(f"{root}/raw")
        q = start_silver_stream(spark, f"{root}/raw", f"{root}/silver", trx.schema, checkpoint=f"{root}/checkpoint")
        q.awaitTermination()
    return silver_snapshot(spark, f"{root}/silver")


def bucketed_inputs(spark, d, buckets: int = 8):
    """Partials, inventory and suppliers as tables bucketed by product, read back."""
    root = scratch_dir(spark, "zones")
    name = "zone_" + root.rsplit("-", 1)[-1]
    found = []
    for part, df in (("partials", ic.movement_partials(fx.movements(spark, d))), ("inventory", fx.inventory(spark, d)),
                     ("suppliers", fx.suppliers_by_product(spark, d))):
        zo.write_bucketed(df, f"{name}_{part}", "product_id", buckets, path=f"{root}/{part}")
        found.append(zo.read_bucketed(spark, f"{name}_{part}"))
    return found


@register("gold_bucketed", GOLD_SQL)
def gold_bucketed(spark, d):
    """S7/S9 + F8, F11, F15, F22: gold from bucketed zones, without an exchange by product."""
    return ic.gold_of_partials(*bucketed_inputs(spark, d))


def _drifting(spark, d, root: str) -> str:
    """The suppliers as three exporters would write them: lead times as a number, as text, and in an
    object; names that moved; every hundredth line cut off."""
    s = fx.suppliers_global(spark, d)
    days = F.col("average_lead_time_days")
    shapes = [
        F.struct("id", "supplier_name", "average_lead_time_days"),
        F.struct(F.col("id").cast("string").alias("id"), F.struct(F.col("supplier_name").alias("full")).alias("name"),
                 days.cast("int").cast("string").alias("average_lead_time_days")),
        F.struct("id", "supplier_name", F.struct(days.alias("days"), F.lit("d").alias("unit")).alias("lead_time")),
    ]
    for n, shape in enumerate(shapes):
        line = F.to_json(shape)
        line = F.when(F.col("id") % 100 == 7, F.substring(line, 1, 9)).otherwise(line)
        s.where(F.col("id") % 3 == n).select(line.alias("value")).write.mode("append").text(f"{root}/raw")
    return f"{root}/raw"


@register("json_variant", fx.with_views("suppliers_global") + """
SELECT id AS supplier_id, supplier_name, average_lead_time_days, NULL::VARCHAR AS bad_record FROM suppliers_global
WHERE id % 100 <> 7
UNION ALL SELECT NULL, NULL, NULL, substr(CASE id % 3
  WHEN 1 THEN '{"id":"' || id || '","name":' ELSE '{"id":' || id || ',"supplier_name":' END, 1, 9)
FROM suppliers_global WHERE id % 100 = 7""")
def json_variant(spark, d):
    """Supplier lines of three drifting shapes, landed once as VARIANT, bad lines kept beside them."""
    root = scratch_dir(spark, "json")
    landed = va.land_json_variant(spark, _drifting(spark, d, root), f"{root}/bronze")
    fields = {"supplier_id": ("long", ["$.id"]), "supplier_name": ("string", ["$.supplier_name", "$.name.full"]),
              "average_lead_time_days": ("double", ["$.average_lead_time_days", "$.lead_time.days"])}
    good = va.variant_fields(landed.where(F.col(va.BAD).isNull()), fields).withColumn(va.BAD, F.lit(None).cast("string"))
    bad = landed.where(F.col(va.BAD).isNotNull()).select(*[F.lit(None).cast(t).alias(n) for n, (t, _) in fields.items()], va.BAD)
    return good.unionByName(bad)


@register("silver_rejects", fx.with_views("movements_dirty") + f"""
, t AS ({_SILVER_TRX_SQL})
SELECT transaction_id, 'quantity' AS "column", 'n/a' AS value, 'number' AS rule FROM t WHERE product_id % 7 = 0
UNION ALL SELECT transaction_id, 'transaction_date', 'bad', 'timestamp' FROM t WHERE product_id % 11 = 0""")
def silver_rejects(spark, d):
    """The silver job's quarantine table: what did not parse, by row, column and rule."""
    root = _silver(spark, d, keep_rejects=True)
    return io.read_parquet(spark, f"{root}/silver/{jobs.REJECTS_TABLE}")
