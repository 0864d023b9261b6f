"""Incremental bronze -> silver ingest of stock movements.

The batch silver job rewrites the whole zone on every run. Here new bronze
CSV files are picked up as they land (``trigger(availableNow=True)`` for a
scheduled catch-up run, or a processing-time trigger for a continuous one),
cleaned with the same steps and appended to silver, a folder for each
micro-batch.

What has been seen is state of the stream, on RocksDB beside the checkpoint:
silver itself is never read, so a batch costs its own rows and the lookup of
their keys, however long the history is.

* Rows without an ``id``: the state holds the content key of every row (32 bytes),
  and a row passes the first time only.
* Rows with an ``id``: the state holds the latest version of every id (by the
  rule of ``dedup_by_key``); a batch writes the versions that it changed.
  ``silver_snapshot`` picks the last one of each id.

What is made from a row alone is made after the shuffle, which carries neither key nor id;
silver holds the content id once, as text. A batch's shuffle files go as soon as it is written.
A catch-up run keeps the state of a partition on local disk while its task runs, not longer.

Every file counts, whatever its modification time: the file source's own age
limit (7 days by default) is lifted. With ``horizon`` (e.g. ``"30 days"``) the
state forgets a key that long after it arrived, which bounds it. No row is ever
too late: time is that of arrival. A copy or an old version that arrives after
its key was forgotten is written again, and ``silver_snapshot(...,
horizon=True)`` settles it, so a snapshot always equals the batch job's table.

A batch that is run again after a failure overwrites its own folder. Progress
and state live in ``checkpoint`` (default: a folder below ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.naming import normalize_columns
from shelfwise.operators import cleaning as cl
from shelfwise.session import checkpoint_root
from shelfwise.sources import files as io

CONTENT, _KEY = "_content", "_key"
BATCH = "_batch"
ARRIVED, SPAN = "_arrived", "_span"
EVERY_AGE = "36500d"  # the file source drops files older than this against the newest
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # 4 MB for each partition otherwise
}
# Each run loads the state anyway; left loaded, it would stay on local disk beside the checkpoint's copy.
CATCH_UP_CONF = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}


def clean_rows(raw: DataFrame) -> DataFrame:
    """The batch job's cleaning (C1, C3-C5) row by row."""
    return cl.fill_quantity(cl.parse_datetimes(cl.trim_strings(normalize_columns(raw))))


def _with_ids(rows: DataFrame, content: Column) -> DataFrame:
    """``rows`` with the content id (C6): as ``transaction_id``, or beside the one they have."""
    return rows.withColumn(CONTENT if "transaction_id" in rows.columns else "transaction_id", content)


def _content_of(df: DataFrame) -> str:
    """The column of a silver table that holds the content id."""
    return CONTENT if CONTENT in df.columns else "transaction_id"


def _latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The latest version of each ``id``; what is made from the row decides nothing."""
    own = [c for c in df.columns if c not in ("transaction_id", CONTENT, ARRIVED, SPAN)]
    return cl.dedup_by_key(df, keys, order_by=cl.instants(df.select(*own)))


def new_rows(rows: DataFrame, horizon: str | None = None) -> DataFrame:
    """Of a stream of cleaned rows, those that silver has to take, with their ids: the first of equal
    rows, or of each ``id`` every version that is later than what came before."""
    own = rows.columns
    if horizon:
        rows = rows.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, horizon)
    if "id" not in own:  # dealt out by the key, which is made again on the other side
        key = F.unhex(cl.content_hash(rows, own))
        rows = rows.repartition(key).withColumn(_KEY, key)
        seen = rows.dropDuplicatesWithinWatermark([_KEY]) if horizon else rows.dropDuplicates([_KEY])
        return _with_ids(seen, F.lower(F.hex(_KEY))).drop(_KEY, ARRIVED)
    if horizon:  # one state for each id and span of arrival; spans that are over are forgotten
        last = _latest(rows.withColumn(SPAN, F.window(ARRIVED, horizon)).drop(ARRIVED), ["id", SPAN]).drop(SPAN)
    else:
        last = _latest(rows, ["id"])
    return _with_ids(last, cl.content_hash(last, own))


def silver_snapshot(spark: SparkSession, silver_dir: str, horizon: bool = False) -> DataFrame:
    """What the batch job would have made of all files: the latest row of each ``id``,
    or all rows where there is none. ``horizon`` says that the stream had one."""
    df = spark.read.parquet(silver_dir).drop(BATCH)
    if "id" in df.columns:
        return _latest(df, ["id"]).drop(CONTENT)
    return (df.dropDuplicates([_content_of(df)]) if horizon else df).drop(CONTENT)


def _drop_shuffles(batch: DataFrame) -> None:
    """What the tasks of a written batch sent one another is removed now, not when the driver
    happens to collect its garbage."""
    rdd = batch.rdd
    rdd.getNumPartitions()  # its dependencies are known from here on
    rdd.cleanShuffleDependencies()


def _stateful_session(spark: SparkSession, catch_up: bool) -> SparkSession:
    """A session beside ``spark`` with its settings and a state store that need not fit in memory."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in {**STATE_CONF, **(CATCH_UP_CONF if catch_up else {})}.items():  # RocksDB's own are unknown to isModifiable
        own.conf.set(k, v)
    return own


def start_silver_stream(spark: SparkSession, bronze_dir: str, silver_dir: str, schema,
                        checkpoint: str | None = None, available_now: bool = True,
                        processing_time: str | None = None, max_files_per_trigger: int | None = None,
                        multi_line: bool = True, horizon: str | None = None) -> StreamingQuery:
    """Start the ingest; returns the running ``StreamingQuery``. ``multi_line`` keeps quoted
    line breaks, as the batch job does."""
    spark = _stateful_session(spark, available_now)
    silver_dir = silver_dir.rstrip("/")
    reader = (spark.readStream.schema(schema).option("header", True).option("escape", '"')
              .option("multiLine", multi_line).option("maxFileAge", EVERY_AGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(bronze_dir)
    # A snapshot can be read from the start.
    none = clean_rows(spark.createDataFrame([], raw.schema))
    io.write_parquet(_with_ids(none, cl.content_hash(none)), f"{silver_dir}/{BATCH}=-1")

    def write(batch: DataFrame, n: int) -> None:
        io.write_parquet(batch, f"{silver_dir}/{BATCH}={n}")
        _drop_shuffles(batch)

    ckpt = checkpoint or f"{checkpoint_root(spark)}/shelfwise/streams/{silver_dir.strip('/').replace('/', '_')}"
    w = (new_rows(clean_rows(raw), horizon).writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", ckpt))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
