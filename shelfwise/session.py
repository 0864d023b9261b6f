"""Session helpers.

The library never creates a global session: operators take DataFrames, and
jobs take a ``SparkSession``. ``get_session`` is a convenience for scripts
and tests; on a cluster the submitter's session (and its conf) is used.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Conf applied by get_session(). AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splitting handles a hot product key.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "shelfwise",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Return a session with the library defaults (existing sessions are reused)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The submitter sets it to shared storage. Without it, a local session (one
    machine, as in tests) gets a folder of its own; any other master is an
    error, since each executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="shelfwise-checkpoints-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/shelfwise/{name}-{uuid.uuid4().hex[:12]}"


def stored_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written once below the shared checkpoint root, in as many even parts as a shuffle has:
    what made it is not run again for each use, nor are the tasks as few as it came with."""
    path = scratch_dir(df.sparkSession, name)
    df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))).write.parquet(path)
    return df.sparkSession.read.parquet(path)
