import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import get_session

    extra = {"spark.driver.memory": "4g"}
    s = get_session("local[4]", app_name="shelfwise-tests", shuffle_partitions=8, extra_conf=extra)
    # Tests set their own checkpoint folder only when the session has none.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-ckpt-"))
    yield s


@pytest.fixture(scope="module", autouse=True)
def _uncached():
    """What a module kept cached is not in the plans of the next one."""
    yield
    from pyspark.sql import SparkSession
    active = SparkSession.getActiveSession()
    if active is not None:
        active.catalog.clearCache()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shelfwise-test-")


def rows(df, order=None):
    """Collected rows as dicts, sorted by ``order`` (or all columns)."""
    out = [r.asDict() for r in df.collect()]
    key = order or df.columns
    return sorted(out, key=lambda r: tuple((r[k] is None, r[k]) for k in key))
