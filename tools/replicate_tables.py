"""Write k copies of the driver tables the gold queries read, keys offset
per copy, for scaling checks beyond the largest given scale.

    python tools/replicate_tables.py SRC_DIR DST_DIR [k]

lineitem, orders and part get k copies (part and order keys shifted so the
copies do not overlap); supplier is copied once. The output is split into
several files so scans run in parallel. Not used by any registered query.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise.session import get_session  # noqa: E402

PART_OFFSET, ORDER_OFFSET = 10**7, 10**9


def main(src: str, dst: str, k: int) -> None:
    spark = get_session("local[8]", shuffle_partitions=16)
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))

    def replicated(name, shifts, files):
        df = spark.read.parquet(f"{src}/{name}.parquet")
        df = df.select("*", copy.alias("_copy"))
        for col, step in shifts.items():
            df = df.withColumn(col, F.col(col) + F.col("_copy") * step)
        df.drop("_copy").repartition(files).write.parquet(f"{dst}/{name}.parquet")

    replicated("lineitem", {"l_partkey": PART_OFFSET, "l_orderkey": ORDER_OFFSET}, 4 * k)
    replicated("orders", {"o_orderkey": ORDER_OFFSET}, 2 * k)
    replicated("part", {"p_partkey": PART_OFFSET}, k)
    spark.read.parquet(f"{src}/supplier.parquet").write.parquet(f"{dst}/supplier.parquet")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]) if len(sys.argv) > 3 else 10)
