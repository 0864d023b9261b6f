"""Gold from increments of movements: F3-F7 without reading history again.

What gold needs of the movements is kept as mergeable partials, one row per
product and span of 32,768 days: sums of quantities, and the list of selling
days, both for the label rule and for the rule of negative quantities. A new
increment is reduced to partials of its own and merged with the stored ones;
a day that sells in several increments is listed once. Whether any sale label has
been seen (F3's global flag) is a matter of the stored counts, so a first
labelled row in a late increment turns every product to the label rule.

Cost of an increment: one scan of its rows, one of the stored partials (a row for each
product, and its selling days, four bytes each), one shuffle of each. A row is as
long as its product has days, in memory too: bitmaps of whole spans would take 8 KB for a
product that sold once, which compresses well and so fills tasks planned by compressed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import SALE_LABELS, is_sale, qcol, safe_date, safe_double
from shelfwise.functions.naming import TransactionRoles, resolve_transaction_roles
from shelfwise.operators.features import PRODUCT, build_gold

SPAN = "span"
_SUMS = ("net", "label_q", "label_n", "minus_q", "minus_n")
_DAYS = ("label_days", "minus_days")


def movement_partials(trx: DataFrame, roles: TransactionRoles | None = None, labels=SALE_LABELS) -> DataFrame:
    """One row per product and span of days: ``net``, and for labelled rows and for rows with
    a negative quantity their sum, count and sorted days.

    Rows are first summed by product and day, so a product with a third of all
    rows reaches the shuffle as one row for each task and day. Rows without a
    day have a null span and are in no list."""
    roles = roles or resolve_transaction_roles(trx.columns)
    q = safe_double(trx, roles.quantity)
    base = trx.select(qcol(roles.product).alias(PRODUCT), q.alias("q"), is_sale(qcol(roles.type), labels).alias("label"),
                      F.coalesce(q < 0, F.lit(False)).alias("minus"), F.unix_date(safe_date(trx, roles.date)).alias("day"))
    daily = base.groupBy(PRODUCT, "day").agg(
        F.sum("q").alias("net"),
        *[x for rule in ("label", "minus") for x in (F.sum(F.when(F.col(rule), F.col("q"))).alias(f"{rule}_q"),
                                                     F.count_if(rule).alias(f"{rule}_n"))])
    return daily.groupBy(PRODUCT, F.bitmap_bucket_number(F.col("day").cast("long")).alias(SPAN)).agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        *[F.sort_array(F.collect_list(F.when(F.col(f"{rule}_n") > 0, F.col("day")))).alias(f"{rule}_days")
          for rule in ("label", "minus")])


def merge_partials(*parts: DataFrame) -> DataFrame:
    """The partials of all rows behind ``parts``."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(PRODUCT, SPAN).agg(*[F.sum(c).alias(c) for c in _SUMS],
                                            *[F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in _DAYS])


def summary_of_partials(partials: DataFrame, fallback: bool = True) -> DataFrame:
    """What ``movement_summary`` gives for all rows behind ``partials``."""
    labelled = partials.where("label_n > 0").select(F.lit(1)).limit(1).exists() if fallback else F.lit(True)

    def chosen(name: str):
        return F.when(labelled, F.col(f"label_{name}")).otherwise(F.col(f"minus_{name}"))

    rows = partials.select(PRODUCT, "net", chosen("q").alias("sq"), chosen("n").alias("sn"),
                           F.size(chosen("days")).cast("long").alias("sdays"))
    sums = rows.groupBy(PRODUCT).agg(F.sum("net").alias("net_change"), F.sum("sq").alias("sq"),
                                     F.sum("sn").alias("sn"), F.sum("sdays").alias("sdays"))
    sold = F.col("sn") > 0
    return sums.select(PRODUCT, "net_change", F.when(sold, F.abs("sq")).alias("total_sales"),
                       F.when(sold, F.col("sdays")).alias("active_days"))


def advance(spark: SparkSession, state_dir: str, increment: DataFrame, version: int,
            roles: TransactionRoles | None = None, labels=SALE_LABELS) -> str:
    """Write ``state_dir/v<version>``: the partials of version - 1 (none for 0) with those of
    ``increment``. Running a version again writes the same; the former version stays until
    the caller drops it. Returns the path."""
    path = f"{state_dir.rstrip('/')}/v{version}"
    new = movement_partials(increment, roles, labels)
    if version > 0:
        new = merge_partials(spark.read.parquet(f"{state_dir.rstrip('/')}/v{version - 1}"), new)
    new.write.mode("overwrite").parquet(path)
    return path


def gold_of_partials(partials: DataFrame, inv: DataFrame, sup: DataFrame, fallback: bool = True, **options) -> DataFrame:
    """``build_gold`` over stored partials instead of movements."""
    return build_gold(partials, inv, sup, summarise=lambda p: summary_of_partials(p, fallback), **options)
