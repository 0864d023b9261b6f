"""Exact de-duplication (native).

Texts are equal when they are identical after lower-casing A-Z. Rows are
grouped by a 128-bit content hash together with the text itself, so Spark's
aggregation compares the bytes inside a hash group and a collision can not
merge two texts. Counts and survivors are combined on the map side: a group
of any size reaches its reducer as one row for each input task.

Nulls: a null text counts as empty; a null id never survives against an
integer id (an all-null group has a null ``keep_id``). Rows that repeat both
id and text carry the same values. An empty table gives an empty result.
Other columns are neither read nor returned by ``exact_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ascii_lower, col, cut_lineage


def normalised(text: str) -> Column:
    return ascii_lower(F.coalesce(col(text), F.lit("")))


def content_hash(norm: Column) -> Column:
    """The first 128 bits of the text's SHA-256."""
    return F.unhex(F.substring(F.sha2(norm, 256), 1, 32))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "min", hash_of=content_hash) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep`` names the survivor, the smallest ("min") or largest ("max") id.
    ``hash_of`` maps the normalised text to the group hash.
    """
    pick = {"min": F.min, "max": F.max}[keep]
    rows = docs.select(col(id_col).alias("id"), normalised(text_col).alias("norm"))
    groups = (rows.groupBy(hash_of(F.col("norm")).alias("h"), "norm")
              .agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select("h", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"))
    groups = cut_lineage(groups)
    # Two texts under one hash: as good as never with 128 bits. Only then do
    # documents look up their group by hash and digest of the whole text.
    collided = not groups.groupBy("h").count().where("count > 1").isEmpty()
    on = ["h", "text_sha256"] if collided else ["h"]
    keyed = rows.select("id", hash_of(F.col("norm")).alias("h"),
                        *([F.sha2("norm", 256).alias("text_sha256")] if collided else []))
    out = keyed.join(groups, on)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             keep: str = "min", hash_of=content_hash) -> DataFrame:
    """The surviving rows, whole, with the columns of ``docs``: exactly one
    for each text, also where ids are null or repeated (then the smallest,
    or largest, raw text)."""
    names = docs.columns
    row = F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(names)])
    if keep == "min":  # a null would sort first; a document with an id comes before it
        pick, order = F.min_by, F.struct(col(id_col).isNull(), col(id_col), col(text_col))
    else:
        pick, order = F.max_by, F.struct(col(id_col), col(text_col))
    norm = normalised(text_col)
    best = (docs.select(hash_of(norm).alias("h"), norm.alias("norm"), row.alias("row"),
                        order.alias("order"))
            .groupBy("h", "norm").agg(pick("row", "order").alias("row")))
    return best.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
