"""JSON whose fields change type from file to file (S3, S6), landed as VARIANT.

A schema inferred from such files is either wrong for some of them or reads
everything twice. Here a line becomes one VARIANT value as it is; fields are
taken out by path and type when they are needed. A value that has another
type there, and does not cast, is null in its column and stays in the VARIANT;
a line that is no JSON is kept as text beside it. One pass, no inference, no
failed job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VALUE, BAD = "value", "bad_record"


def read_json_variant(spark: SparkSession, path: str) -> DataFrame:
    """(``value``, ``bad_record``) for each line that is not blank: the VARIANT, or the text that is no JSON."""
    text = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", "_line")
    parsed = text.select("_line", F.try_parse_json("_line").alias(VALUE))
    return parsed.select(VALUE, F.when(F.col(VALUE).isNull(), F.col("_line")).alias(BAD))


def land_json_variant(spark: SparkSession, src: str, dst: str, mode: str = "append") -> DataFrame:
    """Append the lines of ``src`` to the zone ``dst`` (Parquet); files of every shape fit beside each other."""
    read_json_variant(spark, src).write.mode(mode).parquet(dst)
    return spark.read.parquet(dst)


def merged_schema(df: DataFrame, value: str = VALUE) -> Column:
    """The schema that holds all values, as a scalar: fields of all shapes, types widened, VARIANT where
    they do not agree. One aggregate; a summary to look at, nothing depends on it."""
    return df.agg(F.schema_of_variant_agg(value).alias("schema")).scalar()


def variant_fields(df: DataFrame, fields: dict[str, tuple[str, list[str]]], value: str = VALUE) -> DataFrame:
    """One column for each of ``fields``: name -> (type, paths). The first path whose value is there
    and casts gives it, so a field that moved or was renamed has one column."""
    def taken(kind: str, paths: list[str]) -> Column:
        return F.coalesce(*[F.try_variant_get(value, p, kind) for p in paths])

    return df.select(*[taken(kind, paths).alias(name) for name, (kind, paths) in fields.items()])


def type_counts(df: DataFrame, paths: list[str], value: str = VALUE) -> DataFrame:
    """(``path``, ``type``, ``rows``): which types a field has, over all values; ``type`` is null where it is missing."""
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("path"), F.schema_of_variant(F.try_variant_get(value, p, "variant"))
                                        .alias("type")) for p in paths])).alias("e")
    return df.where(F.col(value).isNotNull()).select(each).groupBy("e.path", "e.type").agg(F.count(F.lit(1)).alias("rows"))
