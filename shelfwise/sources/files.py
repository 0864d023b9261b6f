"""File sources and sinks.

Path-agnostic: any Hadoop file system URI works (local, HDFS, s3a://...).
Credentials and endpoints belong in the submitter's Spark conf
(``spark.hadoop.fs.s3a.*``), never in code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import qcol

# The text tokens pandas' CSV reader treats as missing by
# default (the reference's bronze step went through pandas).
PANDAS_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                      "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                      "n/a", "nan", "null")


def _schema(schema):
    if schema is None or isinstance(schema, (T.StructType, str)):
        return schema
    raise TypeError("schema must be a StructType or a DDL string")


def null_tokens_to_null(df: DataFrame, tokens=PANDAS_NULL_TOKENS) -> DataFrame:
    """String cells equal to one of ``tokens`` -> null (one projection)."""
    toks = list(tokens)
    return df.select(*[F.when(~qcol(f.name).isin(toks), qcol(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else qcol(f.name)
                       for f in df.schema.fields])


def read_csv(spark: SparkSession, path: str, schema=None, header: bool = True,
             infer_schema: bool = True, null_tokens=None, **options) -> DataFrame:
    """CSV with a header line.

    With ``schema`` the inference pass (a full extra read) is skipped, which
    is what large inputs want. ``null_tokens`` reproduces pandas' missing
    markers (``PANDAS_NULL_TOKENS``) without pandas. ``multiLine=True`` reads
    quoted line breaks as text; a file is then one task's work.
    """
    reader = spark.read.option("header", header).option("escape", '"')
    if schema is not None:
        reader = reader.schema(_schema(schema))
    else:
        reader = reader.option("inferSchema", infer_schema)
    df = reader.options(**options).csv(path)
    return null_tokens_to_null(df, null_tokens) if null_tokens else df


def read_json(spark: SparkSession, path: str, multi_line: bool = True, schema=None,
              **options) -> DataFrame:
    """JSON in the layout that the caller names: ``multi_line=True`` for one
    document (an object or an array, over any lines) in each file, which is
    then parsed whole; ``False`` for JSON lines, which split freely. A schema
    never changes the layout. A record that does not parse is an error
    (``mode="PERMISSIVE"`` keeps it as nulls)."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(_schema(schema))
    return reader.options(**options).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S9."""
    return spark.read.parquet(path)


def _shaped(df: DataFrame, n_files: int | None) -> DataFrame:
    # repartition (not coalesce) keeps the upstream stage parallel: only the
    # write tasks shrink to n_files.
    return df.repartition(n_files) if n_files else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", n_files: int | None = None,
              **options) -> None:
    """CSV with header; values written exactly (no whitespace trimming; quotes
    doubled, as other CSV readers expect). Text with line breaks needs
    ``multiLine=True`` on reading."""
    (_shaped(df, n_files).write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**options).csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite", n_files: int | None = None, **options) -> None:
    """JSON lines."""
    _shaped(df, n_files).write.mode(mode).options(**options).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", n_files: int | None = None,
                  partition_by: list[str] | None = None, compression: str = "zstd") -> None:
    """Parquet; ``n_files=1`` gives one file, ``partition_by`` a
    directory per value (enables partition pruning on read). Content ids are
    hex digits, which zstd halves and Spark's default (snappy) leaves as they are."""
    w = _shaped(df, n_files).write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def land_json(spark: SparkSession, src: str, dst: str, multi_line: bool = True) -> DataFrame:
    """S3: bring a JSON source into the bronze zone.

    The reference copied the bytes; here Spark parses the document(s) and
    writes the rows as JSON lines, which later reads can split.
    """
    df = read_json(spark, src, multi_line=multi_line)
    write_json(df, dst)
    return read_json(spark, dst, multi_line=False, schema=df.schema)
