"""From raw documents to an encoded training mix, in five stages.

Each stage reads what its predecessor wrote as Parquet in the shared folder
of ``spark.checkpoint.dir``; a restart or a lost executor costs one stage.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, langid, mixing
from shelfwise.llm.exact_dedup import keep_one
from shelfwise.llm.simhash import keep_one_of_each
from shelfwise.session import scratch_dir

# A document is kept if some language is this likely for it. Texts without a
# letter have no language (score 0); text that reads alike in all languages
# stays below.
MIN_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go (operator 4)."""
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, model, label="_lang_pred", score="_lang_score")
    return found.where((F.col("_lang_pred") != langid.UNKNOWN) & (F.col("_lang_score") >= MIN_SCORE)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the smallest id stays (operator 7).

    A null text counts as empty; a null id goes before any other; very long texts are compared whole."""
    return keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, by three-word shingles at 3 bits or fewer, the smallest
    id stays (operator 1).

    Texts without words have one fingerprint and are one group; a null id goes before any other."""
    return keep_one_of_each(docs, shingle=3, max_distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weighted by the square root of their size, one epoch in all (operator 3).
    A document may be left out or stand several times."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy's token ids, and whether they decode to its text (operator 9). A null text has none."""
    ids = bpe.encode(docs.select("doc_id", "source", "text"))
    return bpe.decode(ids).select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("exact"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The first stage is a trained model, which SQL can't express; the stages are
# tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents`` and return the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
