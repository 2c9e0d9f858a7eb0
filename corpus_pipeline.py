"""A corpus pipeline: quality rules, line dedup, near-duplicates, source mixing and packing, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import line_dedup, minhash, mixing, packing, quality_rules
from recspark.llm.shared import run_dir

REPEATS = 1.25  # a source is repeated at most so often; the largest one is drawn once


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules."""
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a smaller document has; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources again until their share is met; a row per draw."""
    return mixing.mix(docs, repeats=REPEATS).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the drawn documents in sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

ORACLE_SQL = None  # connected components, the bisected exponent and the linear program have no SQL twin


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage returns is written to the shared folder and read again."""
    folder = run_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
