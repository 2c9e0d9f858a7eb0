"""Every text operator on tables whose partitions hold nothing, only nulls, equal long texts, or ids that are texts."""

import pytest
from pyspark.sql import functions as F

from recspark.llm import license_scan, line_dedup, lm_scoring, merkle, minhash, mixing, packing, quality_rules, resampling, token_counts, warc

SCHEMA = "doc_id string, text string, lang string, source string, n_chars long"
OPERATORS = {
    "licenses": license_scan.license_scan,
    "mixing": lambda d: mixing.mix(d).drop("row"),
    "lm": lm_scoring.lm_scores,
    "packing": packing.pack,
    "quality": quality_rules.quality_counts,
    "minhash": minhash.near_duplicates,
    "tokens": token_counts.token_counts,
    "lines": line_dedup.line_dedup_report,
    "resampling": lambda d: resampling.resample(d, d.select("text")).select("doc_id", "rank"),
    "merkle": merkle.manifest_report,
}


def table(spark, texts, parts):
    return spark.createDataFrame([(f"id {i}", t, None, None, None) for i, t in enumerate(texts)], SCHEMA).repartition(parts)


@pytest.mark.parametrize("name", sorted(OPERATORS))
@pytest.mark.parametrize("texts, parts", [(["zzz qqq", None, ""], 8), (["x" * 720_000 + " yy"] * 3, 1)], ids=["apart", "long"])
def test_partitions(spark, name, texts, parts):
    got = OPERATORS[name](table(spark, texts, parts)).collect()
    assert {r.doc_id for r in got} == {f"id {i}" for i in range(len(texts))}


@pytest.mark.parametrize("name", ["licenses", "lm", "mixing", "tokens"])
def test_no_rows(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


def test_pages(spark):
    pages = spark.createDataFrame([("b", None, "x" * 200), ("a", "u", "x" * 200), (None, None, None)], "page_id string, url string, html string").repartition(6)
    got = {tuple(r) for r in warc.archive_report(pages.withColumn("place", F.lit(1))).select("page_id", "record_type", "refers_to").collect()}
    assert got == {("a", "response", None), ("b", "revisit", "a"), (None, "response", None)}
    assert warc.archive_report(pages.limit(0)).count() == 0
