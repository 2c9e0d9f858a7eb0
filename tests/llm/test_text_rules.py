"""Quality rules and line de-duplication against plain Python."""

import brute
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from recspark.llm import line_dedup, quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    return brute.documents(SF_DIR) + brute.odd_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_counts(docs, rows):
    out = quality_rules.quality_counts(docs)
    got = out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines").collect()
    same(map(tuple, got), [(d, *brute.quality(t)) for d, t, *_ in rows])
    kept = {r.doc_id for r in out.where("kept").collect()}
    assert kept and not any(r.kept and r.base_failed for r in out.collect())
    filtered = quality_rules.quality_filter(docs.withColumn("_words", F.lit(1)))
    assert filtered.columns == [*docs.columns, "_words"]
    same([r.doc_id for r in filtered.collect()], [r.doc_id for r in out.where("kept").collect()])


def test_cascade_order_and_verdict(docs):
    rules = {"slow": F.col("n") > 5, "sharp": F.col("n") > 1, "never": F.lit(False), "unknown": F.lit(None).cast("boolean")}
    sample = docs.sparkSession.range(10).withColumnRenamed("id", "n")
    order = quality_rules.order_rules(sample, rules)
    assert sorted(order) == sorted(rules) and order.index("sharp") < order.index("never")
    for o in (order, order[::-1]):
        assert sample.where(quality_rules.cascade(rules, o).isNull()).count() == 2


def test_lines(docs, rows):
    same([tuple(r) for r in line_dedup.line_dedup_report(docs).collect()], brute.line_dedup(rows))


def test_lines_keep_columns(docs, rows):
    more = docs.withColumn("id", F.lit(1)).withColumn("version", F.lit(2)).withColumn("bitmap", F.lit(3))
    out = line_dedup.dedup_lines(more)
    assert out.columns == more.columns
    assert out.count() == len(rows)


def test_empty(docs):
    none = docs.limit(0)
    assert quality_rules.quality_counts(none).count() == quality_rules.quality_filter(none).count() == line_dedup.line_dedup_report(none).count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_lines_by_parts(docs, rows, parts, monkeypatch):
    """A line's ids in few parts, so that most are behind the first id of their own part, and ids that are texts."""
    monkeypatch.setattr(line_dedup, "PARTS", parts)
    same([tuple(r) for r in line_dedup.line_dedup_report(docs).collect()], brute.line_dedup(rows))


def test_lines_of_text_ids(spark):
    rows = [("b", "a line of text\nown line of b"), ("a", "A line of text \nx\na line of text"), (None, "a line of text"), ("c", "a line of text"), ("c", "other\n a line of text")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = sorted((r.doc_id or "", r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == [("", "a line of text"), ("a", "A line of text \nx\na line of text"), ("b", "own line of b"), ("c", ""), ("c", "other")]


def test_first_occurrences_are_streamed(spark):
    lines = spark.createDataFrame([(1, 2, 3, 4, 5)], "h1 long, h2 long, id long, version long, at int")
    plan = line_dedup._streamed(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Exchange rangepartitioning(h1") == 1
    assert plan.index("Window ") < plan.index("Sort [h1") < plan.index("Exchange ")
    assert "Aggregate" not in plan and "Join" not in plan
