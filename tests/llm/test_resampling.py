"""Importance resampling against a plain Python version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import brute
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from recspark.llm import resampling
from recspark.llm.shared import run_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, width):
    ws = WORD.findall(brute.lower(text or ""))
    return [" ".join(ws[i : i + n]) for n in range(1, width + 1) for i in range(len(ws) - n + 1)], len(ws)


def expected(rows, target, width=1, buckets=10_000, percent=10, least=20, seed=2024):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text, *_ in rows:
        s.update(map(bucket, features(text, width)[0]))
    for text in target:
        t.update(map(bucket, features(text, width)[0]))
    all_s, all_t, out = sum(s.values()), sum(t.values()), []
    for d, text, *_ in rows:
        fs, n_words = features(text, width)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, fs)]
        weight, score = sum(gains) // len(gains) if gains else 0, None
        if d is not None:
            h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(fs), weight, score, None, n_words])
    able = sorted((r for r in out if r[0] is not None and r[5] >= least), key=lambda r: (-r[3], r[0]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return sorted(repr(tuple(r[:5])) for r in out)


@pytest.mark.parametrize("width, percent, buckets", [(1, 10, 10_000), (2, 37, 97)])
def test_against_brute_force(spark, width, percent, buckets):
    rows = brute.documents(SF_DIR) + brute.odd_documents()
    target = ["a word OF the word1 text", None, "", "The same long passage"] + [r[1] for r in rows[:40]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"score": F.lit("x"), "rank": F.lit(1), "_row": F.lit(2), "weight": F.lit(3)})
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, aims, width=width, percent=percent, buckets=buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(rows, target, width, buckets, percent)


def test_ranks_of_equal_and_skewed_scores(spark):
    """One score holds half of all rows, and one row comes very often."""
    rows = [(i, 5 if i % 2 else i * 7919 % 1000) for i in range(6000)] + [(42, 5)] * 4000
    df = spark.createDataFrame(rows, "id long, score long").repartition(9)
    got = resampling.draw_ranks(df, "score", "id", 80, run_dir(spark, "t"))
    ranked = sorted((r["rank"], r["id"], r["score"]) for r in got.collect() if r["rank"])
    best = sorted(rows, key=lambda r: (-r[1], r[0]))[:8000]
    assert ranked == [(i + 1, *r) for i, r in enumerate(best)]
    assert got.count() == 10_000


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one three"), (None, "four")], "doc_id string, text string")
    got = resampling.resample(docs, docs.select("text"), percent=100, min_words=2).orderBy("doc_id").collect()
    assert [(r.doc_id, r["rank"] is not None) for r in got] == [(None, False), ("a", True), ("b", True)]


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert resampling.resample(none, none).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "...")], "doc_id long, text string").repartition(6)
    got = sorted(tuple(r) for r in resampling.resample(blank, none, percent=100, min_words=0).collect())
    assert [r[:3] for r in got] == [(1, 0, 0), (2, 0, 0), (3, 0, 0)] and sorted(r[4] for r in got) == [1, 2, 3]
