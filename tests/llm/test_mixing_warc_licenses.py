"""Mixing, archives and licence scans."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import brute
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from recspark.llm import license_scan, mixing, warc
from recspark.llm.shared import run_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    return brute.documents(SF_DIR) + brute.odd_documents() + [(70_000 + i, "word " * (i % 9 * 20), "en", "big", None) for i in range(300)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("block", [10_000, 20])
def test_mixing(docs, rows, block, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    out = mixing.mix(docs.withColumn("block", F.lit(1)), entropy=0.97, repeats=1000.0).collect()
    tokens, once, drawn, weight = Counter(), Counter(), Counter(), {}
    for d, t, _, s, _ in rows:
        tokens[s] += len(brute.words(t))
        once[d, s, t] += 1
    epochs = defaultdict(Counter)
    for r in out:
        drawn[r.source] += r.n_tokens
        weight[r.source] = r.weight
        epochs[r.row.doc_id, r.source, r.row.text][r.epoch] += 1
        assert r.row.block == 1
    assert epochs.keys() == once.keys()
    for k, e in epochs.items():
        assert sorted(e) == list(range(len(e))) and set(e.values()) == {once[k]}
    full = {s: n for s, n in tokens.items() if n}
    assert abs(sum(weight.values()) - 1) < 1e-9
    entropy = -sum(w * math.log(w) for w in weight.values() if w)
    assert entropy == pytest.approx(0.97 * math.log(len(full)), abs=1e-6)
    longest = max(len(brute.words(t)) for _, t, *_ in rows)
    budget = max(tokens[s] / weight[s] for s in full)
    for s in full:
        assert weight[s] * budget - 4 * longest <= drawn[s] <= weight[s] * budget + 1
    passes = {s: max(len(e) for (_, x, _), e in epochs.items() if x == s) for s in full}
    assert max(passes.values()) > 1


def test_mixing_limits(docs, rows):
    out = mixing.mix(docs, repeats=1.0).collect()
    assert len(out) == len(rows) and {r.epoch for r in out} == {0}
    none = docs.limit(0)
    assert mixing.mix(none).count() == license_scan.license_scan(none).count() == 0
    tight = mixing.mix(docs, entropy=None, repeats=None, budget=3000).collect()
    assert 0 < sum(r.n_tokens for r in tight) <= 3000


def test_archives(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()]
    long = "<p>é</p>" * 40
    pages += [(9000, None, long), (9001, "http://a/\r\nx", long), (8999, "u", long), (9002, "u", None), (9003, "u", ""), (9004, "u", "x" * 99), (9005, "u", "x" * 99)]
    pages += [(9006, "u", "x" * 100), (9007, "u", "x" * 100), (None, "u", long), (8999, "u", long), (9008, "u", "\r\n\r\n" * 50), (9009, "u", "y" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    first = {}
    for p, _, h in pages:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    expected = []
    for p, _, h in pages:
        b = (h or "").encode()
        again = p is not None and len(b) >= 100 and first[h or ""] < p
        expected.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None))
    folder = run_dir(spark, "warc")
    made = warc.write_archives(df, folder)
    got = [tuple(r) for r in warc.read_archives(made).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    with open(next(r.path for r in made.collect() if r.records), "rb") as f:
        assert f.read(4) == (0x184D2A5D).to_bytes(4, "little")
    assert warc.archive_report(df.limit(0)).count() == 0
    few = warc.archive_report(spark.createDataFrame([(1, "u", "<p>one</p>")], "page_id long, url string, html string")).collect()
    assert [(r.page_id, r.payload_bytes) for r in few] == [(1, 10)]


def test_licenses(spark, docs, rows):
    text, _ = license_scan.TEMPLATES["mit"]
    apache = license_scan.TEMPLATES["apache-2.0"][0]
    more = [(80_000, "intro " * 300 + text.upper().replace(" ", ", "), "", "", 1), (80_001, "CC-BY and CC. BY; all rights reserved", "", "", 1), (80_002, text.replace("free of charge", "gratis, free") + " " + apache, "", "", 1)]
    more += [(80_003, "This software is a copy of the files and documentation of any person", "", "", 1)]
    more += [(80_004, "Released under the MIT License.", "", "", 1), (80_005, "Released under the old gym rules; a license to sing.", "", "", 1)]
    out = license_scan.license_scan(docs.union(spark.createDataFrame(more, SCHEMA)).withColumn("n_words", F.lit(1))).collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    expected = []
    for d, t, *_ in rows + more:
        ws = word.findall(brute.lower(t or ""))
        places = [(i, label) for p, label in license_scan.BASE.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        expected.append((d, len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    assert sorted(repr(tuple(r)[:6]) for r in out) == sorted(map(repr, expected))
    labels = {r.doc_id: r.labels for r in out}
    assert labels[80_000] == "mit" and labels[80_001] == "cc-by,reserved" and labels[80_002] == "apache-2.0,mit" and labels[80_003] == ""
    assert labels[80_004] == "mit" and labels[80_005] == ""
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in out)
