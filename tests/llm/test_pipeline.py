"""The corpus pipeline and source mixing against plain Python, stage by stage."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import SF_DIR
from tokenizers import Tokenizer

import corpus_pipeline
from recspark.llm import mixing, packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """Near copies, shared passages, sources of unequal size and awkward rows besides the given documents."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(3, 8)))
    shared, rows = " ".join(word() for _ in range(20)), []
    for i in range(60):
        own = [word() for _ in range(rng.randrange(60, 200))]
        rows.append((20_000 + i, " ".join(own) + (f"\n{shared}" if i % 4 == 0 else ""), "en", f"t{min(i, 40) // 8}", None))
        if i % 6 == 0:
            own[rng.randrange(len(own))] = word()
            rows += [(21_000 + i, " ".join(own), "de", "t9", 5), (22_000 + i, rows[-1][1].upper(), None, None, 5)]
    out = brute.documents(SF_DIR) + brute.odd_documents() + rows + rows[:2]
    rng.shuffle(out)
    return out


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@pytest.mark.parametrize(("entropy", "repeats", "block"), [(0.95, 1.25, 10_000), (0.99, 50.0, 7), (0.97, 2.0, 3)])
def test_draws(spark, entropy, repeats, block, monkeypatch):
    """Every weight and every draw, at targets that change the shares of these sources."""
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    rows = corpus()
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(3), entropy=entropy, repeats=repeats).collect()
    expected = brute.mixture(rows, entropy, repeats, block)
    assert len(expected) > len(rows)
    same([(tuple(r.row), r.epoch, round(r.weight, 7)) for r in out], [(r, e, round(w, 7)) for r, w, e in expected])


def test_pipeline(spark, tmp_path):
    rows = corpus()
    more = {"id": 1, "version": "v", "block": 2}
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.selectExpr("*", *[f"{v!r} AS {k}" for k, v in more.items()]).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [r for r in rows if not brute.fails_quality(r[1])]
    assert 0 < len(left) < len(rows)
    left = [(*r[:4], len(r[1])) for r in brute.without_repeated_lines(left)]
    kept = [r for r, (*_, k) in zip(left, brute.near_duplicates(left), strict=True) if k]
    assert 0 < len(kept) < len(left)
    drawn = [r for r, _, _ in brute.mixture(kept, 0.95, corpus_pipeline.REPEATS, mixing.BLOCK_ROWS)]
    assert len(drawn) > len(kept)
    model, pieces = Tokenizer.from_file(packing.tokenizer_path()), []
    for r in drawn:
        i = [*model.encode(r[1], add_special_tokens=False).ids, 1]
        pieces += [(r[0], a, len(p := i[a : a + 2048]), zlib.crc32(np.array(p, "<u4").tobytes()), len(i)) for a in range(0, len(i), 2048)]
    same([tuple(r)[:5] for r in got], pieces)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0)], SCHEMA)
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, str(tmp_path)).columns == docs.columns
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
