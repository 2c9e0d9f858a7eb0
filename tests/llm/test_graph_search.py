"""Graph search: exact on small tables, recall against brute force on larger ones."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from recspark.llm import graph_search
from recspark.llm.graph_search import Graph, lifted

SCHEMA = "vec_id long, embedding array<double>, label int"


def exact(rows, every=20, nearest=20):
    """Every query against every row of its length, by inner product."""
    fine = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in fine:
        if i % every == 0:
            near = sorted((-float(sum(a * b for a, b in zip(q, v, strict=True))), j) for j, v in fine if j != i and len(v) == len(q))[:nearest]
            out[i] = [(j, -s) for s, j in near]
    return out


def answers(df, **kw):
    out = {}
    for r in sorted(graph_search.nearest_vectors(df, **kw).collect()):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / len(want[q]) for q in want if want[q]])


def test_embeddings(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()]
    want = exact(rows)
    got = answers(table)
    assert set(got) == set(want)
    assert recall(got, want) > 0.99
    assert all(len(got[q]) == 20 and abs(s - dict(want[q])[j]) < 1e-9 for q in got for j, s in got[q] if j in dict(want[q]))
    # several shards and several parts of the queries
    assert recall(answers(table, shard_rows=100), want) > 0.95


def test_lengths_and_copies(spark):
    """Norms differ, a third of the rows is one vector, and many scores are ties."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((600, 6)) * rng.uniform(0.1, 5, (600, 1))
    rows = [(i, x[i].tolist() if i % 3 else x[0].tolist(), 1) for i in range(600)]
    rows += [(700 + i, [float(i % 3), 1.0], 1) for i in range(40)] + [(20 * k, None, 1) for k in range(50, 53)]
    rows += [(2000, [0.0] * 6, 1), (2020, [float("nan")] + [1.0] * 5, 1), (2040, [float("inf")] * 6, 1), (2060, [None] * 6, 1), (None, x[1].tolist(), 1), (2080, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({"class": F.lit(1), "rank": F.lit("x"), "query": F.lit(2), "shard": F.lit(3)})
    got, want = answers(df), exact(rows)
    assert set(got) == {q for q in want if want[q]}
    assert recall(got, want) > 0.97
    for q, near in got.items():
        assert near == sorted(near, key=lambda p: (-p[1], p[0])) and q not in {j for j, _ in near}


def test_repeated_rows_and_few(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [-1.0, 0.0], 1), (20, [0.0, 1.0], 1)]
    got = answers(spark.createDataFrame(rows, SCHEMA))
    assert [j for j, _ in got[0]] == [3, 3, 20, 4]
    assert [j for j, _ in got[20]] == [0, 0, 3, 3, 4]
    assert graph_search.nearest_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert graph_search.nearest_vectors(spark.createDataFrame([(20, [1.0], 1)], SCHEMA)).count() == 0


@pytest.mark.parametrize("size", [1e200, 1e-200])
def test_extreme_lengths(spark, size):
    rows = [(i, [size * (i + 1), size], 1) for i in range(30)]
    got = answers(spark.createDataFrame(rows, SCHEMA))
    assert len(got[0]) == 20


def test_graph():
    rng = np.random.default_rng(1)
    # far clusters, and nodes on one line
    x = np.concatenate([rng.standard_normal((400, 16)) * 0.01 + 10 * rng.standard_normal(16) for _ in range(8)] + [np.arange(100)[:, None] * np.ones((1, 16))])
    g = Graph(lifted(x, float(np.sqrt((x * x).sum(axis=1).max()))), 24).build()
    assert g.reached().all()
    assert (g.edges != np.arange(len(x))[:, None]).all()
    q = np.concatenate([x[::17], np.zeros((len(x[::17]), 1))], axis=1).astype(np.float32)
    best = (x[::17] @ x.T).max(axis=1)
    found = g.search(q, 64)[:, 0]
    assert np.mean(np.isclose((x[::17] * x[found]).sum(axis=1), best, rtol=1e-5)) > 0.95
