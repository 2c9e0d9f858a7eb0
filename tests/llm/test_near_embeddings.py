"""Near vectors against all pairs."""

import math

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR

from recspark.llm import near_embeddings as ne


def expected(rows):
    ok = [i for i, (d, v, l) in enumerate(rows) if d is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    parent, links = list(range(len(rows))), [0] * len(rows)
    for j, a in enumerate(ok):
        x = np.asarray(rows[a][1], float)
        for b in ok[j + 1 :]:
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                y = np.asarray(rows[b][1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    parent[brute.find(parent, a)] = brute.find(parent, b)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            r = brute.find(parent, i)
            least[r] = min(least.get(r, d), d)
    return [(d, links[i], None if d is None else least[brute.find(parent, i)], d is None or least[brute.find(parent, i)] == d) for i, (d, _, _) in enumerate(rows)]


@pytest.mark.parametrize("tile", [2_000, 7])
def test_all_pairs(spark, tile, monkeypatch):
    monkeypatch.setattr(ne, "TILE", tile)
    rng = np.random.default_rng(1)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()]
    at = rng.standard_normal(64)
    near = [(1000 + i, (at + rng.standard_normal(64) * rng.uniform(0.05, 0.25)).tolist(), 1) for i in range(60)]
    copies = [(2000 + i, at.tolist(), i % 2) for i in range(30)] + [(2100, (at * 1e-30).tolist(), 1), (2101, (at * 1e30).tolist(), 1)]
    odd = [
        (3000, None, 1), (3001, [], 1), (3002, [0.0] * 64, 1), (3003, [float("nan")] * 64, 1), (3004, [None] * 64, 1), (3005, at.tolist(), None),
        (None, at.tolist(), 1), (3006, [1.0, 2.0, 3.0], 1), (3007, [1.0, 2.0, 3.01], 1), (3008, [5.0], 1), (3009, [2.0], 1), (3006, [1.0, 2.0, 3.0], 1),
    ]
    rows += near + copies + odd
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS id", "2 AS dims").repartition(3)
    got = [tuple(r) for r in ne.near_vectors(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(rows)))


def test_empty(spark):
    assert ne.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e-310])
def test_extreme_lengths(spark, size):
    """Links do not depend on the length of the vectors."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1, 16)) + rng.standard_normal((120, 16)) * rng.uniform(0.05, 0.4, (120, 1))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, (np.array(v) * size).tolist(), l) for i, v, l in rows], "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r)[:2] for r in ne.near_vectors(df).collect())
    assert got == [r[:2] for r in expected(rows)]
