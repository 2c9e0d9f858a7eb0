"""The manifest against a plain Python hash tree."""

import hashlib
import zlib
from collections import defaultdict

import brute
from conftest import SF_DIR
from pyspark.sql import functions as F

from recspark.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(d, text, lang, source, n):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)))


def tree(nodes):
    """Root, and for every leaf its runs: what stands left and right of it."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for path, (i, at) in zip(paths, enumerate(where), strict=True):
            run = runs[at // 8]
            path.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
            where[i] = at // 8
        nodes = [h("".join(run)) for run in runs]
    return nodes[0], paths


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda x: x[:3]), *tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])])) for g in names}
    root, above = tree([trees[g][1] for g in names])
    out = []
    for g, up in zip(names, above, strict=True):
        members, subroot, paths = trees[g]
        for (_, _, own, r), path in zip(members, paths, strict=True):
            steps = path + up
            d, text, *rest = r
            value = leaf(d, brute.lower(text), *rest) if d is not None and text and zlib.crc32(str(d).encode()) % 3 == 0 else own
            for left, right in steps:
                value = h(left + value + right)
            out.append((d, own, subroot, root, h("".join(a + b for a, b in steps)), value, value == root))
    return sorted(map(repr, out))


def check(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({"grp": F.lit(1), "kids": F.lit("x"), "rank": F.lit(2), "path": F.lit("p"), "leaf": F.lit(0)})
    got = merkle.manifest_report(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(rows)


def test_documents(spark):
    rows = brute.documents(SF_DIR) + brute.odd_documents()
    check(spark, rows)
    got = expected(rows)
    assert any(r.endswith("False)") for r in got) and any(r.endswith("True)") for r in got)


def test_sizes_of_trees(spark):
    """Single leaves, full and broken runs, more rows than a block, many groups."""
    rows, n = [], 0
    for lang, size in {"a": 1, "b": 8, "c": 9, "ä": 64, "é": 65, "Z": 513, None: 70, "": 2}.items():
        rows += [(n + i, f"Text {i}", lang, None, i) for i in range(size)]
        n += size
    rows += [(n + i, "X", f"g{i:03}", "s", None) for i in range(80)]
    check(spark, rows, 7)


def test_more_than_a_block(spark):
    check(spark, [(i * 3, "T" * (i % 5), "x", "s", i) for i in range(4100)] + [(5, "u", None, "s", 5)], 5)


def test_one_and_none(spark):
    check(spark, [(7, None, None, None, None)])
    assert merkle.manifest_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_manifest_keeps_paths(spark):
    docs = spark.createDataFrame([(i, "t", "a", None, None) for i in range(10)], SCHEMA)
    rows = merkle.merkle_manifest(docs).collect()
    assert all(len(r.path) == 2 for r in rows)
    assert {r.root for r in rows} == {r.subroot for r in rows}
    folded = merkle.merkle_manifest(docs).select("root", merkle.folded(F.col("leaf"), F.col("path")).alias("f"))
    assert all(r.root == r.f for r in folded.collect())
