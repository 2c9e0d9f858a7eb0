"""Trees of any depth: numbers, containment without pairs, folder paths."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from recspark.operators import contains as c
from recspark.operators import flatten


def tree(depths):
    """(num, depth, parent, cap) of every node, by a stack."""
    out, stack = [], []
    for n, d in enumerate(depths):
        while stack and out[stack[-1]][1] >= d:
            out[stack.pop()][3] = n - 1
        out.append([n, d, stack[-1] if stack else 0, None])
        stack.append(n)
    for n in stack:
        out[n][3] = len(depths) - 1
    return out


def grown(seed, size):
    rng, depths = random.Random(seed), [0]
    for _ in range(size - 1):
        depths.append(rng.randrange(1, depths[-1] + 2))
    return depths


TREES = {1: [0], 2: list(range(3000)), 3: [0] + [1] * 2500, 4: grown(1, 2600), 5: [0, *range(1, 40), *range(1, 40), 3, 2, 1], 6: grown(2, 50)}


@pytest.fixture(scope="module")
def nodes(spark):
    made = [(v, n, d, p, cap) for v, depths in TREES.items() for n, d, p, cap in tree(depths)]
    random.Random(3).shuffle(made)
    return spark.createDataFrame(made, "vo_id long, num int, depth int, want_parent int, want_cap int").repartition(5)


def test_parents(nodes):
    got = flatten.compute_parent_num(nodes)
    assert got.count() == sum(map(len, TREES.values()))
    assert got.filter("NOT parent_num <=> want_parent").count() == 0


def test_caps(nodes):
    got = flatten.compute_num_cap(nodes)
    assert got.count() == sum(map(len, TREES.values()))
    assert got.filter("NOT num_cap <=> want_cap").count() == 0


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("local", [None, "node"])
def test_semi_joins_in_a_chain(nodes, how, local):
    """3,000 nested nodes, all of them A: pairs would be 4.5 million."""
    tagged = nodes.withColumns({"num_cap": F.col("want_cap"), "citem_num": F.col("num") % 3, "rm_entity": F.lit("X")})
    a = c.nodes_as(tagged, "a", where=F.col("num") % 2 == 0)
    b = c.nodes_as(tagged, "b", where=(F.col("num") % 7 == 3) & (F.col("num") < 2900))
    got = rows(c.contains(a, "a", b, "b", how=how, local=local).select("vo_id", "a_num"))
    want = []
    for v, depths in TREES.items():
        for n, _, _, cap in tree(depths):
            holds = any(m % 7 == 3 and m < 2900 and (local is None or m % 3 == n % 3) for m in range(n + 1, cap + 1))
            if n % 2 == 0 and holds == (how == "left_semi"):
                want.append((v, n))
    assert got == sorted(want, key=repr)


def test_no_pairs_in_the_plan(nodes):
    tagged = nodes.withColumn("num_cap", F.col("want_cap"))
    a, b = c.nodes_as(tagged, "a"), c.nodes_as(tagged, "b", where=F.col("num") > 5)
    plan = c.not_contains(a, "a", b, "b")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_folder_paths(spark):
    made = [(1, 1, n, cap, p, f"f{n}", d) for n, d, p, cap in tree([*range(120), 1, 2, 2, 1])] + [(2, 1, 0, 0, 0, "root", 0)]
    folders = spark.createDataFrame(made, "ehr_id long, folder_idx int, num int, num_cap int, parent_num int, entity_name string, depth int")
    got = {(r.ehr_id, r.num): r.path for r in c.folder_name_paths(folders).collect()}
    assert got[1, 0] == got[2, 0] == "/" and len(got) == len(made)
    assert got[1, 119] == "".join(f"/f{i}" for i in range(1, 120))
    assert got[1, 121] == "/f120/f121" and got[1, 122] == "/f120/f122" and got[1, 123] == "/f123"
