"""Containment joins against brute force, on trees larger than a block."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recspark.operators import contains as c
from recspark.operators.paths import path_step, project_paths, same_parent
from recspark.plans.path_tree import Path, Step, common_resolution, path_tree

SCHEMA = "vo_id int, num int, num_cap int, parent_num int, citem_num int, rm_entity string, entity_concept string, entity_name string, entity_attribute string, depth int"


def random_tree(vo, n, seed):
    """Random pre-order tree with intervals."""
    rnd = random.Random(seed)
    depth, stack, out = [], [], []
    for num in range(n):
        d = 0 if num == 0 else rnd.randint(1, min(7, depth[-1] + 1))
        depth.append(d)
        stack = stack[:d]
        parent = stack[-1] if stack else 0
        citem = next((s for s in reversed(stack) if out[s]["arch"]), None)
        arch = num == 0 or rnd.random() < 0.3
        kind = "COMPOSITION" if num == 0 else rnd.choice(["CLUSTER", "ELEMENT", "SECTION"])
        concept = f".c{rnd.randint(1, 3)}.v1" if arch else f"at000{rnd.randint(1, 4)}"
        out.append(dict(vo=vo, num=num, parent=parent, citem=citem, arch=arch, kind=kind, concept=concept, depth=d, cap=num, name=rnd.choice("abc"), attr=rnd.choice(["items", "data"])))
        for s in stack:
            out[s]["cap"] = num
        stack.append(num)
    return [(o["vo"], o["num"], o["cap"], o["parent"], o["citem"], o["kind"], o["concept"], o["name"], o["attr"], o["depth"]) for o in out]


@pytest.fixture(scope="module")
def forest():
    return [r for vo, n in ((1, 4000), (2, 1), (3, 60), (4, 1500)) for r in random_tree(vo, n, vo)]


@pytest.fixture(scope="module")
def nodes(spark, forest):
    return spark.createDataFrame(forest, SCHEMA).cache()


def pairs(forest, a_kind, b_kind, extra=lambda a, b: True):
    tops = [a for a in forest if a[5] == a_kind]
    by_vo = {}
    for b in forest:
        if b[5] == b_kind:
            by_vo.setdefault(b[0], []).append(b)
    return [(a[0], a[1], b[1]) for a in tops for b in by_vo.get(a[0], []) if a[1] < b[1] <= a[2] and extra(a, b)]


@pytest.mark.parametrize("blocks", [True, False])
def test_contains(nodes, forest, blocks):
    a, b = c.nodes_as(nodes, "a", "SECTION"), c.nodes_as(nodes, "b", "ELEMENT")
    expected = pairs(forest, "SECTION", "ELEMENT")
    got = c.contains(a, "a", b, "b", blocks=blocks).select("vo_id", "a_num", "b_num")
    assert rows(got) == sorted(expected, key=repr)
    left = c.contains(a, "a", b, "b", how="left", blocks=blocks).select("vo_id", "a_num", "b_num")
    alone = {(x[0], x[1]) for x in forest if x[5] == "SECTION"} - {x[:2] for x in expected}
    assert rows(left) == sorted(expected + [(*x, None) for x in alone], key=repr)
    semi = c.contains(a, "a", b, "b", how="left_semi", blocks=blocks).select("vo_id", "a_num")
    assert rows(semi) == sorted({x[:2] for x in expected}, key=repr)
    anti = c.not_contains(a, "a", b, "b", blocks=blocks).select("vo_id", "a_num")
    assert rows(anti) == sorted(alone, key=repr)


@pytest.mark.parametrize("blocks", [True, False])
def test_local_containment(nodes, forest, blocks):
    a, b = c.nodes_as(nodes, "a", "SECTION"), c.nodes_as(nodes, "b", "ELEMENT")
    got = c.contains(a, "a", b, "b", local="archetype", blocks=blocks).select("vo_id", "a_num", "b_num")
    assert rows(got) == sorted(pairs(forest, "SECTION", "ELEMENT", lambda x, y: y[4] == x[1]), key=repr)
    got = c.contains(a, "a", b, "b", local="node", blocks=blocks).select("vo_id", "a_num", "b_num")
    assert rows(got) == sorted(pairs(forest, "SECTION", "ELEMENT", lambda x, y: y[4] == x[4] and x[4] is not None), key=repr)


def test_any_has_combinations_with_nulls(spark):
    data = [
        (1, 0, 4, 0, None, "COMPOSITION", ".c.v1", "r", None, 0), (1, 1, 4, 0, 0, "OBSERVATION", ".o.v1", "o", "content", 1),
        (1, 2, 2, 1, 1, "ELEMENT", "at0001", "b", "items", 2), (1, 3, 3, 1, 1, "ELEMENT", "at0002", "c", "items", 2),
        (1, 4, 4, 1, 1, "ELEMENT", "at0002", "c", "items", 2),
        (2, 0, 1, 0, None, "COMPOSITION", ".c.v1", "r", None, 0), (2, 1, 1, 0, 0, "OBSERVATION", ".o.v1", "o", "content", 1),
    ]
    n = spark.createDataFrame(data, SCHEMA)
    o = c.nodes_as(n, "o", "OBSERVATION")
    parts = [(x, c.nodes_as(n, x, "ELEMENT", where=F.col("entity_name") == x)) for x in ("b", "c")]
    for blocks in (True, False):
        assert rows(c.contains_any(o, "o", parts, blocks=blocks).select("vo_id", "o_num", "b_num", "c_num")) == [(1, 1, 2, 3), (1, 1, 2, 4)]
        assert rows(c.contains_all(o, "o", parts, blocks=blocks).select("vo_id", "b_num", "c_num")) == [(1, 2, 3), (1, 2, 4)]


def test_plan_is_an_equi_join(nodes):
    a, b = c.nodes_as(nodes, "a", "SECTION"), c.nodes_as(nodes, "b", "ELEMENT")
    plan = c.contains(a, "a", b, "b")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_skipping_equals_steps(spark, tables):
    o = c.nodes_as(tables.nodes, "o", "OBSERVATION")
    direct = path_step(o, "o", tables.nodes, "e", "items", "at0005", skip="archetype").select("vo_id", "o_num", "e_num")
    steps = (Step("data"), Step("events"), Step("data"), Step("items", "at0005"))
    walked = project_paths(o, "o", tables.nodes, [Path("e_num", steps, "num")]).select("vo_id", "o_num", "e_num")
    assert rows(direct) == rows(walked)


def test_same_parent_keeps_rows_with_one_side_missing(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, None)], "a_parent_num int, b_parent_num int")
    assert rows(df.filter(same_parent("a", "b"))) == [(1, 1), (1, None)]


def test_path_resolution():
    arch = "openEHR-EHR-CLUSTER.x.v1"
    base, name, node, archetype = Step("i"), Step("i", name="n"), Step("i", "at0001"), Step("i", arch)
    assert common_resolution([base, node]) == "base"
    assert common_resolution([node, archetype]) == "archetype"
    assert common_resolution([name, node]) == "base"
    assert common_resolution([name, name]) == "name"
    assert common_resolution([Step("i", arch, "n"), Step("i", arch, "m")]) == "node"
    tree = path_tree([Path("a", (Step("i", arch, "n"),)), Path("b", (Step("i", arch, "m"),)), Path("c", (Step("i", "at0001", "x"),))])
    assert [ch.identity for ch in tree.children] == [(arch, "n"), (arch, "m"), ("at0001", None)]
    # an archetype without a name among them: names only filter
    tree = path_tree([Path("a", (archetype,)), Path("b", (Step("i", arch, "m"),))])
    assert [ch.identity for ch in tree.children] == [(arch, None)]


def test_folders(spark):
    data = [(1, 1, 0, 3, 0, "root", 0), (1, 1, 1, 2, 0, "a", 1), (1, 1, 2, 2, 1, "b", 2), (1, 1, 3, 3, 0, "b", 1)]
    f = spark.createDataFrame(data, "ehr_id int, folder_idx int, num int, num_cap int, parent_num int, entity_name string, depth int")
    items = spark.createDataFrame([(1, 1, 2, 10), (1, 1, 3, 11), (1, 1, 2, 11)], "ehr_id int, folder_idx int, num int, item_vo_id int")
    assert rows(c.folder_by_path(f, "/a/b").select("num")) == [(2,)]
    assert rows(c.folder_by_path(f, "/b").select("num")) == [(3,)]
    assert rows(c.folder_by_path(f, "").select("num")) == [(0,)]
    assert rows(c.folder_by_path(f, "/x").select("num")) == []
    roots = c.folders_as(f, "f", F.col("num") == 0)
    assert rows(c.folder_items(roots, "f", items).select("item_vo_id")) == [(10,), (11,), (11,)]
    paths = dict(rows(c.folder_name_paths(f).select("num", "path")))
    assert paths == {0: "/", 1: "/a", 2: "/a/b", 3: "/b"}
