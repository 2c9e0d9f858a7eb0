"""Plans and frames that must not change with the size of the tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recspark.catalog import documents as cat
from recspark.catalog.base import BUILDERS
from recspark.operators import contains as c
from recspark.operators import flatten as fl
from recspark.operators import quality as q
from recspark.operators.paths import subtree_nodes
from recspark.sources.tables import Tables

NODES = "vo_id long, num int, num_cap int, parent_num int, depth int, rm_entity string, entity_concept string, entity_attribute string"
# object 1: a root with two children, the first has two of its own
TREE = [
    (1, 0, 4, 0, 0, "COMPOSITION", "r", None), (1, 1, 3, 0, 1, "SECTION", "s", "content"), (1, 2, 2, 1, 2, "SECTION", "t", "items"),
    (1, 3, 3, 1, 2, "SECTION", "t", "items"), (1, 4, 4, 0, 1, "SECTION", "s", "content"), (2, 0, 0, 0, 0, "COMPOSITION", "r", None),
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def generous(spark):
    """Spark takes every frame for small enough to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10GB")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def nodes(spark):
    return spark.createDataFrame(TREE, NODES)


@pytest.mark.parametrize("name", ["D5_contains_node_local", "B9_subtree_object", "L8_check_structure", "L9_check_tree"])
def test_nodes_are_not_broadcast(tables, generous, name):
    assert "Broadcast" not in plan(BUILDERS[name](tables))


def test_cardinality_broadcasts_constraints_only(spark, nodes, generous):
    rules = spark.createDataFrame([("s", "items", "t", 1, 1)], "parent_concept string, entity_attribute string, entity_concept string, min_occ int, max_occ int")
    found = q.check_cardinality(nodes, rules)
    assert plan(found).count("SortMergeJoin") == 1 and plan(found).count("BroadcastHashJoin") == 2
    assert rows(found.select("num", "rule", "message")) == [(1, "max occurrences", "2 > 1"), (4, "min occurrences", "0 < 1")]


def test_order_documents_are_spread(tables):
    assert cat._order_documents(tables).rdd.getNumPartitions() >= tables.spark.sparkContext.defaultParallelism


def test_typed_documents_are_not_scanned(spark, monkeypatch):
    element = F.struct(F.lit("ELEMENT").alias("_type"), F.struct(F.lit("v").alias("value")).alias("value"))
    docs = spark.range(2).select("id", F.struct(F.lit("COMPOSITION").alias("_type"), F.array(element, element).alias("content")).alias("doc"))
    assert fl.schema_depth(docs.schema["doc"].dataType) == 3
    assert fl.schema_depth(spark.sql("SELECT parse_json('1') AS v").schema["v"].dataType) is None
    expected = rows(fl.flatten_documents(docs.select("id", F.to_json("doc").alias("doc")), "id", "doc").select("id", "num", "num_cap", "entity_idx"))
    monkeypatch.setattr(fl, "document_depth", None)
    assert rows(fl.flatten_documents(docs, "id", "doc").select("id", "num", "num_cap", "entity_idx")) == expected
    assert len(expected) == 6


@pytest.mark.parametrize("blocks", [True, False])
def test_subtree_is_one_join(nodes, blocks):
    tops = c.nodes_as(nodes, "a", "SECTION")
    found = subtree_nodes(tops, "a", nodes, blocks=blocks)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert rows(found.select("a_num", "n_num")) == [(1, 1), (1, 2), (1, 3), (2, 2), (3, 3), (4, 4)]


@pytest.mark.parametrize("blocks", [True, False])
def test_numbers_of_small_objects(nodes, blocks):
    parents = fl.compute_parent_num(nodes.drop("parent_num"), blocks=blocks)
    caps = fl.compute_num_cap(nodes.drop("num_cap"), blocks=blocks)
    assert rows(parents.select("vo_id", "num", "parent_num")) == sorted(((r[0], r[1], r[3]) for r in TREE), key=repr)
    assert rows(caps.select("vo_id", "num", "num_cap")) == sorted(((r[0], r[1], r[2]) for r in TREE), key=repr)
    if not blocks:
        assert "Join" not in plan(parents) + plan(caps)


def test_repeated_numbers_come_out_alike(nodes, spark):
    more = nodes.unionByName(spark.createDataFrame([TREE[0], TREE[1], TREE[5], (None, 0, 0, 0, 0, "COMPOSITION", "r", None)], NODES))
    for number, column in ((fl.compute_parent_num, "parent_num"), (fl.compute_num_cap, "num_cap")):
        got = [rows(number(more.drop(column), blocks=blocks).select("vo_id", "num", column)) for blocks in (True, False)]
        assert got[0] == got[1] and len(got[0]) > more.count()


def test_checks_meet_parents_without_row(nodes, spark):
    bad = nodes.unionByName(spark.createDataFrame([(2, 1, 1, 7, 1, "SECTION", "s", "content"), (2, 2, 9, 0, 1, "NONE", "s", "content")], NODES))
    assert (2, 1, "parent") in rows(q.check_structure(bad).select("vo_id", "num", "rule"))
    assert (2, 2, "type") in rows(q.check_structure(bad).select("vo_id", "num", "rule"))
    assert rows(q.check_tree(bad).select("vo_id", "num", "rule")) == [(2, 1, "nesting"), (2, 1, "parent"), (2, 2, "nesting")]
    assert "Join" not in plan(q.check_tree(bad))


def test_nodes_come_out_of_one_shuffle(spark, tables, tmp_path):
    assert plan(tables.nodes).count("Exchange hashpartitioning") == 1
    # orders without lines, lines without order, an order that stands twice
    when = datetime.datetime(2024, 1, 2)
    orders = spark.createDataFrame([(1, when), (2, when), (2, when), (3, when)], "o_orderkey long, o_orderdate timestamp_ntz")
    kinds = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    line = lambda k, n, flag: (k, n, 1, 1, 2.0, 3.0, 0.0, 0.0, flag, "F", when)
    lines = spark.createDataFrame([line(1, 1, "R"), line(1, 2, "N"), line(2, 1, "N"), line(9, 1, "N")], kinds)
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = Tables(spark, str(tmp_path)).nodes
    assert rows(got.filter("num < 2").select("vo_id", "num", "num_cap", "rm_entity")) == sorted(
        [(k, 0, cap, "COMPOSITION") for k, cap in ((1, 17), (2, 8), (2, 8), (3, 1))] + [(k, 1, 1, "EVENT_CONTEXT") for k in (1, 2, 2, 3)], key=repr
    )
    assert rows(got.filter("rm_entity = 'OBSERVATION'").select("vo_id", "num", "num_cap")) == [(1, 11, 17), (1, 2, 10), (2, 2, 8), (9, 2, 8)]
    assert got.count() == 2 * 4 + 9 + 3 * 7
