"""Documents of a struct type are flattened without lookups, with the same rows as JSON text."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recspark.catalog import documents as cat  # noqa: F401
from recspark.catalog.base import BUILDERS
from recspark.operators import flatten as fl

_LEAF = "_type: string, archetype_node_id: string, v: double, tags: array<string>"
_DETAILS = "struct<_type: string, archetype_node_id: string, tree: struct<_type: string, a: date>>"
_AUDIT = "struct<_type: string, originating_system_audit: struct<_type: string, other_details: struct<_type: string, items: array<struct<_type: string, v: int>>>, system_id: string>>"
KIND = f"""struct<_type: string, archetype_node_id: string, name: struct<value: string>, feeder_audit: {_AUDIT},
  items: array<struct<{_LEAF}, items: array<struct<_type: string, archetype_node_id: string, details: {_DETAILS}>>>>,
  `od d'x`: struct<a: int, b: array<array<int>>>, protocol: struct<_type: string, archetype_node_id: string, d: decimal(10,2), w: timestamp_ntz>>"""
PREFIX = "openEHR-EHR-"


def node(kind, node_id="at1", **more):
    return {"_type": kind, "archetype_node_id": node_id, **more}


def top(**more):
    return {**node("COMPOSITION", f"{PREFIX}COMPOSITION.x.v1", name={"value": "n"}), **more}


def details(kind="INSTRUCTION_DETAILS", node_id=None, tree="ITEM_TREE"):
    return node(kind, node_id, tree={"_type": tree, "a": "2024-01-02"})


def audit(kind, count):
    tree = {"_type": "ITEM_TREE", "items": [{"_type": "ELEMENT", "v": x} for x in range(count)]}
    return {"_type": "FEEDER_AUDIT", "originating_system_audit": {"_type": kind, "other_details": tree, "system_id": "s"}}


ARCHETYPED = node("CLUSTER", f"{PREFIX}CLUSTER.k.v1", items=[
    node("ELEMENT"), node("ELEMENT", details=details()), node("ELEMENT", f"{PREFIX}X.y.v1", details=details(node_id=f"{PREFIX}Q.r.v1")),
    node("ACTION", details=details("ITEM_TREE")), node("ELEMENT", details=details(tree="DV")), node("ELEMENT", details=details("DV_X")),
])
DOCS = [
    top(), top(feeder_audit=audit("FEEDER_AUDIT_DETAILS", 3)), top(feeder_audit=audit("OTHER", 3)), top(feeder_audit=audit(None, 0)),
    {**top(feeder_audit=audit("FEEDER_AUDIT_DETAILS", 2)), "_type": "ELEMENT"}, top(items=[]), top(items=[None]), {"_type": "OTHER", "items": [node("CLUSTER")]},
    top(items=[node("CLUSTER", tags=["a"], v=1.5), ARCHETYPED], protocol=node("ITEM_LIST", f"{PREFIX}ITEM_LIST.p.v1", d="1.20", w="2024-01-01T00:00:00")),
    top(items=[{"_type": "DV_A"}, {"_type": None}], protocol=node("DV_TEXT", d="1.20")),
    top(items=[node("INSTRUCTION_DETAILS", items=[node("ELEMENT")]), node("CLUSTER", tags=[]), node("CLUSTER", items=[])]),
    {**top(items=[node("CLUSTER")] * 12, **{"od d'x": {"a": 1, "b": [[], [1, None]]}}), "archetype_node_id": "at0"},
]


def structs(spark, docs):
    made = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(len(docs), None)], "vo_id int, doc string")
    return made.select("vo_id", F.from_json("doc", KIND).alias("doc"))


def shown(nodes):
    return rows(nodes.withColumn("data", F.to_json("data")))


@pytest.mark.parametrize("order", [(), ("protocol", "items")])
def test_same_rows_as_without_a_type(spark, order):
    docs = structs(spark, DOCS)
    fixed = fl.flatten_documents(docs, "vo_id", "doc", attribute_order=order)
    general = fl.flatten_documents(docs.select("vo_id", F.to_variant_object("doc").alias("doc")), "vo_id", "doc", attribute_order=order)
    assert fixed.dtypes == general.dtypes
    assert shown(fixed) == shown(general) and fixed.count() > 50
    plan = fixed._jdf.queryExecution().optimizedPlan().toString()
    assert "try_variant_get" not in plan and "array_sort" not in plan


def test_mixed_arrays_are_an_error_where_data_is_read(spark):
    for other in ({"_type": "DV"}, None):
        nodes = fl.flatten_documents(structs(spark, [top(items=[node("CLUSTER"), other])]), "vo_id", "doc")
        assert rows(nodes.select("num", "num_cap")) == [(0, 1), (1, 1)]
        with pytest.raises(Exception, match="mixed"):
            nodes.collect()


def test_types_that_can_hide_members_are_looked_through(spark):
    for kind in ("struct<_type: string, items: map<string, string>>", "struct<_type: string, items: variant>", "struct<_type: int>", "struct<_type: string, A: int, a: int>"):
        assert not fl._fixed(spark.sql(f"SELECT cast(null as {kind}) AS x").schema["x"].dataType)
    docs = spark.sql("SELECT 1 AS vo_id, named_struct('_type', 'COMPOSITION', 'context', map('_type', 'EVENT_CONTEXT')) AS doc")
    assert rows(fl.flatten_documents(docs, "vo_id", "doc").select("num", "rm_entity")) == [(0, "COMPOSITION"), (1, "EVENT_CONTEXT")]


def test_rebuilding_compares_texts(spark):
    """Positions of several digits, attributes that begin alike, a copy below a node, members named like the synthetic one."""
    element = {"_type": "ELEMENT", "name": {"value": 'a "_type":"ELEMENT" b', "M": 1}, "value": {"_type": "DV_TEXT", "value": "x,}]"}}
    tree = {"_type": "ITEM_TREE", "items": [{**element, "n": i} for i in range(112)]}
    action = {"_type": "ACTION", "instruction_details": {"_type": "INSTRUCTION_DETAILS", "wf_details": tree}, "protocol": tree}
    doc = {"_type": "COMPOSITION", "content": [action, action], "contents": {"_type": "SECTION", "items": [{"_type": "EVALUATION"}]}}
    nodes = fl.flatten_documents(spark.createDataFrame([(1, json.dumps(doc))], "vo_id int, doc string"), "vo_id", "doc")
    back = fl.reconstruct_documents(nodes.repartition(5), ["vo_id"])
    assert json.loads(back.select(F.to_json("doc")).first()[0]) == doc
    assert "slice(" not in back._jdf.queryExecution().optimizedPlan().toString()
    cut = fl.reconstruct_documents(nodes.withColumn("entity_idx", F.expr("rtrim('.', entity_idx)")), ["vo_id"])
    assert json.loads(cut.select(F.to_json("doc")).first()[0]) == doc
    with pytest.raises(Exception, match="has no row"):
        fl.reconstruct_documents(nodes.filter("entity_idx <> 'content1.'"), ["vo_id"]).collect()


def test_positions_without_data(spark):
    docs = structs(spark, DOCS)
    for frame in (docs, docs.select("vo_id", F.to_json("doc").alias("doc"))):
        whole, slim = fl.flatten_documents(frame, "vo_id", "doc"), fl.flatten_documents(frame, "vo_id", "doc", with_data=False)
        assert rows(slim) == rows(whole.drop("data")) and slim.columns == whole.drop("data").columns
        assert "to_variant_object(map" not in slim._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["B9_subtree_detached", "B9_subtree_document", "A11_reconstruct_subtrees"])
def test_tops_of_subtrees_need_no_data(tables, name):
    plan = BUILDERS[name](tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("mixed in one array") == 1 and "try_variant_get(_doc" not in plan
