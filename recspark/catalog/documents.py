"""Documents to nodes and back, tree numbers, data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark import model
from recspark.catalog.base import frame, query
from recspark.operators import contains as c
from recspark.operators import flatten as fl
from recspark.operators import quality as q
from recspark.operators.paths import subtree_nodes
from recspark.plans.stable import shared_dir
from recspark.sources.store import read_nodes, write_nodes

# ---------------------------------------------------------------------------------------------
# a text becomes a document: one observation per line, one element per sentence
# ---------------------------------------------------------------------------------------------


def documents(t):
    sentence = lambda s, k: F.struct(
        F.lit("ELEMENT").alias("_type"), F.lit("at0001").alias("archetype_node_id"),
        F.struct(F.concat(F.lit("s"), k).alias("value")).alias("name"),
        F.struct(F.lit("DV_TEXT").alias("_type"), s.alias("value")).alias("value"),
    )
    line = lambda x: F.struct(
        F.lit("OBSERVATION").alias("_type"), F.lit("openEHR-EHR-OBSERVATION.line.v1").alias("archetype_node_id"),
        F.struct(F.col("lang").alias("value")).alias("name"),
        F.struct(
            F.lit("ITEM_LIST").alias("_type"), F.lit("at0000").alias("archetype_node_id"),
            F.transform(F.split(x, "[.] ", -1), sentence).alias("items"),
        ).alias("protocol"),
    )
    doc = F.struct(
        F.lit("COMPOSITION").alias("_type"), F.lit("openEHR-EHR-COMPOSITION.text.v1").alias("archetype_node_id"),
        F.struct(F.col("source").alias("value")).alias("name"), F.transform(F.split("text", "\n", -1), line).alias("content"),
    )
    return _spread(t, t.table("documents").select("doc_id", "lang", "source", "text")).select("doc_id", doc.alias("doc"))


def _spread(t, rows):
    """A few files with one row group each would be flattened by as many tasks."""
    cores = t.spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if not rows.isStreaming and len(rows.inputFiles()) < cores else rows


frame(
    "f_doc_lines",
    """SELECT *, CAST(1 + sum(2 + s) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 2 - s AS INT) AS base
       FROM (SELECT doc_id, lang, CAST(unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS INT) AS line_no,
                    unnest(string_split(text, chr(10))) AS line, CAST(len(string_split(unnest(string_split(text, chr(10))), '. ')) AS INT) AS s FROM documents)""",
)
frame(
    "f_doc_nodes",
    """SELECT d.doc_id, 0 AS num, (SELECT CAST(sum(2 + s) AS INT) FROM f_doc_lines l WHERE l.doc_id = d.doc_id) AS num_cap, 0 AS parent_num,
              CAST(NULL AS INT) AS citem_num, 'COMPOSITION' AS rm_entity, '.text.v1' AS entity_concept, source AS entity_name,
              CAST(NULL AS VARCHAR) AS entity_attribute, '' AS entity_idx, 0 AS entity_idx_len, CAST(NULL AS VARCHAR) AS value_str FROM documents d
       UNION ALL SELECT doc_id, base, base + 1 + s, 0, 0, 'OBSERVATION', '.line.v1', lang, 'content', 'content' || line_no || '.', 1, NULL FROM f_doc_lines
       UNION ALL SELECT doc_id, base + 1, base + 1 + s, base, base, 'ITEM_LIST', 'at0000', NULL, 'protocol', 'content' || line_no || '.protocol.', 2, NULL FROM f_doc_lines
       UNION ALL SELECT doc_id, base + 2 + k, base + 2 + k, base + 1, base, 'ELEMENT', 'at0001', 's' || k, 'items',
              'content' || line_no || '.protocol.items' || k || '.', 3, sentence
       FROM (SELECT doc_id, base, line_no, CAST(unnest(generate_series(0, s - 1)) AS INT) AS k, unnest(string_split(line, '. ')) AS sentence FROM f_doc_lines)""",
)

_TREE = "doc_id, num, num_cap, parent_num, citem_num, rm_entity, entity_concept, entity_name, entity_attribute, entity_idx, entity_idx_len"
_COLUMNS = [x.strip() for x in _TREE.split(",")]


def doc_nodes(t, with_data=True):
    return fl.flatten_documents(documents(t), "doc_id", "doc", with_data=with_data)


@query("A8_flatten_documents", f"SELECT {_TREE}, value_str FROM f_doc_nodes")
def _(t):
    nodes = fl.with_value_columns(doc_nodes(t))
    return nodes.select(*_COLUMNS, "value_str")


frame(
    "f_folder_refs",
    """SELECT event_id, CASE WHEN value < 10 THEN event_type ELSE substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 9, 4) || '-'
         || substr(md5(CAST(event_id AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 21, 12) END AS item_id FROM events""",
)


def _refs(t):
    h = F.md5(F.col("event_id").cast("string"))
    uuid = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return t.table("events").select("event_id", F.when(F.col("value") < 10, F.col("event_type")).otherwise(uuid).alias("item_id"))


def _folder_docs(t):
    item = F.struct(F.struct(F.col("item_id").alias("value")).alias("id"))
    doc = F.struct(F.lit("FOLDER").alias("_type"), F.array(item, item).alias("items"))
    return _refs(t).select("event_id", F.to_variant_object(doc).alias("data"))


@query(
    "A10_extract_item_ids",
    """SELECT event_id, item_id || ',' || item_id AS items, '{"_type":"FOLDER"}' AS data FROM f_folder_refs
       WHERE regexp_matches(item_id, '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$')""",
)
def _(t):
    good, _ = fl.extract_item_ids(_folder_docs(t))
    return good.select("event_id", F.array_join("item_uuids", ",").alias("items"), F.to_json("data").alias("data"))


@query(
    "A10_item_id_rejects",
    """SELECT event_id FROM f_folder_refs
       WHERE NOT regexp_matches(item_id, '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$')""",
)
def _(t):
    return fl.extract_item_ids(_folder_docs(t))[1].select("event_id")


@query(
    "A11_reconstruct_documents",
    """SELECT doc_id, source AS name, CAST(len(string_split(text, chr(10))) AS INT) AS lines, text FROM documents""",
)
def _(t):
    # every sentence comes back in its place: the text of the rebuilt document is the text it was made from
    docs = fl.reconstruct_documents(doc_nodes(t), ["doc_id"])
    lines = F.try_variant_get("doc", "$.content", "array<struct<protocol: struct<items: array<struct<value: struct<value: string>>>>>>")
    text = F.array_join(F.transform(lines, lambda x: F.array_join(x["protocol"]["items"]["value"]["value"], ". ")), "\n")
    return docs.select("doc_id", F.try_variant_get("doc", "$.name.value", "string").alias("name"), F.size(lines).alias("lines"), text.alias("text"))


@query(
    "A11_reconstruct_subtrees",
    """SELECT doc_id, base AS o_num, '{"_type":"OBSERVATION","lines":1,"items":' || s || '}' AS shown FROM f_doc_lines""",
)
def _(t):
    nodes = doc_nodes(t)
    tops = c.nodes_as(doc_nodes(t, with_data=False), "o", "OBSERVATION", columns=["entity_idx"], key=["doc_id"])
    rows = subtree_nodes(tops, "o", nodes, key=["doc_id"], columns=["entity_idx", "data"])
    rows = rows.select("doc_id", "o_num", "o_entity_idx", F.col("n_num").alias("num"), F.col("n_entity_idx").alias("entity_idx"), F.col("n_data").alias("data"))
    docs = fl.reconstruct_documents(rows, ["doc_id", "o_num"], root_idx="o_entity_idx")
    items = F.size(F.try_variant_get("doc", "$.protocol.items", "array<variant>"))
    shown = F.concat(F.lit('{"_type":"'), F.try_variant_get("doc", "$._type", "string"), F.lit('","lines":1,"items":'), items, F.lit("}"))
    return docs.select("doc_id", "o_num", shown.alias("shown"))


def _order_documents(t):
    """An action per order; the objects between it and the trees with its status and priority have no row of their own."""
    element = lambda v: F.struct(F.lit("ELEMENT").alias("_type"), F.struct(F.col(v).alias("value")).alias("value"))
    tree = lambda v: F.struct(F.lit("ITEM_TREE").alias("_type"), F.array(element(v), element(v)).alias("items"))
    details = F.struct(F.lit("INSTRUCTION_DETAILS").alias("_type"), F.col("o_orderkey").alias("activity_id"), tree("o_orderstatus").alias("wf_details"))
    origin = F.struct(F.lit("FEEDER_AUDIT_DETAILS").alias("_type"), tree("o_orderpriority").alias("other_details"), F.col("o_custkey").alias("system_id"))
    audit = F.struct(F.lit("FEEDER_AUDIT").alias("_type"), origin.alias("originating_system_audit"))
    action = F.struct(F.lit("ACTION").alias("_type"), audit.alias("feeder_audit"), details.alias("instruction_details"))
    doc = F.struct(F.lit("COMPOSITION").alias("_type"), F.array(action).alias("content"))
    orders = t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return _spread(t, orders).select("o_orderkey", doc.alias("doc"))


frame(
    "f_order_docs",
    """SELECT o_orderkey, '{"_type":"ACTION","feeder_audit":{"_type":"FEEDER_AUDIT","originating_system_audit":{"_type":"FEEDER_AUDIT_DETAILS",'
           || '"other_details":{"_type":"ITEM_TREE","items":[' || p || ',' || p || ']},"system_id":' || o_custkey || '}},"instruction_details":{"_type":"INSTRUCTION_DETAILS",'
           || '"activity_id":' || o_orderkey || ',"wf_details":{"_type":"ITEM_TREE","items":[' || s || ',' || s || ']}}}' AS action
       FROM (SELECT o_orderkey, o_custkey, '{"_type":"ELEMENT","value":{"value":"' || o_orderpriority || '"}}' AS p, '{"_type":"ELEMENT","value":{"value":"' || o_orderstatus || '"}}' AS s FROM orders)""",
)


@query("A11_reconstruct_detached", """SELECT o_orderkey, '{"_type":"COMPOSITION","content":[' || action || ']}' AS doc FROM f_order_docs""")
def _(t):
    nodes = fl.flatten_documents(_order_documents(t), "o_orderkey", "doc")
    return fl.reconstruct_documents(nodes, ["o_orderkey"]).select("o_orderkey", F.to_json("doc").alias("doc"))


@query("B9_subtree_detached", "SELECT o_orderkey, 1 AS a_num, action AS doc FROM f_order_docs")
def _(t):
    docs = _order_documents(t)
    nodes = fl.flatten_documents(docs, "o_orderkey", "doc")
    actions = c.nodes_as(fl.flatten_documents(docs, "o_orderkey", "doc", with_data=False), "a", "ACTION", columns=["entity_idx"], key=["o_orderkey"])
    return fl.subtree_objects(actions, "a", nodes, key=["o_orderkey"]).select("o_orderkey", "a_num", F.to_json("doc").alias("doc"))


@query(
    "B9_subtree_document",
    """SELECT doc_id, base AS o_num, '{"_type":"OBSERVATION","archetype_node_id":"openEHR-EHR-OBSERVATION.line.v1","name":{"value":' || to_json(lang) || '},'
           || '"protocol":{"_type":"ITEM_LIST","archetype_node_id":"at0000","items":[' || list_aggregate(list_transform(string_split(line, '. '), lambda x, k:
           '{"_type":"ELEMENT","archetype_node_id":"at0001","name":{"value":"s' || (k - 1) || '"},"value":{"_type":"DV_TEXT","value":' || to_json(x) || '}}'), 'string_agg', ',') || ']}}' AS doc
       FROM f_doc_lines""",
)
def _(t):
    nodes = doc_nodes(t)
    tops = c.nodes_as(doc_nodes(t, with_data=False), "o", "OBSERVATION", columns=["entity_idx"], key=["doc_id"])
    return fl.subtree_objects(tops, "o", nodes, key=["doc_id"]).select("doc_id", "o_num", F.to_json("doc").alias("doc"))


@query("A12_write_nodes", "SELECT vo_id, num, num_cap, rm_entity, magnitude FROM f_nodes")
def _(t):
    # written to and read back from the shared folder
    path = f"{shared_dir(t.spark)}/nodes-{t.spark.sparkContext.applicationId}-{t.sf_dir.strip('/').replace('/', '-')}"
    write_nodes(t.nodes, path, buckets=8)
    return read_nodes(t.spark, path).select("vo_id", "num", "num_cap", "rm_entity", "magnitude")


@query("E13_number_parents", "SELECT vo_id, num, parent_num FROM f_nodes")
def _(t):
    return fl.compute_parent_num(t.nodes, blocks=t.blocks).select("vo_id", "num", "parent_num")


@query("E14_number_caps", "SELECT vo_id, num, num_cap FROM f_nodes")
def _(t):
    return fl.compute_num_cap(t.nodes, blocks=t.blocks).select("vo_id", "num", "num_cap")


@query("F5_preorder_number", "SELECT doc_id, entity_idx, num FROM f_doc_nodes")
def _(t):
    # paths of positions: the root is empty, an attribute counts 0, an element counts its index
    steps = F.filter(F.split("entity_idx", "[.]"), lambda s: s != "")
    path = F.transform(steps, lambda s: F.coalesce(F.nullif(F.regexp_extract(s, "([0-9]+)$", 1), F.lit("")).try_cast("int"), F.lit(0)))
    rows = doc_nodes(t).select("doc_id", "entity_idx", path.alias("path"))
    return fl.number_preorder(rows, ["doc_id"], "path").select("doc_id", "entity_idx", "num")


# ---------------------------------------------------------------------------------------------
# data checks
# ---------------------------------------------------------------------------------------------

_MANDATORY = {
    "name": "nullif(source, 'src3')", "archetype_node_id": "'x'", "language": "nullif(lang, 'es')", "category": "'event'",
    "composer": "nullif(source, 'src7')", "archetype_details": "nullif(lang, 'fr')", "template_id": "nullif(lang, 'fr')",
}


@query(
    "L1_check_mandatory",
    " UNION ALL ".join(
        f"SELECT doc_id, '/{a}' AS path, 'mandatory' AS rule, 'missing mandatory attribute: {a}' AS message FROM documents WHERE {e} IS NULL"
        for a, e in _MANDATORY.items()
    ),
)
def _(t):
    docs = t.table("documents").select("doc_id", *[F.expr(e).alias(a) for a, e in _MANDATORY.items()])
    return q.check_mandatory(docs, ["doc_id"])


@query(
    "L2_check_namespace",
    """SELECT ehr_id, '/subject/external_ref/namespace' AS path, 'pattern' AS rule, 'invalid namespace: ' || namespace AS message
       FROM f_status WHERE NOT regexp_matches(namespace, '^[a-zA-Z][a-zA-Z0-9_:/&+?-]*$')""",
)
def _(t):
    return q.check_namespace(t.status)


@query(
    "L3_check_contribution",
    """SELECT contribution_id, '/versions' AS path, 'cardinality' AS rule, 'versions must not be empty' AS message FROM f_contribution
       WHERE contribution_id NOT IN (SELECT contribution_id FROM f_changes WHERE change_type <> 'modification')
       UNION ALL SELECT contribution_id, '/audit/time_committed', 'must be null', 'time_committed must not be set' FROM f_changes WHERE change_type = 'amendment'
       UNION ALL SELECT contribution_id, '/version/contribution', 'must be null', 'contribution must not be set' FROM f_changes WHERE change_type = 'deleted'""",
)
def _(t):
    kind = F.col("change_type")
    changes = t.changes.filter("change_type <> 'modification'").withColumns(
        {
            "client_time_committed": F.when(kind == "amendment", F.col("committed_at")),
            "client_contribution": F.when(kind == "deleted", F.col("contribution_id")),
        }
    )
    return q.check_contribution(t.contribution, changes)


@query(
    "L4_check_change_rules",
    """SELECT change_id, '/preceding_version_uid' AS path, 'change rule' AS rule, CASE WHEN change_type = 'creation' THEN 'creation with preceding version' ELSE 'preceding version missing' END AS message
       FROM (SELECT audit_id AS change_id, change_type, sys_version - 1 AS preceding FROM (SELECT v.audit_id, v.sys_version, a.change_type FROM f_versions v JOIN f_audit a ON a.audit_id = v.audit_id))
       WHERE (change_type = 'creation' AND preceding > 0) OR (change_type <> 'creation' AND preceding = 0)""",
)
def _(t):
    claimed = t.audit.select(F.col("audit_id").alias("change_id"), "change_type")
    return q.check_change_rules(t.changes.drop("change_type").join(claimed, "change_id"))


_TAGS = """SELECT id, ehr_id, target_vo_id, target_type, CASE WHEN key = 'toxic' AND value = '1' THEN 'to xic' WHEN id % 11 = 0 THEN ' ' ELSE key END AS key,
 CASE WHEN id % 7 = 0 THEN '  ' ELSE value END AS value, CASE WHEN target_path IS NULL THEN '/' WHEN id % 5 = 0 THEN 'content' ELSE target_path END AS target_path FROM f_item_tag"""
_TARGETS = "SELECT doc_id AS vo_id, doc_id % 49 AS ehr_id, CASE lang WHEN 'es' THEN 'FOLDER' ELSE 'COMPOSITION' END AS kind FROM documents"


@query(
    "L5_check_tag",
    f"""WITH t AS ({_TAGS}), g AS ({_TARGETS}), j AS (SELECT t.*, g.vo_id, g.ehr_id AS owner, g.kind FROM t LEFT JOIN g ON g.vo_id = t.target_vo_id)
        SELECT id, '/key' AS path, 'not blank' AS rule, 'key must not be blank' AS message FROM j WHERE trim(key) = ''
        UNION ALL SELECT id, '/key', 'characters', 'invalid characters in key: ' || key FROM j WHERE trim(key) <> '' AND NOT regexp_matches(key, '^[a-zA-Z0-9/_:-]*$')
        UNION ALL SELECT id, '/value', 'not blank', 'value must not be blank' FROM j WHERE trim(value) = ''
        UNION ALL SELECT id, '/target_path', 'starts at root', 'path does not start at root: ' || target_path FROM j WHERE NOT starts_with(target_path, '/')
        UNION ALL SELECT id, '/target_path', 'not the root', 'path must not be the root itself' FROM j WHERE target_path = '/'
        UNION ALL SELECT id, '/target', 'exists', 'target does not exist' FROM j WHERE vo_id IS NULL
        UNION ALL SELECT id, '/owner_id', 'owner', 'owner does not match the target' FROM j WHERE owner <> ehr_id
        UNION ALL SELECT id, '/target_type', 'type', 'type does not match the target' FROM j WHERE kind <> target_type""",
)
def _(t):
    tags = t.item_tag.selectExpr(
        "id", "ehr_id", "target_vo_id", "target_type",
        "CASE WHEN key = 'toxic' AND value = '1' THEN 'to xic' WHEN id % 11 = 0 THEN ' ' ELSE key END AS key",
        "CASE WHEN id % 7 = 0 THEN '  ' ELSE value END AS value",
        "CASE WHEN target_path IS NULL THEN '/' WHEN id % 5 = 0 THEN 'content' ELSE target_path END AS target_path",
    )
    targets = t.table("documents").selectExpr(
        "doc_id AS vo_id", "doc_id % 49 AS ehr_id", "CASE lang WHEN 'es' THEN 'FOLDER' ELSE 'COMPOSITION' END AS kind"
    )
    return q.check_tag(tags, targets)


# value sets: languages seen in the documents (German left out), and sources per language
frame(
    "f_value_sets",
    """SELECT DISTINCT 'vs:lang' AS uri, 'iso639' AS system, lang AS code, upper(lang) AS display FROM documents WHERE lang <> 'de'
       UNION ALL SELECT DISTINCT 'vs:source', lang, source, source || ' ' || lang FROM documents""",
)
frame(
    "f_coded",
    """SELECT doc_id, 0 AS field, CASE WHEN source = 'src4' THEN NULL ELSE 'vs:lang' END AS uri, CASE WHEN source = 'src5' THEN 'iso3166' ELSE 'iso639' END AS system, lang AS code FROM documents
       UNION ALL SELECT doc_id, 1, 'vs:source', 'fr', source FROM documents""",
)


def _value_sets(t):
    d = t.table("documents")
    langs = d.filter("lang <> 'de'").selectExpr("'vs:lang' AS uri", "'iso639' AS system", "lang AS code", "upper(lang) AS display").distinct()
    sources = d.selectExpr("'vs:source' AS uri", "lang AS system", "source AS code", "concat(source, ' ', lang) AS display").distinct()
    return langs.unionByName(sources)


def _coded(t):
    d = t.table("documents")
    lang = d.selectExpr(
        "doc_id", "0 AS field", "CASE WHEN source = 'src4' THEN NULL ELSE 'vs:lang' END AS uri",
        "CASE WHEN source = 'src5' THEN 'iso3166' ELSE 'iso639' END AS system", "lang AS code",
    )
    return lang.unionByName(d.selectExpr("doc_id", "1 AS field", "'vs:source' AS uri", "'fr' AS system", "source AS code"))


@query(
    "L6_check_codes_value_set",
    """WITH e AS (SELECT uri, code, count(*) AS n, min(system) AS system FROM f_value_sets GROUP BY uri, code)
       SELECT doc_id, field, '/' AS path, 'url' AS rule, 'missing value-set url' AS message FROM f_coded WHERE uri IS NULL
       UNION ALL SELECT doc_id, field, '/code_string', 'code', 'the value ' || c.code || ' does not match any option from value set ' || c.uri
         FROM f_coded c LEFT JOIN e ON e.uri = c.uri AND e.code = c.code WHERE c.uri IS NOT NULL AND e.n IS NULL
       UNION ALL SELECT doc_id, field, '/terminology_id', 'system', 'the terminology ' || c.system || ' must be ' || e.system
         FROM f_coded c JOIN e ON e.uri = c.uri AND e.code = c.code WHERE e.n = 1 AND e.system <> c.system""",
)
def _(t):
    return q.check_codes(_coded(t), _value_sets(t), "value_set", ["doc_id", "field"])


@query(
    "L6_check_codes_code_system",
    """SELECT doc_id, '/terminology_id' AS path, 'system' AS rule, 'the terminology ' || source || ' must be src1' AS message FROM documents WHERE source <> 'src1'
       UNION ALL SELECT doc_id, '/code_string', 'code', 'unknown code ' || lang FROM documents
         WHERE source = 'src1' AND lang NOT IN (SELECT lang FROM documents WHERE source = 'src2')""",
)
def _(t):
    # the languages of one source are the codes of a system named after another
    codes = t.table("documents").filter("source = 'src2'").selectExpr("'src1' AS system", "lang AS code").distinct()
    values = t.table("documents").selectExpr("doc_id", "'src1' AS uri", "source AS system", "lang AS code")
    return q.check_codes(values, codes, "code_system", ["doc_id"])


@query("L7_expand_value_set", "SELECT system, code, display FROM f_value_sets WHERE uri = 'vs:source'")
def _(t):
    return q.expand_value_set(_value_sets(t), "vs:source")


def _mistyped(t):
    """Nodes with wrong types and numbers at the lines of returned goods."""
    status = (F.col("entity_name") == "status") & (F.col("value_str") == "F")
    return t.nodes.withColumns(
        {
            "rm_entity": F.when(status, "POINT_EVENT").otherwise(F.col("rm_entity")),
            "num_cap": F.when(status, F.col("num_cap") + 1).otherwise(F.col("num_cap")),
        }
    )


@query(
    "L8_check_structure",
    """SELECT vo_id, num, '/' AS path, 'type' AS rule, 'not allowed: CLUSTER>POINT_EVENT' AS message FROM f_nodes WHERE entity_name = 'status' AND value_str = 'F'""",
)
def _(t):
    return q.check_structure(_mistyped(t))


@query(
    "L9_check_tree",
    """SELECT n.vo_id, n.num, '/' AS path, 'nesting' AS rule, 'not inside the parent''s interval' AS message
       FROM f_nodes n WHERE n.entity_name = 'status' AND n.value_str = 'F'""",
)
def _(t):
    return q.check_tree(_mistyped(t))


@query(
    "L10_check_object_identity",
    """SELECT DISTINCT v.ehr_id AS owner, v.vo_id, '/' AS path, 'identity' AS rule, 'inconsistent status found' AS message FROM f_versions v
       JOIN (SELECT ehr_id FROM f_versions GROUP BY ehr_id HAVING count(DISTINCT vo_id) > 1) w ON w.ehr_id = v.ehr_id
       UNION ALL SELECT DISTINCT v.ehr_id, v.vo_id, '/', 'identity', 'inconsistent folder found' FROM f_comp_version v
       JOIN (SELECT ehr_id FROM f_comp_version GROUP BY ehr_id HAVING count(DISTINCT vo_id) > 1) w ON w.ehr_id = v.ehr_id""",
)
def _(t):
    return q.check_object_identity({"status": t.versions, "folder": t.comp_version})


@query(
    "L11_check_periods",
    """SELECT vo_id, sys_version - 1 AS sys_version, '/sys_period_lower' AS path, 'tombstone' AS rule, 'tombstone does not start at the predecessor''s end' AS message
       FROM f_versions WHERE sys_deleted
       UNION ALL SELECT vo_id, sys_version, '/sys_period_upper', 'order', 'end is not after start' FROM f_versions
       WHERE sys_deleted AND sys_period_upper <= sys_period_lower + INTERVAL 9 HOURS""",
)
def _(t):
    shifted = F.when(F.col("sys_deleted"), F.col("sys_period_lower") + F.expr("INTERVAL 9 HOURS")).otherwise(F.col("sys_period_lower"))
    return q.check_periods(t.versions.withColumn("sys_period_lower", shifted))


@query(
    "L12_check_folder_items",
    """SELECT item_id, '/items' AS path, 'uuid' AS rule, 'not a uuid: ' || item_id AS message FROM f_folder_refs
       WHERE NOT regexp_matches(item_id, '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$')""",
)
def _(t):
    return q.check_folder_items(_refs(t).select("item_id"))


_CONSTRAINTS = [
    (".order.v1", "content", ".line_item.v1", 1, 4),
    ("at0003", "items", "at0005", 1, 1),
    ("at0003", "items", ".return_details.v1", 1, None),
]


def _constraint_rows() -> str:
    def text(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))

    return ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in _CONSTRAINTS)


@query(
    "L13_check_required_cardinality",
    f"""WITH c AS (SELECT * FROM (VALUES {_constraint_rows()}) AS v(parent_concept, entity_attribute, entity_concept, min_occ, max_occ)),
        n AS (SELECT p.vo_id, p.num, c.entity_attribute, c.entity_concept, min_occ, max_occ, count(k.num) AS n
              FROM f_nodes p JOIN c ON c.parent_concept = p.entity_concept
              LEFT JOIN f_nodes k ON k.vo_id = p.vo_id AND k.num > 0 AND k.parent_num = p.num AND k.entity_attribute = c.entity_attribute AND k.entity_concept = c.entity_concept
              GROUP BY p.vo_id, p.num, c.entity_attribute, c.entity_concept, min_occ, max_occ)
        SELECT vo_id, num, '/' || entity_attribute || '[' || entity_concept || ']' AS path, 'min occurrences' AS rule, n || ' < ' || min_occ AS message FROM n WHERE n < min_occ
        UNION ALL SELECT vo_id, num, '/' || entity_attribute || '[' || entity_concept || ']', 'max occurrences', n || ' > ' || max_occ FROM n WHERE n > max_occ""",
)
def _(t):
    kind = "parent_concept string, entity_attribute string, entity_concept string, min_occ int, max_occ int"
    return q.check_cardinality(t.nodes, t.spark.createDataFrame(_CONSTRAINTS, kind))


assert set(_MANDATORY) == set(model.MANDATORY_ATTRIBUTES)
