"""Containment, folders, paths and JSON values."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.catalog.base import frame, query
from recspark.catalog.scans import SYSTEM
from recspark.functions import json_values as j
from recspark.functions import predicates as p
from recspark.functions.ids import version_id
from recspark.functions.status import subject_paths
from recspark.operators import contains as c
from recspark.operators.aggregates import collect_nodes
from recspark.operators.folders import folder_at
from recspark.operators.order import limit_offset, order_by
from recspark.operators.paths import (
    path_filter,
    path_step,
    project_paths,
    same_parent,
    subtree_nodes,
    with_owner_status,
)
from recspark.operators.versions import with_data
from recspark.plans.path_tree import Path, Step

OBS = "openEHR-EHR-OBSERVATION.line_item.v1"
CLUSTER = "openEHR-EHR-CLUSTER.return_details.v1"

# ---------------------------------------------------------------------------------------------
# containment
# ---------------------------------------------------------------------------------------------


def _obs(t, alias="o", columns=()):
    return c.nodes_as(t.nodes, alias, "OBSERVATION", columns=columns)


def _el(t, alias, code, columns=()):
    return c.nodes_as(t.nodes, alias, "ELEMENT", where=F.col("entity_concept") == code, columns=columns)


@query(
    "D1_owner_contains",
    "SELECT e.ehr_id, vo_id, creation_date FROM f_ehr e JOIN f_comp_version c ON c.ehr_id = e.ehr_id",
)
def _(t):
    return c.contains_owner(t.ehr, t.comp_version).select("ehr_id", "vo_id", "creation_date")


_CONTAINS = """SELECT o.vo_id, o.num AS o_num, e.num AS e_num, e.magnitude AS e_magnitude
 FROM f_nodes o JOIN f_nodes e ON e.vo_id = o.vo_id AND e.num - o.num BETWEEN 1 AND o.num_cap - o.num
 WHERE o.rm_entity = 'OBSERVATION' AND e.rm_entity = 'ELEMENT' AND e.entity_concept = 'at0004'"""


@query("D2_contains", _CONTAINS)
def _(t):
    rows = c.contains(_obs(t), "o", _el(t, "e", "at0004", ["magnitude"]), "e", blocks=t.blocks)
    return rows.select("vo_id", "o_num", "e_num", "e_magnitude")


@query(
    "D3_contains_root",
    """SELECT v.vo_id, v.ehr_id, e.num AS e_num FROM f_comp_version v JOIN f_nodes e ON e.vo_id = v.vo_id
       WHERE e.rm_entity = 'CLUSTER'""",
)
def _(t):
    rows = c.contains_root(t.comp_version, c.nodes_as(t.nodes, "e", "CLUSTER"))
    return rows.select("vo_id", "ehr_id", "e_num")


@query(
    "D4_contains_archetype_local",
    """SELECT o.vo_id, o.num AS o_num, e.num AS e_num FROM f_nodes o JOIN f_nodes e ON e.vo_id = o.vo_id AND e.citem_num = o.num
       WHERE o.rm_entity = 'OBSERVATION' AND e.rm_entity = 'ELEMENT' AND e.entity_concept = 'at0004'""",
)
def _(t):
    return c.contains(_obs(t), "o", _el(t, "e", "at0004"), "e", local="archetype").select("vo_id", "o_num", "e_num")


@query(
    "D5_contains_node_local",
    """SELECT h.vo_id, h.num AS h_num, e.num AS e_num FROM f_nodes h JOIN f_nodes e
         ON e.vo_id = h.vo_id AND e.citem_num = h.citem_num AND e.num - h.num BETWEEN 1 AND h.num_cap - h.num
       WHERE h.rm_entity = 'POINT_EVENT' AND e.rm_entity = 'ELEMENT'""",
)
def _(t):
    events = c.nodes_as(t.nodes, "h", "POINT_EVENT")
    return c.contains(events, "h", c.nodes_as(t.nodes, "e", "ELEMENT"), "e", local="node", blocks=t.blocks).select("vo_id", "h_num", "e_num")


_A = "{b}.vo_id = o.vo_id AND {b}.num - o.num BETWEEN 1 AND o.num_cap - o.num"


@query(
    "D6_contains_all",
    f"""SELECT o.vo_id, o.num AS o_num, q.num AS q_num, s.num AS s_num FROM f_nodes o
        JOIN f_nodes q ON {_A.format(b='q')} JOIN f_nodes s ON {_A.format(b='s')}
        WHERE o.rm_entity = 'OBSERVATION' AND q.rm_entity = 'ELEMENT' AND q.entity_concept = 'at0005'
          AND s.rm_entity = 'CLUSTER'""",
)
def _(t):
    rows = c.contains_all(_obs(t), "o", [("q", _el(t, "q", "at0005")), ("s", c.nodes_as(t.nodes, "s", "CLUSTER"))], blocks=t.blocks)
    return rows.select("vo_id", "o_num", "q_num", "s_num")


_ANY = f"""SELECT o.vo_id, o.num AS o_num, k.num AS k_num, e.num AS e_num FROM f_nodes o
   LEFT JOIN (SELECT * FROM f_nodes WHERE rm_entity = 'CLUSTER') k ON {_A.format(b='k')}
   LEFT JOIN (SELECT * FROM f_nodes WHERE rm_entity = 'ELEMENT' AND entity_concept = 'at0006' AND magnitude > 729000) e ON {_A.format(b='e')}
   WHERE o.rm_entity = 'OBSERVATION' AND (k.num IS NOT NULL OR e.num IS NOT NULL)"""


def _any(t):
    late = (F.col("entity_concept") == "at0006") & (F.col("magnitude") > 729000)
    parts = [("k", c.nodes_as(t.nodes, "k", "CLUSTER")), ("e", c.nodes_as(t.nodes, "e", "ELEMENT", where=late))]
    return c.contains_any(_obs(t), "o", parts, blocks=t.blocks).select("vo_id", "o_num", "k_num", "e_num")


@query("D7_contains_any", _ANY)
def _(t):
    return _any(t)


@query(
    "D8_contains_any_chain",
    f"""WITH chain AS (
          SELECT k.vo_id, k.num, d.num AS d_num FROM f_nodes k JOIN f_nodes d
            ON d.vo_id = k.vo_id AND d.num - k.num BETWEEN 1 AND k.num_cap - k.num
          WHERE k.rm_entity = 'CLUSTER' AND d.rm_entity = 'ELEMENT' AND d.value_str = 'F')
        SELECT o.vo_id, o.num AS o_num, k.num AS k_num, k.d_num, e.num AS e_num FROM f_nodes o
        LEFT JOIN chain k ON {_A.format(b='k')}
        LEFT JOIN (SELECT * FROM f_nodes WHERE rm_entity = 'ELEMENT' AND entity_concept = 'at0005' AND magnitude > 50000) e ON {_A.format(b='e')}
        WHERE o.rm_entity = 'OBSERVATION' AND (k.num IS NOT NULL OR e.num IS NOT NULL)""",
)
def _(t):
    done = c.nodes_as(t.nodes, "d", "ELEMENT", where=F.col("value_str") == "F")
    dear = (F.col("entity_concept") == "at0005") & (F.col("magnitude") > 50000)
    parts = [c.chain(c.nodes_as(t.nodes, "k", "CLUSTER"), "k", done, "d", blocks=t.blocks), ("e", c.nodes_as(t.nodes, "e", "ELEMENT", where=dear))]
    return c.contains_any(_obs(t), "o", parts, blocks=t.blocks).select("vo_id", "o_num", "k_num", "d_num", "e_num")


@query(
    "D9_folder_contains_folder",
    """SELECT a.ehr_id, a.folder_idx, a.num AS a_num, b.num AS b_num, b.entity_name AS b_entity_name FROM f_folder_nodes a JOIN f_folder_nodes b
       ON b.ehr_id = a.ehr_id AND b.folder_idx = a.folder_idx AND b.num - a.num BETWEEN 1 AND a.num_cap - a.num""",
)
def _(t):
    a, b = c.folders_as(t.folder_nodes, "a"), c.folders_as(t.folder_nodes, "b", columns=["entity_name"])
    return c.contains(a, "a", b, "b", key=c.FOLDER).select("ehr_id", "folder_idx", "a_num", "b_num", "b_entity_name")


_FOLDER_ITEMS = """SELECT f.ehr_id, f.num AS f_num, i.item_vo_id FROM f_folder_nodes f JOIN f_folder_items i
   ON i.ehr_id = f.ehr_id AND i.folder_idx = f.folder_idx AND i.num BETWEEN f.num AND f.num_cap WHERE f.depth < 2"""


@query(
    "D10_folder_contains_composition",
    f"""SELECT x.ehr_id AS folder_ehr_id, f_num, vo_id, sys_version FROM ({_FOLDER_ITEMS}) x JOIN f_comp_version v ON v.vo_id = x.item_vo_id""",
)
def _(t):
    folders = c.folders_as(t.folder_nodes, "f", F.col("depth") < 2)
    rows = c.folder_contains(folders, "f", t.folder_items, t.comp_version)
    return rows.select("folder_ehr_id", "f_num", "vo_id", "sys_version")


@query("D11_version_to_data", "SELECT v.vo_id, v.ehr_id, n.num, n.magnitude FROM f_comp_version v JOIN f_nodes n ON n.vo_id = v.vo_id")
def _(t):
    return with_data(t.comp_version, t.nodes).select("vo_id", "ehr_id", "num", "magnitude")


@query(
    "D13_optional_path",
    """SELECT r.vo_id, o.num AS o_num FROM f_nodes r LEFT JOIN f_nodes o
         ON o.vo_id = r.vo_id AND o.parent_num = r.num AND o.num > 0 AND o.entity_attribute = 'content'
       WHERE r.num = 0""",
)
def _(t):
    roots = c.nodes_as(t.nodes, "r", "COMPOSITION")
    return path_step(roots, "r", t.nodes, "o", "content").select("vo_id", "o_num")


@query(
    "D19_not_contains",
    f"""SELECT o.vo_id, o.num AS o_num FROM f_nodes o WHERE o.rm_entity = 'OBSERVATION'
        AND NOT EXISTS (SELECT 1 FROM f_nodes k WHERE {_A.format(b='k')} AND k.rm_entity = 'CLUSTER')""",
)
def _(t):
    return c.not_contains(_obs(t), "o", c.nodes_as(t.nodes, "k", "CLUSTER"), "k", blocks=t.blocks).select("vo_id", "o_num")


# ---------------------------------------------------------------------------------------------
# folders
# ---------------------------------------------------------------------------------------------


@query(
    "N1_folder_by_path",
    """SELECT l.ehr_id, l.num, l.num_cap FROM f_folder_nodes y JOIN f_folder_nodes l
         ON l.ehr_id = y.ehr_id AND l.parent_num = y.num AND l.depth = 2
       WHERE y.depth = 1 AND y.entity_name = '1995' AND l.entity_name = 'F'""",
)
def _(t):
    return c.folder_by_path(t.folder_nodes, "/1995/F").select("ehr_id", "num", "num_cap")


@query(
    "N2_folder_at_time",
    """SELECT l.ehr_id, l.num, v.vo_id, v.sys_version FROM f_folder_nodes l
       JOIN f_versions v ON v.ehr_id = l.ehr_id
        AND v.sys_period_lower <= TIMESTAMP '2024-01-15 00:00:00'
        AND (v.sys_period_upper IS NULL OR v.sys_period_upper > TIMESTAMP '2024-01-15 00:00:00')
        AND NOT v.sys_deleted
       WHERE l.depth = 1 AND l.entity_name = '1996'""",
)
def _(t):
    # the event chains stand for the folder versions of an owner
    rows = folder_at(t.folder_nodes, t.versions, "2024-01-15 00:00:00", "/1996")
    return rows.select("ehr_id", "num", "vo_id", "sys_version")


@query("N3_folder_items", _FOLDER_ITEMS)
def _(t):
    folders = c.folders_as(t.folder_nodes, "f", F.col("depth") < 2)
    return c.folder_items(folders, "f", t.folder_items).select("ehr_id", "f_num", "item_vo_id")


@query(
    "N4_folder_name_paths",
    """SELECT a.ehr_id, a.num, CASE a.depth WHEN 0 THEN '/' WHEN 1 THEN '/' || a.entity_name
         ELSE '/' || y.entity_name || '/' || a.entity_name END AS path
       FROM f_folder_nodes a LEFT JOIN f_folder_nodes y ON a.depth = 2 AND y.ehr_id = a.ehr_id AND y.num = a.parent_num""",
)
def _(t):
    return c.folder_name_paths(t.folder_nodes).select("ehr_id", "num", "path")


# ---------------------------------------------------------------------------------------------
# paths
# ---------------------------------------------------------------------------------------------


@query(
    "B5_path_step",
    """SELECT h.vo_id, h.num AS h_num, e.num AS e_num FROM f_nodes h LEFT JOIN f_nodes e
         ON e.vo_id = h.vo_id AND e.parent_num = h.num AND e.entity_attribute = 'items' AND e.entity_concept = 'at0005'
       WHERE h.rm_entity IN ('ITEM_TREE', 'CLUSTER')""",
)
def _(t):
    holders = c.nodes_as(t.nodes, "h", "ITEM_TREE", "CLUSTER")
    return path_step(holders, "h", t.nodes, "e", "items", "at0005").select("vo_id", "h_num", "e_num")


_TO_TREE = (Step("data"), Step("events"), Step("data"))
_Q4_PATHS = [
    Path("quantity", (Step("content", OBS), *_TO_TREE, Step("items", "at0004")), "magnitude"),
    Path("price", (Step("content", OBS), *_TO_TREE, Step("items", "at0005")), "magnitude"),
    Path("status", (Step("content", OBS), *_TO_TREE, Step("items", CLUSTER), Step("items", "at0004")), "value_str"),
    Path("context", (Step("context"),), "value_str"),
]
_Q4 = """SELECT r.vo_id, l.quantity, l.price, l.status, x.value_str AS context
 FROM f_nodes r
 LEFT JOIN (SELECT o.vo_id, o.parent_num, q.magnitude AS quantity, pr.magnitude AS price, st.value_str AS status
   FROM f_nodes o
   JOIN f_nodes h ON h.vo_id = o.vo_id AND h.parent_num = o.num AND h.entity_attribute = 'data'
   JOIN f_nodes v ON v.vo_id = h.vo_id AND v.parent_num = h.num AND v.entity_attribute = 'events'
   JOIN f_nodes d ON d.vo_id = v.vo_id AND d.parent_num = v.num AND d.entity_attribute = 'data'
   LEFT JOIN f_nodes q ON q.vo_id = d.vo_id AND q.parent_num = d.num AND q.entity_attribute = 'items' AND q.entity_concept = 'at0004'
   LEFT JOIN f_nodes pr ON pr.vo_id = d.vo_id AND pr.parent_num = d.num AND pr.entity_attribute = 'items' AND pr.entity_concept = 'at0005'
   LEFT JOIN (SELECT k.vo_id, k.parent_num, s.value_str FROM f_nodes k JOIN f_nodes s
       ON s.vo_id = k.vo_id AND s.parent_num = k.num AND s.entity_attribute = 'items' AND s.entity_concept = 'at0004'
       WHERE k.rm_entity = 'CLUSTER') st ON st.vo_id = d.vo_id AND st.parent_num = d.num
   WHERE o.rm_entity = 'OBSERVATION' AND (q.num IS NOT NULL OR pr.num IS NOT NULL OR st.value_str IS NOT NULL)) l
   ON l.vo_id = r.vo_id AND l.parent_num = r.num
 LEFT JOIN f_nodes x ON x.vo_id = r.vo_id AND x.parent_num = 0 AND x.entity_attribute = 'context'
 WHERE r.num = 0"""


def _q4(t):
    roots = c.nodes_as(t.nodes, "r", "COMPOSITION")
    return project_paths(roots, "r", t.nodes, _Q4_PATHS, blocks=t.blocks).select("vo_id", "quantity", "price", "status", "context")


@query("B6_shared_prefix_paths", _Q4)
def _(t):
    return _q4(t)


@query(
    "B7_path_identity",
    """SELECT o.vo_id, o.num AS o_num, CASE WHEN e.entity_name = 'price' THEN e.magnitude END AS price, e.entity_name AS any_item
       FROM f_nodes o JOIN f_nodes h ON h.vo_id = o.vo_id AND h.parent_num = o.num AND h.entity_attribute = 'data'
       JOIN f_nodes v ON v.vo_id = h.vo_id AND v.parent_num = h.num AND v.entity_attribute = 'events'
       JOIN f_nodes d ON d.vo_id = v.vo_id AND d.parent_num = v.num AND d.entity_attribute = 'data'
       JOIN f_nodes e ON e.vo_id = d.vo_id AND e.parent_num = d.num AND e.entity_attribute = 'items'
       WHERE o.rm_entity = 'OBSERVATION'""",
)
def _(t):
    # one path names the item, the other does not: both read the same item, the name only filters a value
    paths = [
        Path("price", (*_TO_TREE, Step("items", name="price")), "magnitude"),
        Path("any_item", (*_TO_TREE, Step("items")), "entity_name"),
    ]
    return project_paths(_obs(t), "o", t.nodes, paths, blocks=t.blocks).select("vo_id", "o_num", "price", "any_item")


@query(
    "B8_path_filter",
    "SELECT vo_id, num, CASE WHEN dv_type = 'DV_QUANTITY' AND magnitude > 20000 THEN magnitude END AS dear FROM f_nodes WHERE rm_entity = 'ELEMENT'",
)
def _(t):
    cond = (F.col("dv_type") == "DV_QUANTITY") & (F.col("magnitude") > 20000)
    rows = t.nodes.filter("rm_entity = 'ELEMENT'")
    return rows.select("vo_id", "num", path_filter(F.col("magnitude"), cond).alias("dear"))


@query(
    "B10_anchor_skip_archetype",
    """SELECT o.vo_id, o.num AS o_num, e.num AS e_num, e.magnitude AS e_magnitude FROM f_nodes o LEFT JOIN f_nodes e
         ON e.vo_id = o.vo_id AND e.citem_num = o.num AND e.entity_attribute = 'items' AND e.entity_concept = 'at0005'
       WHERE o.rm_entity = 'OBSERVATION'""",
)
def _(t):
    rows = path_step(_obs(t), "o", t.nodes, "e", "items", "at0005", columns=["magnitude"], skip="archetype")
    return rows.select("vo_id", "o_num", "e_num", "e_magnitude")


@query(
    "B11_anchor_skip_node",
    """SELECT h.vo_id, h.num AS h_num, e.num AS e_num FROM f_nodes h LEFT JOIN f_nodes e
         ON e.vo_id = h.vo_id AND e.citem_num = h.citem_num AND e.num - h.num BETWEEN 1 AND h.num_cap - h.num
         AND e.entity_attribute = 'items' AND e.entity_concept = 'at0006'
       WHERE h.rm_entity = 'HISTORY'""",
)
def _(t):
    rows = path_step(c.nodes_as(t.nodes, "h", "HISTORY"), "h", t.nodes, "e", "items", "at0006", skip="node")
    return rows.select("vo_id", "h_num", "e_num")


@query(
    "B12_same_parent_siblings",
    """SELECT o.vo_id, o.num AS o_num, q.num AS q_num, k.num AS k_num FROM f_nodes o
       JOIN f_nodes q ON q.vo_id = o.vo_id AND q.citem_num = o.num AND q.entity_concept = 'at0004' AND q.entity_attribute = 'items'
       LEFT JOIN f_nodes k ON k.vo_id = o.vo_id AND k.citem_num = o.num AND k.rm_entity = 'CLUSTER' AND k.entity_attribute = 'items'
       WHERE o.rm_entity = 'OBSERVATION' AND coalesce(q.parent_num = k.parent_num, TRUE)""",
)
def _(t):
    rows = path_step(_obs(t), "o", t.nodes, "q", "items", "at0004", how="inner", skip="archetype")
    rows = path_step(rows, "o", t.nodes, "k", "items", CLUSTER, skip="archetype")
    return rows.filter(same_parent("q", "k")).select("vo_id", "o_num", "q_num", "k_num")


@query(
    "B13_owner_path_rewrite",
    "SELECT vo_id, v.ehr_id, subject_id, is_modifiable FROM f_comp_version v JOIN f_status s ON s.ehr_id = v.ehr_id",
)
def _(t):
    return with_owner_status(t.comp_version, t.status).select("vo_id", "ehr_id", "subject_id", "is_modifiable")


@query(
    "B9_subtree_object",
    """SELECT o.vo_id, o.num AS o_num, string_agg(n.num || '=' || coalesce(n.entity_concept, '-') || ':' || coalesce(CAST(n.magnitude AS VARCHAR), '-'), ',' ORDER BY n.num) AS subtree
       FROM f_nodes o JOIN f_nodes n ON n.vo_id = o.vo_id AND n.num BETWEEN o.num AND o.num_cap
       WHERE o.rm_entity = 'OBSERVATION' GROUP BY o.vo_id, o.num""",
)
def _(t):
    # an observation is one line with nine nodes at most
    rows = subtree_nodes(_obs(t), "o", t.nodes, columns=["entity_concept", "magnitude"], blocks=t.blocks)
    shown = F.concat(
        F.col("n_num"), F.lit("="), F.coalesce("n_entity_concept", F.lit("-")), F.lit(":"),
        F.coalesce(F.col("n_magnitude").cast("string"), F.lit("-")),
    )
    rows = rows.withColumn("shown", shown)
    objects = collect_nodes(rows, ["vo_id", "o_num"], "n_num", "shown", start=F.col("o_num"))
    return objects.select("vo_id", "o_num", F.array_join("nodes.shown", ",").alias("subtree"))


# ---------------------------------------------------------------------------------------------
# JSON values; a document becomes {"id": .., "lines": [{"no": .., "words": [..]}, ..]}
# ---------------------------------------------------------------------------------------------

frame(
    "f_text_lines",
    """SELECT doc_id, CAST(unnest(generate_series(1, len(string_split(text, chr(10))))) AS INT) - 1 AS line_no,
              unnest(string_split(text, chr(10))) AS line FROM documents""",
)


def _json_docs(t):
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.struct(i.alias("no"), F.when(line != "", F.split(line, " ", -1)).alias("words")),
    )
    doc = F.to_variant_object(F.struct(F.col("doc_id").alias("id"), F.col("lang"), lines.alias("lines")))
    return t.table("documents").select("doc_id", "lang", doc.alias("data"))


@query(
    "B1_json_path",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
              CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def _(t):
    d = t.table("events").select("event_id", j.parse(F.col("props")).alias("d"))
    return d.select(
        "event_id", j.json_path(F.col("d"), "k", "bigint").alias("k"), j.json_path(F.col("d"), "k", "string").alias("k_text"),
        j.json_path(F.col("d"), "a.b", "string").alias("missing"),
    )


@query("B2_json_path_multi", "SELECT doc_id, line_no AS pos, line_no AS no FROM f_text_lines")
def _(t):
    rows = j.json_path_multi(_json_docs(t), "data", "lines", "entry", position="pos")
    return rows.select("doc_id", "pos", j.json_path(F.col("entry"), "no", "int").alias("no"))


@query(
    "B3_json_path_multi_nested",
    """SELECT doc_id, line_no AS no, word FROM (
         SELECT doc_id, line_no, unnest(string_split(line, ' ')) AS word FROM f_text_lines WHERE line <> ''
         UNION ALL SELECT doc_id, line_no, NULL FROM f_text_lines WHERE line = '')""",
)
def _(t):
    lines = j.json_path_multi(_json_docs(t), "data", "lines", "entry")
    words = j.json_path_multi(lines.drop("data"), "entry", "words", "word")
    return words.select(
        "doc_id", j.json_path(F.col("entry"), "no", "int").alias("no"), j.json_path(F.col("word"), "", "string").alias("word")
    )


@query("B4_extract_then_explode", "SELECT l.doc_id, line_no AS no FROM f_text_lines l JOIN documents d ON d.doc_id = l.doc_id WHERE lang = 'de'")
def _(t):
    rows = j.json_path_multi(_json_docs(t), "data", "lines", "entry", condition=F.col("lang") == "de")
    return rows.select("doc_id", j.json_path(F.col("entry"), "no", "int").alias("no"))


@query(
    "D16_lateral_left",
    """SELECT o.o_orderkey AS vo_id, x.pos, x.part FROM orders o LEFT JOIN LATERAL (
         SELECT unnest([1, 2]) AS pos, unnest(string_split(o.o_orderpriority, '-')) AS part) x ON o.o_orderstatus <> 'F'""",
)
def _(t):
    # one sub-select per row; rows without elements stay
    parts = F.when(F.col("o_orderstatus") != "F", F.split("o_orderpriority", "-", -1))
    rows = t.table("orders").select(F.col("o_orderkey").alias("vo_id"), F.posexplode_outer(parts).alias("pos", "part"))
    return rows.select("vo_id", (F.col("pos") + 1).alias("pos"), "part")


@query("I1_json_get", "SELECT event_id, props::JSON ->> '$.k' AS k FROM events")
def _(t):
    got = j.json_get(j.parse(F.col("props")), "k")
    return t.table("events").select("event_id", F.to_json(got).alias("k"))


@query("I2_json_get_text", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _(t):
    return t.table("events").select("event_id", j.json_get_text(j.parse(F.col("props")), "k").alias("k"))


@query("I3_json_array_elements", "SELECT doc_id, count(*) AS n FROM f_text_lines GROUP BY doc_id")
def _(t):
    rows = _json_docs(t).select("doc_id", F.explode(j.json_array(F.col("data"), "lines")).alias("entry"))
    return rows.groupBy("doc_id").agg(F.count("entry").alias("n"))


@query("I4_json_set", """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"user":' || user_id || '}' AS doc FROM events""")
def _(t):
    doc = j.json_set(j.parse(F.col("props")), "user", F.col("user_id"))
    return t.table("events").select("event_id", F.to_json(doc).alias("doc"))


@query("I5_array_to_json", """SELECT event_id, '[' || user_id || ',' || event_id || ']' AS pair FROM events""")
def _(t):
    return t.table("events").select("event_id", j.array_to_json(F.array("user_id", "event_id")).alias("pair"))


@query("I6_json_extract_path_text", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _(t):
    return t.table("events").select("event_id", j.json_extract_path_text(F.col("props"), "k").alias("k"))


@query(
    "I7_scalar_to_json",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS num, '"' || event_type || '"' AS txt, CASE WHEN event_id > 5 THEN 'true' ELSE 'false' END AS flag,
              CAST(NULL AS VARCHAR) AS nothing FROM events""",
)
def _(t):
    return t.table("events").select(
        "event_id", j.scalar_to_json(F.col("user_id")).alias("num"), j.scalar_to_json(F.col("event_type")).alias("txt"),
        j.scalar_to_json(F.col("event_id") > 5).alias("flag"), j.scalar_to_json(F.lit(None).cast("string")).alias("nothing"),
    )


@query(
    "I15_cardinality_unnest",
    """SELECT doc_id, len(string_split(text, ' ')) AS words, word FROM (SELECT doc_id, text, unnest(string_split(text, ' ')) AS word FROM documents)""",
)
def _(t):
    rows = t.table("documents").select("doc_id", F.split("text", " ", -1).alias("w"))
    return rows.select("doc_id", F.size("w").cast("bigint").alias("words"), F.explode("w").alias("word"))


@query(
    "I25_subject_path",
    """SELECT ehr_id, subject_id, namespace, is_modifiable FROM f_status""",
)
def _(t):
    ref = F.struct(F.struct(F.col("subject_id").alias("value")).alias("id"), "namespace")
    doc = F.struct(F.struct(ref.alias("external_ref")).alias("subject"), "is_modifiable")
    rows = t.status.select("ehr_id", F.to_variant_object(doc).alias("data"))
    return rows.select("ehr_id", *[col.alias(n) for n, col in subject_paths(F.col("data")).items()])


# ---------------------------------------------------------------------------------------------
# query shapes
# ---------------------------------------------------------------------------------------------


@query("Q1_objects_of_owner", "SELECT vo_id || '::rec.example::' || sys_version AS uid, ehr_id FROM f_comp_version WHERE ehr_id = 7")
def _(t):
    rows = t.comp_version.filter(p.owner_predicate(F.col("ehr_id"), "=", "7"))
    return rows.select(version_id(F.col("vo_id"), SYSTEM, F.col("sys_version")).alias("uid"), "ehr_id")


@query(
    "Q2_deep_containment",
    """SELECT v.vo_id || '::rec.example::' || v.sys_version AS uid, v.ehr_id, e.entity_name AS element, e.magnitude
       FROM f_ehr x JOIN f_comp_version v ON v.ehr_id = x.ehr_id
       JOIN f_nodes o ON o.vo_id = v.vo_id AND o.rm_entity = 'OBSERVATION'
       JOIN f_nodes pe ON pe.vo_id = o.vo_id AND pe.num - o.num BETWEEN 1 AND o.num_cap - o.num AND pe.rm_entity = 'POINT_EVENT'
       JOIN f_nodes e ON e.vo_id = pe.vo_id AND e.num - pe.num BETWEEN 1 AND pe.num_cap - pe.num AND e.rm_entity = 'ELEMENT'
       WHERE e.entity_name LIKE 'pri%' OR e.entity_name LIKE 'shi_ped'
       ORDER BY v.vo_id DESC, v.sys_version DESC, e.num LIMIT 2""",
)
def _(t):
    name = F.col("entity_name")
    wanted = p.like_text(name, "pri*") | p.like_text(name, "shi?ped")
    rows = c.contains_owner(t.ehr, t.comp_version)
    rows = c.contains_root(rows, _obs(t))
    rows = c.contains(rows, "o", c.nodes_as(t.nodes, "pe", "POINT_EVENT"), "pe", blocks=t.blocks)
    rows = c.contains(rows, "pe", c.nodes_as(t.nodes, "e", "ELEMENT", where=wanted, columns=["entity_name", "magnitude"]), "e", blocks=t.blocks)
    rows = order_by(rows, [("vo_id", "desc"), ("sys_version", "desc"), ("e_num", "asc")])
    uid = version_id(F.col("vo_id"), SYSTEM, F.col("sys_version"))
    return limit_offset(rows, 2).select(
        uid.alias("uid"), "ehr_id", F.col("e_entity_name").alias("element"), F.col("e_magnitude").alias("magnitude")
    )


@query("Q4_paths_of_one_row", _Q4)
def _(t):
    return _q4(t)


@query("Q5_or_containment", _ANY)
def _(t):
    return _any(t)


@query(
    "Q6_folder_to_objects",
    """SELECT f.ehr_id AS folder_ehr_id, v.vo_id, v.template_name FROM f_folder_nodes f JOIN f_folder_items i
         ON i.ehr_id = f.ehr_id AND i.folder_idx = f.folder_idx AND i.num BETWEEN f.num AND f.num_cap
       JOIN f_comp_version v ON v.vo_id = i.item_vo_id WHERE f.depth = 1 AND f.entity_name = '1996'""",
)
def _(t):
    found = c.folder_by_path(t.folder_nodes, "/1996")
    folders = found.select(*c.FOLDER, F.col("num").alias("f_num"), F.col("num_cap").alias("f_num_cap"))
    rows = c.folder_contains(folders, "f", t.folder_items, t.comp_version)
    return rows.select("folder_ehr_id", "vo_id", "template_name")


@query(
    "D14_required_chain",
    """SELECT o.vo_id, o.num AS o_num, x.value_str AS status FROM f_nodes o LEFT JOIN (
         SELECT h.vo_id, h.parent_num, s.value_str FROM f_nodes h
         JOIN f_nodes v ON v.vo_id = h.vo_id AND v.parent_num = h.num AND v.entity_attribute = 'events'
         JOIN f_nodes d ON d.vo_id = v.vo_id AND d.parent_num = v.num AND d.entity_attribute = 'data'
         JOIN f_nodes k ON k.vo_id = d.vo_id AND k.parent_num = d.num AND k.entity_attribute = 'items' AND k.rm_entity = 'CLUSTER'
         JOIN f_nodes s ON s.vo_id = k.vo_id AND s.parent_num = k.num AND s.entity_attribute = 'items'
         WHERE h.entity_attribute = 'data' AND h.rm_entity = 'HISTORY') x ON x.vo_id = o.vo_id AND x.parent_num = o.num
       WHERE o.rm_entity = 'OBSERVATION'""",
)
def _(t):
    # the nodes on the way appear only together with the value at the end
    path = Path("status", (*_TO_TREE, Step("items", CLUSTER), Step("items")), "value_str")
    return project_paths(_obs(t), "o", t.nodes, [path], blocks=t.blocks).select("vo_id", "o_num", "status")


@query(
    "D15_fork",
    """SELECT d.vo_id, d.num AS d_num, x.returned, x.status FROM f_nodes d LEFT JOIN (
         SELECT k.vo_id, k.parent_num, s.entity_name AS returned, f.value_str AS status FROM f_nodes k
         LEFT JOIN f_nodes s ON s.vo_id = k.vo_id AND s.parent_num = k.num AND s.entity_attribute = 'items' AND s.entity_concept = 'at0009'
         LEFT JOIN f_nodes f ON f.vo_id = k.vo_id AND f.parent_num = k.num AND f.entity_attribute = 'items' AND f.entity_concept = 'at0004'
         WHERE k.entity_attribute = 'items' AND k.rm_entity = 'CLUSTER' AND (s.num IS NOT NULL OR f.num IS NOT NULL)) x
         ON x.vo_id = d.vo_id AND x.parent_num = d.num
       WHERE d.rm_entity = 'ITEM_TREE'""",
)
def _(t):
    # a node without a value of its own and with two children: present if either child is
    trees = c.nodes_as(t.nodes, "d", "ITEM_TREE")
    paths = [
        Path("returned", (Step("items", CLUSTER), Step("items", "at0009")), "entity_name"),
        Path("status", (Step("items", CLUSTER), Step("items", "at0004")), "value_str"),
    ]
    return project_paths(trees, "d", t.nodes, paths, blocks=t.blocks).select("vo_id", "d_num", "returned", "status")
