"""Scans, extracted columns and literal-typed predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from recspark.catalog.base import query
from recspark.functions import extracted as x
from recspark.functions import ids
from recspark.functions import predicates as p
from recspark.functions import values as v
from recspark.functions.times import iso_text
from recspark.operators.aggregates import agg_count
from recspark.operators.paths import constant_column, result_columns
from recspark.operators.versions import all_versions
from recspark.sources import scan

SYSTEM = "rec.example"

# ---------------------------------------------------------------------------------------------
# scans
# ---------------------------------------------------------------------------------------------


@query(
    "A1_scan_nodes",
    """SELECT vo_id, num, num_cap, rm_entity, entity_concept, magnitude FROM f_nodes
       WHERE rm_entity IN ('CLUSTER', 'ELEMENT') AND entity_attribute = 'items'""",
)
def _(t):
    rows = scan.scan_nodes(t.nodes, "composition", ["ITEM"], "items")
    return rows.select("vo_id", "num", "num_cap", "rm_entity", "entity_concept", "magnitude")


@query("A2_scan_roots", "SELECT vo_id, num_cap, entity_name FROM f_nodes WHERE num = 0")
def _(t):
    return scan.scan_roots(t.nodes).select("vo_id", "num_cap", "entity_name")


@query("A3_scan_versions", "SELECT vo_id, ehr_id, sys_version, sys_period_lower, template_name, root_concept FROM f_comp_version")
def _(t):
    return scan.scan_versions(t.comp_version)


@query("A4_scan_ehr", "SELECT ehr_id, creation_date FROM f_ehr")
def _(t):
    return scan.scan_ehr(t.ehr)


@query("A5_scan_audit", "SELECT audit_id, description, change_type FROM f_audit")
def _(t):
    return scan.scan_audit(t.audit)


@query(
    "A6_scan_history",
    """SELECT h.vo_id, h.sys_version, h.sys_deleted, n.num, n.value_num
       FROM f_history h JOIN (
         SELECT vo_id, sys_version, i AS num, CAST(CAST(audit_id AS DECIMAL(18,2)) * i AS DECIMAL(18,2)) AS value_num
         FROM f_versions CROSS JOIN (VALUES (0), (1), (2)) AS w(i)) n
       ON n.vo_id = h.vo_id AND n.sys_version = h.sys_version""",
)
def _(t):
    # three nodes per version
    nodes = t.versions.select("vo_id", "sys_version", "audit_id", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("num"))
    nodes = nodes.select("vo_id", "sys_version", "num", (F.col("audit_id").cast("decimal(15,2)") * F.col("num")).cast("decimal(18,2)").alias("value_num"))
    return scan.scan_history(t.version_history, nodes).select("vo_id", "sys_version", "sys_deleted", "num", "value_num")


@query(
    "A7_all_versions",
    "SELECT vo_id, sys_version, sys_period_lower, sys_period_upper, sys_deleted FROM f_versions",
)
def _(t):
    rows = all_versions(t.version_head, t.version_history)
    return rows.select("vo_id", "sys_version", "sys_period_lower", "sys_period_upper", "sys_deleted")


@query(
    "A9_add_magnitude",
    """SELECT event_id, dv_type, value_str, CAST(magnitude AS DECIMAL(38,9)) AS magnitude FROM (
         SELECT event_id, 'DV_DATE_TIME' AS dv_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS value_str,
                CAST(floor(epoch(ts)) AS BIGINT) + 62135596800 AS magnitude FROM events
         UNION ALL
         SELECT event_id, 'DV_DATE', strftime(ts, '%Y-%m-%d'), datediff('day', DATE '0001-01-01', CAST(ts AS DATE)) FROM events
         UNION ALL
         SELECT event_id, 'DV_TIME', strftime(ts, '%H:%M:%S'), hour(ts) * 3600 + minute(ts) * 60 + second(ts) FROM events
         UNION ALL
         SELECT event_id, 'DV_DURATION', 'P' || (user_id % 3) || 'Y' || (user_id % 5) || 'M' || day(ts) || 'DT' || hour(ts) || 'H' || minute(ts) || 'M',
                (user_id % 3) * 31556736 + (user_id % 5) * 2628288 + day(ts) * 86400 + hour(ts) * 3600 + minute(ts) * 60 FROM events
         UNION ALL
         SELECT event_id, 'DV_TEXT', event_type, NULL FROM events)""",
)
def _(t):
    e = t.table("events").select("event_id", "ts", "user_id", "event_type")
    duration = F.concat(
        F.lit("P"), F.col("user_id") % 3, F.lit("Y"), F.col("user_id") % 5, F.lit("M"), F.dayofmonth("ts"), F.lit("DT"),
        F.hour("ts"), F.lit("H"), F.minute("ts"), F.lit("M"),
    )
    texts = {
        "DV_DATE_TIME": F.concat(F.substring(iso_text(F.col("ts")), 1, 19), F.lit("."), F.rpad(F.regexp_extract(iso_text(F.col("ts")), r"[.](\d+)Z$", 1), 6, "0"), F.lit("Z")),
        "DV_DATE": F.substring(iso_text(F.col("ts")), 1, 10),
        "DV_TIME": F.substring(iso_text(F.col("ts")), 12, 8),
        "DV_DURATION": duration,
        "DV_TEXT": F.col("event_type"),
    }
    values = F.array(*[F.struct(F.lit(k).alias("dv_type"), c.alias("value_str")) for k, c in texts.items()])
    rows = e.select("event_id", F.inline(values))
    return v.add_magnitude(rows, "dv_type", "value_str")


@query(
    "A13_result_columns",
    """SELECT o_orderkey AS "#0", o_custkey AS owner, o_orderpriority AS "#2" FROM orders""",
)
def _(t):
    return result_columns(t.comp_version, [(F.col("vo_id"), None), (F.col("ehr_id"), "owner"), (F.col("template_name"), None)])


@query(
    "A14_scan_tags",
    """SELECT id, key, value, target_path FROM f_item_tag
       WHERE ehr_id = 7 AND target_vo_id = 7 AND target_type = 'COMPOSITION' AND key IN ('quality', 'toxic')""",
)
def _(t):
    rows = scan.scan_tags(t.item_tag, 7, 7, "COMPOSITION", keys=["quality", "toxic"])
    return rows.select("id", "key", "value", "target_path")


@query("A15_scan_definitions", "SELECT name, semver, text FROM f_definition WHERE namespace = 'Brand#2'")
def _(t):
    return scan.scan_definitions(t.definition, "Brand#2").select("name", "semver", "text")


# ---------------------------------------------------------------------------------------------
# extracted columns
# ---------------------------------------------------------------------------------------------


@query("B14_constant_column", "SELECT o_orderkey AS vo_id, 42 AS answer, 'x' AS tag FROM orders")
def _(t):
    return constant_column(constant_column(t.comp_version.select("vo_id"), 42, "answer"), "x", "tag")


@query("B20_x_name_value", "SELECT vo_id, num, entity_name AS name_value FROM f_nodes WHERE rm_entity = 'ELEMENT'")
def _(t):
    rows = scan.scan_nodes(t.nodes, types=["ELEMENT"])
    return rows.select("vo_id", "num", x.x_name_value(rows).alias("name_value"))


@query("B21_x_uid_value", "SELECT vo_id || '::rec.example::' || sys_version AS uid FROM f_versions")
def _(t):
    return t.versions.select(x.x_uid_value(t.versions, SYSTEM).alias("uid"))


@query("B22_x_root_concept", "SELECT vo_id, 'openEHR-EHR-COMPOSITION' || root_concept AS archetype_node_id FROM f_comp_version")
def _(t):
    return t.comp_version.select("vo_id", x.x_root_concept(t.comp_version).alias("archetype_node_id"))


@query(
    "B23_x_archetype_node_id",
    """SELECT vo_id, num, CASE WHEN starts_with(entity_concept, '.') THEN 'openEHR-EHR-' || rm_entity || entity_concept
              ELSE entity_concept END AS archetype_node_id FROM f_nodes""",
)
def _(t):
    return t.nodes.select("vo_id", "num", x.x_archetype_node_id(t.nodes).alias("archetype_node_id"))


_UID = "CAST(substr(template_name, 1, 1) AS INT)"


def _with_uid(t):
    return t.comp_version.withColumn("template_uid", F.substring("template_name", 1, 1).cast("int"))


@query(
    "B24_x_template_id",
    f"SELECT vo_id, t.template_id FROM f_comp_version c LEFT JOIN f_template t ON t.template_uid = {_UID}",
)
def _(t):
    return x.with_template_id(_with_uid(t), t.template).select("vo_id", "template_id")


@query("B25_x_ehr_id", "SELECT vo_id, ehr_id AS ehr_id_value FROM f_comp_version")
def _(t):
    return t.comp_version.select("vo_id", x.x_ehr_id(t.comp_version).alias("ehr_id_value"))


@query("B26_x_ehr_system", "SELECT ehr_id, 'rec.example' AS system_id FROM f_ehr")
def _(t):
    return t.ehr.select("ehr_id", x.x_ehr_system(SYSTEM).alias("system_id"))


_ISO = r"regexp_replace(strftime({}, '%Y-%m-%dT%H:%M:%S.%f'), '\.?0+$', '') || 'Z'"


@query("B27_x_ehr_created", f"SELECT ehr_id, {_ISO.format('creation_date')} AS time_created FROM f_ehr")
def _(t):
    return t.ehr.select("ehr_id", x.x_ehr_created(t.ehr).alias("time_created"))


@query("B28_x_contribution_id", "SELECT vo_id, sys_version, contribution_id AS contribution FROM f_head")
def _(t):
    return t.version_head.select("vo_id", "sys_version", x.x_contribution_id(t.version_head).alias("contribution"))


@query("B29_x_time_committed", f"SELECT vo_id, sys_version, {_ISO.format('sys_period_lower')} AS time_committed FROM f_head")
def _(t):
    return t.version_head.select("vo_id", "sys_version", x.x_time_committed(t.version_head).alias("time_committed"))


@query("B30_x_audit_system", "SELECT audit_id, 'rec.example' AS system_id FROM f_audit")
def _(t):
    return t.audit.select("audit_id", x.x_audit_system(SYSTEM).alias("system_id"))


@query("B31_x_audit_description", "SELECT audit_id, description FROM f_audit")
def _(t):
    return t.audit.select("audit_id", x.x_audit_description(t.audit).alias("description"))


_CODE = "CASE {} WHEN 'creation' THEN '249' WHEN 'amendment' THEN '250' WHEN 'modification' THEN '251' WHEN 'deleted' THEN '523' END"


@query(
    "B32_x_change_type",
    f"""SELECT audit_id, lower(change_type) AS "value", {_CODE.format('change_type')} AS code_string,
        lower(change_type) AS preferred_term, 'openehr' AS terminology_id FROM f_audit""",
)
def _(t):
    parts = x.x_change_type(F.col("change_type"))
    return t.audit.select("audit_id", *[c.alias(n) for n, c in parts.items()])


# ---------------------------------------------------------------------------------------------
# predicates
# ---------------------------------------------------------------------------------------------


@query(
    "C1_compare",
    """SELECT 'eq' AS test, vo_id, num FROM f_nodes WHERE entity_name = 'price'
       UNION ALL SELECT 'ne', vo_id, num FROM f_nodes WHERE entity_name <> 'price'
       UNION ALL SELECT 'ne_other_type', vo_id, num FROM f_nodes
       UNION ALL SELECT 'ge', vo_id, num FROM f_nodes WHERE magnitude >= 50000""",
)
def _(t):
    n, name, m = t.nodes, F.col("entity_name"), F.col("magnitude")
    tests = {
        "eq": p.compare(name, "=", "price", "text"),
        "ne": p.compare(name, "!=", "price", "text"),
        "eq_other_type": p.compare(name, "=", 5, "text"),
        "ne_other_type": p.compare(name, "!=", 5, "text"),
        "ge": p.compare(m, ">=", 50000, "number"),
    }
    # one pass over the nodes: every test that holds becomes a row
    hits = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in tests.items()]))
    return n.select(F.explode(hits).alias("test"), "vo_id", "num")


@query(
    "C2_compare_json",
    """WITH d AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
       SELECT event_id, k = 50 AS eq, k <> 50 AS ne, k > 50 AS gt, TRUE AS ne_text, TRUE AS gt_text, FALSE AS lt_text FROM d""",
)
def _(t):
    e = t.table("events").select("event_id", F.try_variant_get(F.parse_json("props"), "$.k", "variant").alias("k"))
    k = F.col("k")
    return e.select(
        "event_id",
        p.compare_json(k, "=", 50).alias("eq"), p.compare_json(k, "!=", 50).alias("ne"), p.compare_json(k, ">", 50).alias("gt"),
        # a number is never equal to a text and sorts after every text
        p.compare_json(k, "!=", "50").alias("ne_text"), p.compare_json(k, ">", "50").alias("gt_text"),
        p.compare_json(k, "<", "50").alias("lt_text"),
    )


@query(
    "C3_like_text",
    """SELECT p_partkey, p_name LIKE '%ring%' AS anywhere, p_name LIKE 's____ %' AS one_char, p_name LIKE '100\\%%' ESCAPE '\\' AS literal
       FROM part""",
)
def _(t):
    name = F.col("p_name")
    return t.table("part").select(
        "p_partkey", p.like_text(name, "*ring*").alias("anywhere"), p.like_text(name, "s???? *").alias("one_char"),
        p.like_text(name, "100%*").alias("literal"),
    )


@query(
    "C4_like_json",
    """SELECT doc_id, text LIKE '%the%' AS hit, FALSE AS number_hit FROM documents""",
)
def _(t):
    d = t.table("documents").select(
        "doc_id", F.parse_json(F.to_json(F.struct("text", "n_chars"))).alias("data")
    )
    return d.select(
        "doc_id",
        p.like_json(F.try_variant_get("data", "$.text", "variant"), "*the*").alias("hit"),
        p.like_json(F.try_variant_get("data", "$.n_chars", "variant"), "*").alias("number_hit"),
    )


@query("C5_matches", "SELECT vo_id, num FROM f_nodes WHERE entity_name IN ('price', 'shipped')")
def _(t):
    return t.nodes.filter(p.matches(F.col("entity_name"), ["price", "shipped", 7])).select("vo_id", "num")


@query(
    "C6_and_or_not",
    """SELECT vo_id, num FROM f_nodes
       WHERE NOT ((entity_name = 'price' AND magnitude > 1000) OR entity_name IN ('shipped', 'status') OR entity_name LIKE 'q%')""",
)
def _(t):
    name = F.col("entity_name")
    cond = ~(
        ((name == "price") & (F.col("magnitude") > 1000)) | p.matches(name, ["shipped", "status"]) | p.like_text(name, "q*")
    )
    return t.nodes.filter(cond).select("vo_id", "num")


@query("C7_not_null", "SELECT vo_id, num, magnitude IS NOT NULL AS has_value FROM f_nodes")
def _(t):
    return t.nodes.select("vo_id", "num", p.exists(F.col("magnitude")).alias("has_value"))


@query(
    "C8_compare_ordered",
    """SELECT vo_id, num, dv_type IN ('DV_COUNT', 'DV_QUANTITY') AND magnitude > 1000 AS above,
              dv_type IN ('DV_DATE') AND magnitude < 730000 AS before, FALSE AS nothing
       FROM f_nodes WHERE dv_type IS NOT NULL AND magnitude IS NOT NULL""",
)
def _(t):
    kind, m = F.col("dv_type"), F.col("magnitude")
    rows = t.nodes.filter(kind.isNotNull() & m.isNotNull())
    before = dt.date.fromordinal(730001)
    return rows.select(
        "vo_id", "num",
        p.compare_ordered(kind, m, ">", 1000).alias("above"),
        p.compare_ordered(kind, m, "<", before, ["DV_DATE", "DV_DATE_TIME", "DV_QUANTITY"]).alias("before"),
        p.compare_ordered(kind, m, "!=", "no ordered value").alias("nothing"),
    )


@query(
    "C9_ordered_temporal_literal",
    """SELECT vo_id, num, magnitude = 729000 AS date_equals, FALSE AS date_time_equals, magnitude < 729000 AS date_time_before
       FROM f_nodes WHERE dv_type = 'DV_DATE'""",
)
def _(t):
    kind, m = F.col("dv_type"), F.col("magnitude")
    day = dt.date.fromordinal(729001)
    noon = dt.datetime(day.year, day.month, day.day, 12)
    types = ["DV_DATE", "DV_TIME"]
    return t.nodes.filter(kind == "DV_DATE").select(
        "vo_id", "num", p.compare_ordered(kind, m, "=", day, types).alias("date_equals"),
        p.compare_ordered(kind, m, "=", noon, types).alias("date_time_equals"),
        p.compare_ordered(kind, m, "<", noon, types).alias("date_time_before"),
    )


@query(
    "C10_ordered_string_literal",
    """SELECT event_id, CAST(epoch(ts) % 86400 AS BIGINT) > 37800 AS longer,
              floor(epoch(ts)) > epoch(TIMESTAMP '2024-01-15 10:30:00') AS later
       FROM events""",
)
def _(t):
    e = t.table("events")
    seconds = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("decimal(38,9)")
    stamp = v.date_time_magnitude(iso_text(F.col("ts")))
    return e.select(
        "event_id",
        p.compare_ordered(F.lit("DV_DURATION"), seconds, ">", "PT10H30M").alias("longer"),
        p.compare_ordered(F.lit("DV_DATE_TIME"), stamp, ">", "2024-01-15T10:30:00.000500").alias("later"),
    )


@query(
    "C11_timestamp_literal",
    """SELECT event_id, ts >= TIMESTAMP '2024-01-10 00:00:00' AS from_day, ts < TIMESTAMP '2024-01-10 10:00:00' AS before_offset
       FROM events""",
)
def _(t):
    ts = F.col("ts")
    return t.table("events").select(
        "event_id", p.compare_time(ts, ">=", "2024-01-10").alias("from_day"),
        p.compare_time(ts, "<", "2024-01-10T12:00:00+02:00").alias("before_offset"),
    )


@query(
    "C12_uid_predicate",
    """SELECT vo_id, sys_version, vo_id = 80 OR (vo_id = 91 AND sys_version = 2) AS inside,
              NOT (vo_id = 80 OR (vo_id = 91 AND sys_version = 2)) AS outside,
              vo_id < 500 OR (vo_id = 500 AND sys_version < 3) AS below
       FROM f_versions""",
)
def _(t):
    vo, ver = F.col("vo_id"), F.col("sys_version")
    some = ["80", f"91::{SYSTEM}::2"]
    return t.versions.select(
        "vo_id", "sys_version", p.uid_predicate(vo, ver, "MATCHES", some, SYSTEM).alias("inside"),
        p.uid_predicate(vo, ver, "NOT MATCHES", some, SYSTEM).alias("outside"),
        p.uid_predicate(vo, ver, "<", f"500::{SYSTEM}::3", SYSTEM).alias("below"),
    )


@query(
    "C14_archetype_predicate",
    """SELECT vo_id, num, rm_entity = 'CLUSTER' AND entity_concept = '.return_details.v1' AS is_archetype,
              rm_entity <> 'CLUSTER' OR entity_concept <> '.return_details.v1' AS is_other,
              entity_concept = 'at0004' OR (rm_entity = 'OBSERVATION' AND entity_concept = '.line_item.v1') AS in_list
       FROM f_nodes WHERE num > 1""",
)
def _(t):
    rm, concept = F.col("rm_entity"), F.col("entity_concept")
    cluster, line = "openEHR-EHR-CLUSTER.return_details.v1", "openEHR-EHR-OBSERVATION.line_item.v1"
    return t.nodes.filter("num > 1").select(
        "vo_id", "num", p.archetype_predicate(rm, concept, "=", cluster).alias("is_archetype"),
        p.archetype_predicate(rm, concept, "!=", cluster).alias("is_other"),
        p.archetype_predicate(rm, concept, "MATCHES", ["at0004", line]).alias("in_list"),
    )


@query(
    "C15_root_concept_predicate",
    "SELECT vo_id, root_concept = '.order.v1' AS same, FALSE AS other_type FROM f_comp_version",
)
def _(t):
    c = F.col("root_concept")
    return t.comp_version.select(
        "vo_id", p.root_concept_predicate(c, "=", "openEHR-EHR-COMPOSITION.order.v1").alias("same"),
        p.root_concept_predicate(c, "=", "openEHR-EHR-SECTION.order.v1").alias("other_type"),
    )


@query(
    "C16_template_predicate",
    f"""SELECT vo_id, {_UID} IN (1, 2) AS known, {_UID} <> 1 AS not_one, FALSE AS unknown, TRUE AS not_unknown
        FROM f_comp_version""",
)
def _(t):
    uid = F.col("template_uid")
    return _with_uid(t).select(
        "vo_id", p.template_predicate(uid, t.template, "MATCHES", ["1-URGENT", "2-HIGH", "none"]).alias("known"),
        p.template_predicate(uid, t.template, "!=", "1-URGENT").alias("not_one"),
        p.template_predicate(uid, t.template, "=", "5-LOW").alias("unknown"),
        p.template_predicate(uid, t.template, "!=", "5-LOW").alias("not_unknown"),
    )


@query("C17_name_predicate", "SELECT vo_id, num FROM f_nodes WHERE entity_name = 'quantity'")
def _(t):
    return t.nodes.filter(p.name_predicate(F.col("entity_name"), "quantity")).select("vo_id", "num")


@query(
    "C18_owner_predicate",
    """SELECT vo_id, ehr_id = 7 AS is_owner, ehr_id IN (7, 8) AS one_of, TRUE AS not_malformed FROM f_comp_version""",
)
def _(t):
    e = F.col("ehr_id")
    return t.comp_version.select(
        "vo_id", p.owner_predicate(e, "=", "7").alias("is_owner"), p.owner_predicate(e, "MATCHES", ["7", "8", "x"]).alias("one_of"),
        p.owner_predicate(e, "!=", "x").alias("not_malformed"),
    )


@query(
    "C19_bracket_predicates",
    """SELECT vo_id, num FROM f_nodes WHERE (entity_concept = 'at0004' AND entity_name = 'quantity')
       OR (rm_entity = 'CLUSTER' AND entity_concept = '.return_details.v1')""",
)
def _(t):
    rm, concept, name = F.col("rm_entity"), F.col("entity_concept"), F.col("entity_name")
    cond = p.bracket(
        [p.archetype_predicate(rm, concept, "=", "at0004"), p.name_predicate(name, "quantity")],
        [p.archetype_predicate(rm, concept, "=", "openEHR-EHR-CLUSTER.return_details.v1")],
    )
    return t.nodes.filter(cond).select("vo_id", "num")


@query(
    "C20_change_type_predicate",
    """SELECT audit_id, change_type IN ('creation', 'deleted') AS by_code, change_type <> 'amendment' AS by_value,
              FALSE AS unknown FROM f_audit""",
)
def _(t):
    c = F.col("change_type")
    return t.audit.select(
        "audit_id", p.change_type_predicate(c, "MATCHES", ["249", "523", "999"], by="code").alias("by_code"),
        p.change_type_predicate(c, "!=", "amendment").alias("by_value"), p.change_type_predicate(c, "=", "no such").alias("unknown"),
    )


@query(
    "C22_type_filter",
    "SELECT rm_entity, count(*) AS n FROM f_nodes WHERE rm_entity IN ('OBSERVATION', 'POINT_EVENT', 'ITEM_TREE') GROUP BY rm_entity",
)
def _(t):
    rows = t.nodes.filter(p.type_filter(F.col("rm_entity"), "CARE_ENTRY", "EVENT", "ITEM_STRUCTURE"))
    return rows.groupBy("rm_entity").agg(agg_count().alias("n"))


# ---------------------------------------------------------------------------------------------
# scalar functions
# ---------------------------------------------------------------------------------------------


@query(
    "I8_ordered_magnitude",
    """SELECT vo_id, num, CAST(CASE WHEN dv_type IN ('DV_COUNT', 'DV_QUANTITY', 'DV_DATE') THEN magnitude END AS DECIMAL(38,9)) AS m
       FROM f_nodes WHERE dv_type IS NOT NULL""",
)
def _(t):
    rows = t.nodes.filter("dv_type IS NOT NULL")
    return rows.select("vo_id", "num", v.ordered_magnitude(F.col("dv_type"), F.col("magnitude"), F.col("value_str")).alias("m"))


@query(
    "I9_magnitudes",
    """SELECT event_id, CAST(CAST(floor(epoch(ts)) AS BIGINT) + 62135596800 AS DECIMAL(38,9)) AS date_time,
              CAST(datediff('day', DATE '0001-01-01', CAST(ts AS DATE)) AS DECIMAL(38,9)) AS day,
              CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DECIMAL(38,9)) AS time_of_day,
              CAST(day(ts) * 86400 + hour(ts) * 3600 AS DECIMAL(38,9)) AS duration,
              CAST((event_id % 100) / 8 AS DECIMAL(38,9)) AS proportion
       FROM events""",
)
def _(t):
    e = t.table("events")
    return e.select(
        "event_id",
        v.date_time_magnitude(F.concat(F.substring(iso_text(F.col("ts")), 1, 19), F.lit("Z"))).alias("date_time"),
        v.date_magnitude(F.substring(iso_text(F.col("ts")), 1, 10)).alias("day"),
        v.time_magnitude(F.substring(iso_text(F.col("ts")), 12, 8)).alias("time_of_day"),
        v.duration_magnitude(F.concat(F.lit("P"), F.dayofmonth("ts"), F.lit("DT"), F.hour("ts"), F.lit("H"))).alias("duration"),
        v.proportion_magnitude(F.col("event_id") % 100, F.lit(8)).alias("proportion"),
    )


@query("I10_coalesce", "SELECT vo_id, num, coalesce(value_str, entity_name, rm_entity) AS shown FROM f_nodes")
def _(t):
    return t.nodes.select("vo_id", "num", F.coalesce("value_str", "entity_name", "rm_entity").alias("shown"))


@query(
    "I11_case_map",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS status_rank FROM orders",
)
def _(t):
    return t.table("orders").select("o_orderkey", ids.case_map(F.col("o_orderstatus"), {"F": 1, "O": 2}).alias("status_rank"))


@query("I12_lower", "SELECT o_orderkey, lower(o_orderpriority) AS priority FROM orders")
def _(t):
    return t.table("orders").select("o_orderkey", F.lower("o_orderpriority").alias("priority"))


@query(
    "I13_split_part",
    """SELECT namespace, name, semver, CAST(split_part(semver, '.', 1) AS INT) AS major, CAST(split_part(semver, '.', 2) AS INT) AS minor,
              CAST(split_part(split_part(semver, '.', 3), '-', 1) AS INT) AS patch, split_part(split_part(semver, '.', 3), '-', 2) AS suffix
       FROM f_definition""",
)
def _(t):
    parts = ids.semver_parts(F.col("semver"))
    return t.definition.select("namespace", "name", "semver", *[c.alias(n) for n, c in parts.items()])


@query(
    "I14_row_compare",
    """SELECT vo_id, sys_version, vo_id > 300 OR (vo_id = 300 AND sys_version >= 4) AS ge,
              (vo_id = 300 AND sys_version = 4) OR (vo_id = 301 AND sys_version = 1) AS inside FROM f_versions""",
)
def _(t):
    def row(a, b):
        return F.struct(a.cast("bigint").alias("a"), b.cast("int").alias("b"))

    mine = row(F.col("vo_id"), F.col("sys_version"))
    return t.versions.select(
        "vo_id", "sys_version", (mine >= row(F.lit(300), F.lit(4))).alias("ge"),
        mine.isin(row(F.lit(300), F.lit(4)), row(F.lit(301), F.lit(1))).alias("inside"),
    )


@query(
    "I16_like_pattern",
    """SELECT doc_id, text LIKE '%. T%' AS star, text LIKE '_h%' AS question, text LIKE '%\\%%' ESCAPE '\\' AS percent,
              text LIKE '%*%' AS escaped FROM documents""",
)
def _(t):
    text = F.col("text")
    return t.table("documents").select(
        "doc_id", p.like_text(text, "*. T*").alias("star"), p.like_text(text, "?h*").alias("question"),
        p.like_text(text, "*%*").alias("percent"), p.like_text(text, "*\\**").alias("escaped"),
    )


@query(
    "I17_archetype_split_join",
    """SELECT vo_id, num, CASE WHEN starts_with(entity_concept, '.') THEN rm_entity END AS rm_type, entity_concept AS concept
       FROM f_nodes WHERE entity_concept IS NOT NULL""",
)
def _(t):
    joined = t.nodes.filter("entity_concept IS NOT NULL").select(
        "vo_id", "num", ids.archetype_join(F.col("rm_entity"), F.col("entity_concept")).alias("node_id")
    )
    parts = ids.archetype_split(F.col("node_id"))
    return joined.select("vo_id", "num", *[c.alias(n) for n, c in parts.items()])


@query(
    "I18_version_id",
    """SELECT vo_id || '::rec.example::' || sys_version AS uid, CAST(vo_id AS VARCHAR) AS object_id, 'rec.example' AS system_id,
              sys_version AS version FROM f_versions""",
)
def _(t):
    rows = t.versions.select(ids.version_id(F.col("vo_id"), SYSTEM, F.col("sys_version")).alias("uid"))
    return rows.select("uid", *[c.alias(n) for n, c in ids.version_id_parts(F.col("uid")).items()])


@query(
    "I19_change_type_code",
    f"SELECT audit_id, {_CODE.format('change_type')} AS code, change_type AS name FROM f_audit",
)
def _(t):
    rows = t.audit.select("audit_id", ids.change_type_code(F.col("change_type")).alias("code"))
    return rows.withColumn("name", ids.change_type_name(F.col("code")))


@query(
    "I20_iso_timestamp",
    f"SELECT event_id, {_ISO.format('ts')} AS iso, ts AS parsed, CAST(NULL AS TIMESTAMP) AS unparsable FROM events",
)
def _(t):
    rows = t.table("events").select("event_id", "event_type", ids.iso_format(F.col("ts")).alias("iso"))
    return rows.select("event_id", "iso", ids.iso_parse(F.col("iso")).alias("parsed"), ids.iso_parse(F.col("event_type")).alias("unparsable"))


_TEMPLATE = """CASE p_partkey % 4 WHEN 0 THEN replace(p_name, ' ', '_') || '.en.v' || (p_size % 5) || '.' || (p_partkey % 13)
  WHEN 1 THEN replace(p_name, ' ', '_') || '_v' || (p_size % 5) WHEN 2 THEN replace(p_name, ' ', '_') || '.de-AT V' || (p_size % 5) || '.2.3'
  ELSE replace(p_name, ' ', '_') END"""


def template_name():
    """Template ids with different languages, separators and version lengths."""
    base = F.regexp_replace("p_name", " ", "_")
    k, major = F.col("p_partkey"), F.col("p_size") % 5
    return (
        F.when(k % 4 == 0, F.concat(base, F.lit(".en.v"), major, F.lit("."), k % 13))
        .when(k % 4 == 1, F.concat(base, F.lit("_v"), major))
        .when(k % 4 == 2, F.concat(base, F.lit(".de-AT V"), major, F.lit(".2.3")))
        .otherwise(base)
    )


@query(
    "I21_template_version_split",
    f"""WITH d AS (SELECT p_partkey, {_TEMPLATE} AS template_id FROM part)
        SELECT p_partkey, template_id,
          regexp_extract(template_id, '{ids.TEMPLATE_VERSION_PATTERN}', 1) AS name,
          CAST(nullif(regexp_extract(template_id, '{ids.TEMPLATE_VERSION_PATTERN}', 2), '') AS INT) AS major,
          CAST(nullif(regexp_extract(template_id, '{ids.TEMPLATE_VERSION_PATTERN}', 3), '') AS INT) AS minor,
          CAST(nullif(regexp_extract(template_id, '{ids.TEMPLATE_VERSION_PATTERN}', 4), '') AS INT) AS patch
        FROM d""",
)
def _(t):
    rows = t.table("part").select("p_partkey", template_name().alias("template_id"))
    return rows.select("p_partkey", "template_id", *[c.alias(n) for n, c in ids.template_version(F.col("template_id")).items()])
