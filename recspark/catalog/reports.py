"""Aggregates, sort orders and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark import model
from recspark.catalog.base import query
from recspark.catalog.scans import SYSTEM
from recspark.functions import json_values as j
from recspark.operators import aggregates as a
from recspark.operators import contains as c
from recspark.operators import order as o
from recspark.operators import versions as ver

# ---------------------------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------------------------


@query("E1_count_all", "SELECT ehr_id, count(*) AS n FROM f_comp_version GROUP BY ehr_id")
def _(t):
    return t.comp_version.groupBy("ehr_id").agg(a.agg_count().alias("n"))


@query("E2_count_path", "SELECT vo_id, count(value_str) AS n FROM f_nodes GROUP BY vo_id")
def _(t):
    return t.nodes.groupBy("vo_id").agg(a.agg_count(F.col("value_str")).alias("n"))


@query(
    "E3_count_distinct",
    """SELECT v.ehr_id, count(DISTINCT v.vo_id) AS objects, count(DISTINCT n.rm_entity || '|' || coalesce(n.entity_concept, '')) AS archetypes
       FROM f_comp_version v JOIN f_nodes n ON n.vo_id = v.vo_id GROUP BY v.ehr_id""",
)
def _(t):
    rows = ver.with_data(t.comp_version, t.nodes)
    return rows.groupBy("ehr_id").agg(
        a.agg_count_distinct(F.col("vo_id")).alias("objects"),
        a.agg_count_distinct(F.col("rm_entity"), F.col("entity_concept")).alias("archetypes"),
    )


_K = "CAST(json_extract_string(props, '$.k') AS DECIMAL(18,6))"


def _k(t):
    number = j.json_path(j.parse(F.col("props")), "k", "decimal(18,6)")
    return t.table("events").select("event_id", "event_type", "user_id", "ts", number.alias("k"))


@query("E4_min_max_scalar", f"SELECT event_type, min({_K}) AS lo, max({_K}) AS hi FROM events GROUP BY event_type")
def _(t):
    return _k(t).groupBy("event_type").agg(a.agg_min(F.col("k")).alias("lo"), a.agg_max(F.col("k")).alias("hi"))


_ORDERED = """SELECT vo_id, num, dv_type, magnitude, value_str FROM f_nodes WHERE dv_type IN ('DV_DATE', 'DV_CODED_TEXT')"""


@query(
    "E5_max_ordered",
    f"""SELECT vo_id, value_str AS latest FROM (
          SELECT vo_id, value_str, row_number() OVER (PARTITION BY vo_id ORDER BY magnitude DESC, num DESC) AS rn
          FROM ({_ORDERED}) WHERE magnitude IS NOT NULL) WHERE rn = 1""",
)
def _(t):
    rows = t.nodes.filter(F.col("dv_type").isin("DV_DATE", "DV_CODED_TEXT"))
    latest = a.agg_max_ordered(F.col("value_str"), F.col("magnitude"), F.col("num"))
    return rows.groupBy("vo_id").agg(latest.alias("latest"))


@query(
    "E6_min_ordered",
    f"""SELECT vo_id, value_str AS earliest FROM (
          SELECT vo_id, value_str, row_number() OVER (PARTITION BY vo_id ORDER BY magnitude, num DESC) AS rn
          FROM ({_ORDERED}) WHERE magnitude IS NOT NULL) WHERE rn = 1""",
)
def _(t):
    rows = t.nodes.filter(F.col("dv_type").isin("DV_DATE", "DV_CODED_TEXT"))
    earliest = a.agg_min_ordered(F.col("value_str"), F.col("magnitude"), F.col("num"))
    return rows.groupBy("vo_id").agg(earliest.alias("earliest"))


@query(
    "E7_avg_json",
    f"""SELECT user_id, CAST(((sum({_K}) * 1000)::HUGEINT * 2 + count({_K})) // (2 * count({_K})) / 1000 AS DECIMAL(18,3)) AS mean, CAST(NULL AS DECIMAL(18,3)) AS no_numbers
        FROM events GROUP BY user_id""",
)
def _(t):
    k = a.agg_avg(F.col("k"))
    text = j.json_path(F.to_variant_object(F.struct(F.col("event_type").alias("x"))), "x", "variant")
    # a text is no number, even where it could be read as one
    numbers_only = F.when(F.schema_of_variant(text) != "STRING", F.lit(1).cast("decimal(18,6)"))
    rows = _k(t).withColumn("none", numbers_only)
    return rows.groupBy("user_id").agg(
        k.cast("decimal(18,3)").alias("mean"), a.agg_avg(F.col("none")).cast("decimal(18,3)").alias("no_numbers")
    )


@query("E8_sum_json", f"SELECT user_id, CAST(sum({_K}) AS DECIMAL(28,6)) AS total FROM events GROUP BY user_id")
def _(t):
    return _k(t).groupBy("user_id").agg(a.agg_sum(F.col("k")).cast("decimal(28,6)").alias("total"))


@query(
    "E9_min_max_time",
    "SELECT ehr_id, min(sys_period_lower) AS first_commit, max(sys_period_lower) AS last_commit FROM f_versions GROUP BY ehr_id",
)
def _(t):
    lower = F.col("sys_period_lower")
    return t.versions.groupBy("ehr_id").agg(a.agg_min(lower).alias("first_commit"), a.agg_max(lower).alias("last_commit"))


@query(
    "E10_group_by_paths",
    """SELECT rm_entity, entity_concept, dv_type, count(*) AS n, CAST(sum(magnitude) AS DECIMAL(28,2)) AS total
       FROM f_nodes GROUP BY rm_entity, entity_concept, dv_type""",
)
def _(t):
    aggs = [a.agg_count().alias("n"), a.agg_sum(F.col("magnitude")).cast("decimal(28,2)").alias("total")]
    return a.group_by_paths(t.nodes, ["rm_entity", "entity_concept", "dv_type"], aggs)


# one JSON value of changing type per event
_MIXED = """SELECT event_id, event_type, user_id, CASE event_id % 8
   WHEN 0 THEN json_extract(props, '$.k') WHEN 1 THEN to_json(event_type) WHEN 2 THEN to_json(event_id % 3 = 0) WHEN 3 THEN CAST('null' AS JSON)
   WHEN 4 THEN to_json(CAST(user_id AS VARCHAR)) WHEN 5 THEN json_extract(props, '$.k') WHEN 6 THEN CAST(CAST(user_id AS VARCHAR) || '.25' AS JSON) END AS v FROM events"""
_MIXED_KEY = """SELECT *, CASE json_type(v) WHEN 'NULL' THEN 0 WHEN 'VARCHAR' THEN 1 WHEN 'BOOLEAN' THEN 3 ELSE 2 END AS rank,
   CASE WHEN json_type(v) NOT IN ('NULL', 'VARCHAR', 'BOOLEAN') THEN CAST(v AS DECIMAL(18,6)) END AS number, CASE json_type(v) WHEN 'BOOLEAN' THEN v = 'true' END AS flag,
   CASE json_type(v) WHEN 'VARCHAR' THEN json_extract_string(v, '$') END AS text FROM (""" + _MIXED + ") WHERE v IS NOT NULL"
_FIRST = "CASE WHEN rank = 0 THEN 'null' WHEN rank = 1 THEN '\"' || text || '\"' WHEN rank = 2 THEN CAST(number AS VARCHAR) ELSE CAST(flag AS VARCHAR) END"


def _mixed(t):
    """Numbers, texts (also ones that read like a number), booleans, JSON nulls and missing values."""
    e = F.col("event_id")
    plain = F.get_json_object("props", "$.k")
    text = (
        F.when((e % 8).isin(0, 5), plain).when(e % 8 == 1, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .when(e % 8 == 2, (e % 3 == 0).cast("string")).when(e % 8 == 3, "null")
        .when(e % 8 == 4, F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('"'))).when(e % 8 == 6, F.concat(F.col("user_id").cast("string"), F.lit(".25")))
    )
    return t.table("events").select("event_id", "event_type", "user_id", j.parse(text).alias("v"))


def _shown(value):
    """A JSON scalar as text, numbers with six decimals."""
    return F.coalesce(j.json_number(value).cast("decimal(18,6)").cast("string"), F.to_json(value))


@query(
    "E4_min_max_json",
    f"""WITH k AS ({_MIXED_KEY}),
        r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank, number, flag, text) AS a, row_number() OVER (PARTITION BY user_id ORDER BY rank DESC, number DESC, flag DESC, text DESC) AS z FROM k)
        SELECT user_id, max(CASE WHEN a = 1 THEN {_FIRST} END) AS lo, max(CASE WHEN z = 1 THEN {_FIRST} END) AS hi FROM r GROUP BY user_id""",
)
def _(t):
    v = F.col("v")
    rows = _mixed(t).groupBy("user_id").agg(a.agg_min_json(v).alias("lo"), a.agg_max_json(v).alias("hi"))
    return rows.filter("lo IS NOT NULL").select("user_id", _shown(F.col("lo")).alias("lo"), _shown(F.col("hi")).alias("hi"))


@query(
    "E7_avg_sum_json",
    f"""WITH k AS ({_MIXED_KEY})
        SELECT event_type, user_id % 10 AS part, CAST(sum(number) AS DECIMAL(28,6)) AS total, CAST(count(number) AS BIGINT) AS numbers,
               CAST(CASE WHEN count(number) > 0 THEN ((sum(number) * 1000)::HUGEINT * 2 + count(number)) // (2 * count(number)) / 1000 END AS DECIMAL(18,3)) AS mean,
               CAST(sum(CASE WHEN event_id % 8 <= 3 AND event_id % 8 > 0 THEN number END) AS DECIMAL(28,6)) AS no_numbers
        FROM k GROUP BY event_type, user_id % 10""",
)
def _(t):
    v = F.col("v")
    none = F.when((F.col("event_id") % 8).between(1, 3), v)
    rows = _mixed(t).filter("v IS NOT NULL").groupBy("event_type", (F.col("user_id") % 10).alias("part"))
    return rows.agg(
        a.agg_sum_json(v).cast("decimal(28,6)").alias("total"), F.count(j.json_number(v)).alias("numbers"), a.agg_avg_json(v).cast("decimal(18,3)").alias("mean"),
        a.agg_sum_json(none).cast("decimal(28,6)").alias("no_numbers"),
    )


@query(
    "E10_implicit_keys",
    f"""SELECT CAST(n.vo_id AS VARCHAR) || '::{SYSTEM}::' || CAST(v.sys_version AS VARCHAR) AS uid,
               CASE WHEN starts_with(n.entity_concept, '.') THEN '{model.ARCHETYPE_PREFIX}' || n.rm_entity || n.entity_concept ELSE n.entity_concept END AS node_id,
               n.num AS node, v.template_name, 'line' AS label, count(*) AS n, CAST(sum(e.magnitude) AS DECIMAL(28,2)) AS total
        FROM f_comp_version v JOIN f_nodes n ON n.vo_id = v.vo_id JOIN f_nodes e ON e.vo_id = n.vo_id AND e.num - n.num BETWEEN 1 AND n.num_cap - n.num
        WHERE n.rm_entity = 'OBSERVATION' AND e.rm_entity = 'ELEMENT' GROUP BY n.vo_id, v.sys_version, n.rm_entity, n.entity_concept, n.num, n.num_cap, v.template_name""",
)
def _(t):
    rows = ver.with_data(t.comp_version.select("vo_id", "sys_version", "template_name"), c.nodes_as(t.nodes, "o", "OBSERVATION", columns=["rm_entity", "entity_concept"]))
    rows = c.contains(rows, "o", c.nodes_as(t.nodes, "e", "ELEMENT", columns=["magnitude"]), "e", blocks=t.blocks)
    paths = [
        a.Projected("uid", "uid", system=SYSTEM), a.Projected("archetype", "node_id", prefix="o"), a.Projected("object", "node", prefix="o"),
        a.Projected("column", "template_name", F.col("template_name")), a.Projected("constant", "label", F.lit("line")),
    ]
    out = a.group_by_projected(rows, paths, [a.agg_count().alias("n"), a.agg_sum(F.col("e_magnitude")).cast("decimal(28,2)").alias("total")])
    return out.withColumn("node", F.col("node.num"))


@query("E11_distinct", "SELECT DISTINCT entity_name, value_str FROM f_nodes")
def _(t):
    return a.distinct_paths(t.nodes, ["entity_name", "value_str"])


@query(
    "E12_group_order_magnitude",
    "SELECT entity_name, count(*) AS n FROM f_nodes WHERE rm_entity = 'ELEMENT' AND dv_type = 'DV_COUNT' GROUP BY entity_name, magnitude",
)
def _(t):
    rows = t.nodes.filter("rm_entity = 'ELEMENT' AND dv_type = 'DV_COUNT'")
    return a.group_by_paths(rows, ["entity_name"], [a.agg_count().alias("n")], order_magnitude=F.col("magnitude"))


@query(
    "E15_string_agg",
    """SELECT rm_entity, string_agg(concept, ',' ORDER BY concept) AS concepts FROM (
         SELECT DISTINCT rm_entity, coalesce(entity_concept, '-') AS concept FROM f_nodes) GROUP BY rm_entity""",
)
def _(t):
    # distinct first: the joined list holds the few concepts of a type, not its nodes
    rows = a.distinct_paths(t.nodes, ["rm_entity", "entity_concept"])
    return rows.groupBy("rm_entity").agg(a.agg_string(F.col("entity_concept")).alias("concepts"))


@query(
    "E16_array_agg_nodes",
    """SELECT k.vo_id, k.num AS k_num, string_agg(n.num || ':' || n.rm_entity, ',' ORDER BY n.num) AS nodes
       FROM f_nodes k JOIN f_nodes n ON n.vo_id = k.vo_id AND n.num - k.num BETWEEN 1 AND k.num_cap - k.num
       WHERE k.rm_entity = 'CLUSTER' GROUP BY k.vo_id, k.num""",
)
def _(t):
    inside = c.contains(c.nodes_as(t.nodes, "k", "CLUSTER"), "k", c.nodes_as(t.nodes, "n", columns=["rm_entity"]), "n")
    groups = a.collect_nodes(inside, ["vo_id", "k_num"], "n_num", "n_rm_entity", start=F.col("k_num"))
    shown = F.transform("nodes", lambda x: F.concat(x["n_num"], F.lit(":"), x["n_rm_entity"]))
    return groups.select("vo_id", "k_num", F.array_join(shown, ",").alias("nodes"))


@query(
    "E17_exists_any",
    """SELECT c_custkey AS ehr_id, c_custkey IN (SELECT ehr_id FROM f_head UNION ALL SELECT ehr_id FROM f_history) AS found FROM customer""",
)
def _(t):
    return a.exists_any(t.ehr.select("ehr_id"), t.version_head, t.version_history)


@query(
    "Q3_owner_statistics",
    """SELECT v.ehr_id, count(*) AS n, count(DISTINCT v.vo_id) AS objects, max(e.magnitude) AS hi, min(e.magnitude) AS lo,
              CAST(((sum(e.magnitude) * 100)::HUGEINT * 2 + count(e.magnitude)) // (2 * count(e.magnitude)) / 100 AS DECIMAL(18,2)) AS mean, CAST(sum(e.magnitude) AS DECIMAL(28,2)) AS total
       FROM f_comp_version v JOIN f_nodes e ON e.vo_id = v.vo_id
       WHERE e.rm_entity = 'ELEMENT' AND e.dv_type = 'DV_QUANTITY' GROUP BY v.ehr_id""",
)
def _(t):
    quantities = t.nodes.filter("rm_entity = 'ELEMENT' AND dv_type = 'DV_QUANTITY'").select("vo_id", "magnitude")
    rows = ver.with_data(t.comp_version.select("vo_id", "ehr_id"), quantities)
    m = F.col("magnitude")
    return rows.groupBy("ehr_id").agg(
        a.agg_count().alias("n"), a.agg_count_distinct(F.col("vo_id")).alias("objects"), a.agg_max(m).alias("hi"),
        a.agg_min(m).alias("lo"), a.agg_avg(m).cast("decimal(18,2)").alias("mean"),
        a.agg_sum(m).cast("decimal(28,2)").alias("total"),
    )


# ---------------------------------------------------------------------------------------------
# order and limit: with a limit, so that the order decides the rows
# ---------------------------------------------------------------------------------------------


@query(
    "G1_order_by",
    """SELECT * FROM (SELECT vo_id, num, value_str FROM f_nodes ORDER BY value_str DESC NULLS FIRST, vo_id, num LIMIT 40)
       UNION ALL SELECT * FROM (SELECT vo_id, num, value_str FROM f_nodes ORDER BY value_str ASC NULLS LAST, vo_id, num LIMIT 40)""",
)
def _(t):
    n = t.nodes.select("vo_id", "num", "value_str")
    down = o.limit_offset(o.order_by(n, [("value_str", "desc"), ("vo_id", "asc"), ("num", "asc")]), 40)
    up = o.limit_offset(o.order_by(n, [("value_str", "asc"), ("vo_id", "asc"), ("num", "asc")]), 40)
    return down.unionByName(up)


@query(
    "G2_order_by_magnitude",
    "SELECT vo_id, num, magnitude FROM f_nodes WHERE dv_type = 'DV_QUANTITY' ORDER BY magnitude DESC, vo_id, num LIMIT 100",
)
def _(t):
    rows = t.nodes.filter("dv_type = 'DV_QUANTITY'").select("vo_id", "num", "magnitude")
    return o.limit_offset(rows.orderBy(*o.magnitude_key(F.col("magnitude"), True), "vo_id", "num"), 100)


@query(
    "G3_order_by_archetype",
    """SELECT vo_id, num, rm_entity, entity_concept FROM f_nodes WHERE entity_concept IS NOT NULL
       ORDER BY entity_concept LIKE '.%' DESC, CASE WHEN entity_concept LIKE '.%' THEN rm_entity END DESC NULLS FIRST, entity_concept DESC, vo_id, num
       LIMIT 500 OFFSET 100""",
)
def _(t):
    rows = t.nodes.filter("entity_concept IS NOT NULL").select("vo_id", "num", "rm_entity", "entity_concept")
    keys = o.archetype_keys(F.col("rm_entity"), F.col("entity_concept"), descending=True)
    return o.limit_offset(rows.orderBy(*keys, "vo_id", "num"), 500, 100)


@query(
    "G4_order_by_template",
    """SELECT vo_id, t.template_id FROM f_comp_version c LEFT JOIN f_template t ON t.template_uid = CAST(substr(template_name, 1, 1) AS INT)
       ORDER BY t.template_id DESC NULLS FIRST, vo_id LIMIT 1000 OFFSET 10""",
)
def _(t):
    rows = t.comp_version.withColumn("template_uid", F.substring("template_name", 1, 1).cast("int"))
    rows = o.with_template_order(rows, t.template)
    rows = o.order_by(rows, [("template_order", "desc"), ("vo_id", "asc")])
    return o.limit_offset(rows, 1000, 10).select("vo_id", F.col("template_order").cast("string").alias("template_id"))


@query(
    "G5_order_by_change_type",
    """SELECT * FROM (SELECT audit_id, change_type FROM f_audit ORDER BY lower(change_type), audit_id LIMIT 300 OFFSET 100)
       UNION ALL SELECT * FROM (SELECT audit_id, change_type FROM f_audit ORDER BY CASE change_type WHEN 'creation' THEN '249'
         WHEN 'amendment' THEN '250' WHEN 'modification' THEN '251' ELSE '523' END DESC, audit_id LIMIT 300)""",
)
def _(t):
    rows = t.audit.select("audit_id", "change_type")
    by_value = rows.orderBy(*o.change_type_keys(F.col("change_type")), "audit_id")
    by_code = rows.orderBy(*o.change_type_keys(F.col("change_type"), "code", True), "audit_id")
    return o.limit_offset(by_value, 300, 100).unionByName(o.limit_offset(by_code, 300))


_SEM = "CAST(split_part(semver, '.', 1) AS INT) {0}, CAST(split_part(semver, '.', 2) AS INT) {0}, CAST(split_part(split_part(semver, '.', 3), '-', 1) AS INT) {0}, split_part(split_part(semver, '.', 3), '-', 2) {0}"


@query(
    "G6_order_by_semver",
    f"SELECT namespace, name, semver FROM f_definition ORDER BY {_SEM.format('DESC')}, namespace, name LIMIT 50",
)
def _(t):
    rows = t.definition.orderBy(o.semver_order(F.col("semver"), True), "namespace", "name")
    return o.limit_offset(rows, 50).select("namespace", "name", "semver")


@query(
    "G7_order_by_name_collated",
    """SELECT name FROM (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT upper(p_name) FROM part)
       ORDER BY lower(name), name DESC LIMIT 25""",
)
def _(t):
    names = t.table("part").select(F.col("p_name").alias("name"))
    names = names.unionByName(names.select(F.upper("name").alias("name"))).distinct()
    # lower before upper case within equal letters
    return o.limit_offset(names.orderBy(o.collated(F.col("name"))), 25)


@query("G8_limit_offset", "SELECT vo_id, ehr_id FROM f_comp_version ORDER BY vo_id LIMIT 20 OFFSET 30")
def _(t):
    return o.limit_offset(o.order_by(t.comp_version, [("vo_id", "asc")]), 20, 30).select("vo_id", "ehr_id")


_LATEST = """SELECT vo_id, sys_version, audit_id, sys_deleted FROM f_versions v
 WHERE sys_version = (SELECT max(sys_version) FROM f_versions w WHERE w.vo_id = v.vo_id)"""


@query("G10_top1_by_version", _LATEST)
def _(t):
    return ver.latest_version(t.versions).select("vo_id", "sys_version", "audit_id", "sys_deleted")


# ---------------------------------------------------------------------------------------------
# set operations
# ---------------------------------------------------------------------------------------------


@query("H1_union_versions", "SELECT vo_id, sys_version, audit_id FROM f_versions")
def _(t):
    return ver.union_versions(t.version_head, t.version_history).select("vo_id", "sys_version", "audit_id")


_KINDS = """SELECT contribution_id, 'composition' AS kind, vo_id, sys_version FROM f_versions
 UNION ALL SELECT c_custkey * 1000 + 1, 'status', c_custkey, 1 FROM customer
 UNION ALL SELECT ehr_id * 1000 + 2, 'folder', ehr_id, 1 FROM f_folder_nodes WHERE num = 0"""


def kinds(t):
    one = F.lit(1).alias("sys_version")
    status = t.status.select((F.col("ehr_id") * 1000 + 1).alias("contribution_id"), F.col("ehr_id").alias("vo_id"), one)
    folder = t.folder_nodes.filter("num = 0").select(
        (F.col("ehr_id") * 1000 + 2).alias("contribution_id"), F.col("ehr_id").alias("vo_id"), one
    )
    return {"composition": t.versions.select("contribution_id", "vo_id", "sys_version"), "status": status, "folder": folder}


@query("H2_union_kinds", _KINDS)
def _(t):
    return ver.union_kinds(kinds(t)).select("contribution_id", "kind", "vo_id", "sys_version")


@query("H3_union_distinct", "SELECT ehr_id FROM f_comp_version UNION SELECT ehr_id FROM f_versions")
def _(t):
    return ver.union_distinct(t.comp_version.select("ehr_id"), t.versions.select("ehr_id"))


@query("J9_contribution_contents", f"SELECT * FROM ({_KINDS}) WHERE contribution_id IN (SELECT contribution_id FROM f_contribution)")
def _(t):
    return ver.contribution_contents(kinds(t), t.contribution)
