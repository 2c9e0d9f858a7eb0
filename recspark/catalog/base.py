"""Registry of the queries, each with its SQL twin over the same input tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recspark.sources.tables import LINE_NODES, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}  # the same queries over a given set of frames

_tables: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Frames (plans, not data) of a folder, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        _tables[key] = Tables(spark, sf_dir)
    return _tables[key]


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        BUILDERS[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_frames(sql)
        return fn

    return register


# ---------------------------------------------------------------------------------------------
# SQL of the record frames
# ---------------------------------------------------------------------------------------------

def _s(v) -> str:
    return "'" + v + "'" if isinstance(v, str) else str(v)


_LINE_VALUES = ",\n    ".join("(" + ", ".join(_s(v) for v in row) + ")" for row in LINE_NODES)

FRAMES: dict[str, str] = {
    "f_ehr": """
SELECT c_custkey AS ehr_id, min(o_orderdate) AS creation_date
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "f_status": """
SELECT c_custkey AS ehr_id,
       CAST(c_custkey - CASE WHEN c_custkey % 97 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS subject_id,
       CASE WHEN c_custkey % 50 = 0 THEN '9 bad' ELSE 'demographic' END AS namespace,
       c_acctbal >= 0 AS is_modifiable
FROM customer""",
    "f_comp_version": """
SELECT o_orderkey AS vo_id, o_custkey AS ehr_id, 1 AS sys_version, o_orderdate AS sys_period_lower,
       o_orderpriority AS template_name, '.order.v1' AS root_concept
FROM orders""",
    "f_template": """
SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS template_uid, o_orderpriority AS template_id
FROM orders WHERE NOT starts_with(o_orderpriority, '5')""",
    "f_nodes": f"""
WITH l AS (
  SELECT lineitem.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS r,
         CASE WHEN l_returnflag = 'R' THEN 9 ELSE 7 END AS w
  FROM lineitem),
b AS (
  SELECT l.*, 2 + sum(w) OVER (PARTITION BY l_orderkey ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - w AS base
  FROM l),
t AS (
  SELECT * FROM (VALUES
    {_LINE_VALUES}
  ) AS v(k, p, rm_entity, entity_concept, entity_name, entity_attribute, depth)),
c AS (SELECT l_orderkey, sum(w) AS total FROM l GROUP BY l_orderkey)
SELECT o_orderkey AS vo_id, 0 AS num, CAST(1 + coalesce(total, 0) AS INT) AS num_cap, 0 AS parent_num, CAST(NULL AS INT) AS citem_num,
       'COMPOSITION' AS rm_entity, '.order.v1' AS entity_concept, 'Order' AS entity_name, CAST(NULL AS VARCHAR) AS entity_attribute, 0 AS depth,
       CAST(NULL AS VARCHAR) AS dv_type, CAST(NULL AS DECIMAL(18,2)) AS magnitude, CAST(NULL AS VARCHAR) AS value_str
FROM orders LEFT JOIN c ON l_orderkey = o_orderkey
UNION ALL
SELECT o_orderkey, 1, 1, 0, 0, 'EVENT_CONTEXT', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'context', 1,
       'DV_DATE', CAST(datediff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) AS DECIMAL(18,2)), CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
FROM orders
UNION ALL
SELECT l_orderkey, CAST(base + k AS INT),
       CAST(CASE WHEN k <= 3 THEN base + w - 1 WHEN k = 7 THEN base + 8 ELSE base + k END AS INT),
       CAST(CASE WHEN k = 0 THEN 0 ELSE base + p END AS INT),
       CAST(CASE WHEN k = 0 THEN 0 WHEN k = 8 THEN base + 7 ELSE base END AS INT),
       rm_entity, entity_concept, entity_name, entity_attribute, depth,
       CASE k WHEN 4 THEN 'DV_COUNT' WHEN 5 THEN 'DV_QUANTITY' WHEN 6 THEN 'DV_DATE' WHEN 8 THEN 'DV_CODED_TEXT' END,
       CASE k WHEN 4 THEN CAST(l_quantity AS DECIMAL(18,2)) WHEN 5 THEN CAST(l_extendedprice AS DECIMAL(18,2))
              WHEN 6 THEN CAST(datediff('day', DATE '0001-01-01', CAST(l_shipdate AS DATE)) AS DECIMAL(18,2)) END,
       CASE k WHEN 6 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) WHEN 8 THEN l_linestatus END
FROM b CROSS JOIN t WHERE k < w""",
    "f_versions": """
WITH e AS (
  SELECT events.*, user_id * 10 + CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS vo_id
  FROM events),
s AS (
  SELECT e.*, CAST(row_number() OVER (PARTITION BY vo_id ORDER BY ts, event_id) AS INT) AS sys_version,
         lag(event_id) OVER (PARTITION BY vo_id ORDER BY ts, event_id) AS prev_id,
         lead(ts) OVER (PARTITION BY vo_id ORDER BY ts, event_id) AS sys_period_upper
  FROM e),
d AS (SELECT s.*, (prev_id IS NOT NULL AND event_id % 7 = 0 AND prev_id % 7 <> 0) AS sys_deleted FROM s)
SELECT vo_id, user_id AS ehr_id, user_id * 1000 + day(ts) AS contribution_id, event_id AS audit_id, sys_version,
       ts AS sys_period_lower, sys_period_upper, sys_deleted,
       (sys_period_upper IS NULL AND NOT sys_deleted) AS is_head,
       CASE WHEN sys_version = 1 THEN 'creation' WHEN sys_deleted THEN 'deleted'
            WHEN event_id % 5 = 0 THEN 'amendment' ELSE 'modification' END AS change_type
FROM d""",
    "f_head": """
SELECT vo_id, ehr_id, contribution_id, audit_id, sys_version, sys_period_lower, change_type FROM f_versions WHERE is_head""",
    "f_history": """
SELECT vo_id, ehr_id, contribution_id, audit_id, sys_version, sys_period_lower, sys_period_upper, sys_deleted, change_type
FROM f_versions WHERE NOT is_head""",
    "f_audit": """
SELECT event_id AS audit_id, event_type, ts AS time_committed, user_id AS committer, props AS description,
       CASE event_id % 4 WHEN 0 THEN 'creation' WHEN 1 THEN 'amendment' WHEN 2 THEN 'modification' ELSE 'deleted' END AS change_type
FROM events""",
    "f_contribution": """
SELECT DISTINCT user_id * 1000 + day(ts) AS contribution_id, user_id AS ehr_id FROM events""",
    "f_changes": """
SELECT audit_id AS change_id, vo_id, ehr_id, contribution_id, change_type, sys_version - 1 AS preceding_version,
       sys_period_lower AS committed_at
FROM f_versions""",
    "f_folder_nodes": """
WITH g AS (SELECT DISTINCT o_custkey AS ehr_id, CAST(year(o_orderdate) AS INT) AS y, o_orderstatus AS s FROM orders),
u AS (SELECT ehr_id, y, s FROM g UNION ALL SELECT DISTINCT ehr_id, y, '' AS s FROM g),
n AS (SELECT u.*, CAST(row_number() OVER (PARTITION BY ehr_id ORDER BY y, s) AS INT) AS num FROM u)
SELECT ehr_id, 1 AS folder_idx, num,
       CASE WHEN s = '' THEN max(num) OVER (PARTITION BY ehr_id, y) ELSE num END AS num_cap,
       CASE WHEN s = '' THEN 0 ELSE min(num) OVER (PARTITION BY ehr_id, y) END AS parent_num,
       CASE WHEN s = '' THEN CAST(y AS VARCHAR) ELSE s END AS entity_name,
       CASE WHEN s = '' THEN 1 ELSE 2 END AS depth, y, s
FROM n
UNION ALL
SELECT ehr_id, 1, 0, CAST(count(*) AS INT), 0, 'root', 0, CAST(NULL AS INT), CAST(NULL AS VARCHAR) FROM n GROUP BY ehr_id""",
    "f_folder_items": """
SELECT f.ehr_id, f.folder_idx, f.num, o_orderkey AS item_vo_id
FROM f_folder_nodes f JOIN orders ON o_custkey = f.ehr_id AND year(o_orderdate) = f.y AND o_orderstatus = f.s
WHERE f.depth = 2""",
    "f_item_tag": """
SELECT doc_id * 2 + i AS id, doc_id % 50 AS ehr_id, doc_id AS target_vo_id, 'COMPOSITION' AS target_type,
       CASE i WHEN 0 THEN 'quality' ELSE 'toxic' END AS key,
       CAST(CASE i WHEN 0 THEN quality ELSE toxic END AS VARCHAR) AS value,
       CASE WHEN doc_id % 3 = 0 THEN CAST(NULL AS VARCHAR) ELSE '/content' END AS target_path
FROM labels CROSS JOIN (VALUES (0), (1)) AS v(i)""",
    "f_definition": """
WITH d AS (
  SELECT p_brand AS namespace, p_type AS name, p_partkey AS k,
         CAST(p_size % 4 + 1 AS VARCHAR) || '.' || CAST(p_partkey % 12 AS VARCHAR) || '.' || CAST(p_partkey % 5 AS VARCHAR)
           || CASE WHEN p_partkey % 7 = 0 THEN '-beta' ELSE '' END AS semver
  FROM part)
SELECT namespace, name, semver, CAST(min(k) AS VARCHAR) AS text FROM d GROUP BY namespace, name, semver""",
}


def cheapest_first(names) -> list[str]:
    """Query names by how often their SQL twin reads the node frame, the largest one."""
    return sorted(names, key=lambda n: len(re.findall(r"\b(?:FROM|JOIN) f_nodes\b", SQL.get(n, "").split("-- frames end")[-1])))


def frame(name: str, sql: str) -> None:
    FRAMES[name] = sql


def with_frames(sql: str) -> str:
    """Prefix ``sql`` with the frames it names, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bf_[a-z_0-9]+\b", text):
            if name in FRAMES and name not in order:
                visit(FRAMES[name])
                order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    # the node frame is wide and used more than once: made once, whatever the optimizer thinks of it
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n == 'f_nodes' else ''}({FRAMES[n].strip()})" for n in order)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n-- frames end\n{body[5:]}"
    return f"WITH {ctes}\n-- frames end\n{body}"
