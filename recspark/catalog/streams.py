"""Streams run to their end; each has the same result as its batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recspark.catalog.base import query
from recspark.catalog.documents import documents
from recspark.operators import contains as c
from recspark.operators import quality as q
from recspark.plans.stable import shared_dir
from recspark.streaming import checks, commits
from recspark.streaming.sinks import complete_batches, batch_path, read_last_batch, run_to_end, write_batch


def _run_dir(t, name: str) -> str:
    return f"{shared_dir(t.spark)}/streams/{name}-{uuid.uuid4().hex}"


def _stream(t, table: str):
    """The files of an input table as they arrive."""
    return t.spark.readStream.schema(t.table(table).schema).parquet(f"{t.sf_dir}/{table}.parquet*")


def _all(t, path: str):
    return t.spark.read.parquet(*[batch_path(path, b) for b in complete_batches(t.spark, path)])


@query(
    "K1_stream_apply_commits",
    "SELECT vo_id, sys_version, change_type, sys_period_lower, sys_period_upper, sys_deleted, is_head FROM f_versions",
)
def _(t):
    run = _run_dir(t, "commits")
    changes = t.changes
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    # the log arrives in two parts; the second run goes on from the state of the first
    for part in (F.col("committed_at") < cut, F.col("committed_at") >= cut):
        changes.filter(part).write.mode("append").parquet(f"{run}/arriving")
        stream = t.spark.readStream.schema(changes.schema).parquet(f"{run}/arriving")
        commits.stream_apply_commits(stream, f"{run}/state")
    rows = commits.read_versions(t.spark, f"{run}/state", changes.schema)
    return rows.select("vo_id", "sys_version", "change_type", "sys_period_lower", "sys_period_upper", "sys_deleted", "is_head")


@query("K2_stream_dedup_contribution", "SELECT contribution_id FROM f_contribution")
def _(t):
    run = _run_dir(t, "dedup")
    events = _stream(t, "events").select(
        (F.col("user_id") * 1000 + F.dayofmonth("ts")).alias("contribution_id"), F.col("ts").cast("timestamp").alias("committed_at")
    )
    once = commits.stream_dedup(events, "40 days").select("contribution_id")
    run_to_end(once, lambda b, i: write_batch(b, f"{run}/out", i), f"{run}/checkpoint")
    return _all(t, f"{run}/out")


_CLAIMED = """SELECT event_id AS change_id, CASE event_id % 4 WHEN 0 THEN 'creation' WHEN 1 THEN 'amendment' WHEN 2 THEN 'modification' ELSE 'synthesis' END AS change_type,
 CASE event_type WHEN 'signup' THEN NULL ELSE 1 END AS preceding_version FROM events"""
_REASON = """CASE WHEN change_type = 'synthesis' THEN 'change type not supported'
 WHEN change_type = 'creation' AND preceding_version > 0 THEN 'creation with preceding version'
 WHEN change_type <> 'creation' AND preceding_version IS NULL THEN 'preceding version missing' END"""


def _validated(t, part: str):
    run = _run_dir(t, "validate")
    kind = F.col("event_id") % 4
    changes = _stream(t, "events").select(
        F.col("event_id").alias("change_id"),
        F.when(kind == 0, "creation").when(kind == 1, "amendment").when(kind == 2, "modification").otherwise("synthesis").alias("change_type"),
        F.when(F.col("event_type") != "signup", 1).alias("preceding_version"),
    )
    checks.stream_validate(changes, q.check_change_rules, ["change_id"], f"{run}/ok", f"{run}/rejects", f"{run}/checkpoint")
    return _all(t, f"{run}/{part}")


@query("K3_stream_validate", f"SELECT change_id, '/preceding_version_uid' AS path, 'change rule' AS rule, message FROM (SELECT change_id, {_REASON} AS message FROM ({_CLAIMED})) WHERE message IS NOT NULL")
def _(t):
    return _validated(t, "rejects")


@query("K3_stream_accepted", f"SELECT change_id, change_type FROM ({_CLAIMED}) WHERE {_REASON} IS NULL")
def _(t):
    return _validated(t, "ok").select("change_id", "change_type")


def _audits(t):
    return _stream(t, "events").select(
        F.col("ts").cast("timestamp").alias("time_committed"), F.col("event_type").alias("change_type"), F.col("user_id").alias("committer")
    )


def _rates(t, name: str, **window):
    run = _run_dir(t, name)
    rates = checks.stream_commit_rate(_audits(t), **window)
    # whole result in every batch, so that windows still open at the end are seen as well
    run_to_end(rates, lambda b, i: write_batch(b, f"{run}/out", i), f"{run}/checkpoint", "complete")
    rows = read_last_batch(t.spark, f"{run}/out")
    return rows.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})


@query(
    "K4_stream_commit_rate",
    """SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end", event_type AS change_type, count(*) AS commits
       FROM events GROUP BY ALL""",
)
def _(t):
    return _rates(t, "tumbling", size="1 hour")


@query(
    "K4_stream_commit_rate_sliding",
    """SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR * i AS start, date_trunc('hour', ts) + INTERVAL 2 HOUR - INTERVAL 1 HOUR * i AS "end", event_type AS change_type, count(*) AS commits
       FROM events CROSS JOIN (VALUES (0), (1)) AS v(i) GROUP BY ALL""",
)
def _(t):
    return _rates(t, "sliding", size="2 hours", slide="1 hour")


@query(
    "K4_stream_commit_rate_session",
    """WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 3 HOURS THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)),
       s AS (SELECT *, sum(new) OVER (PARTITION BY user_id, event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no FROM g)
       SELECT min(ts) AS start, max(ts) + INTERVAL 3 HOURS AS "end", event_type AS change_type, user_id AS committer, count(*) AS commits FROM s GROUP BY user_id, event_type, no""",
)
def _(t):
    return _rates(t, "session", gap="3 hours", keys=["change_type", "committer"])


@query(
    "K4_stream_closed_windows",
    """SELECT * FROM (SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end", event_type AS change_type, count(*) AS commits
       FROM events GROUP BY ALL) WHERE "end" <= (SELECT max(ts) - INTERVAL 5 HOURS FROM events)""",
)
def _(t):
    run = _run_dir(t, "closed")
    checks.stream_closed_windows(_audits(t), f"{run}/out", f"{run}/checkpoint", size="1 hour", delay="5 hours")
    rows = _all(t, f"{run}/out")
    return rows.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})


_CUT = "2024-01-20 00:00:00"


@query(
    "K5_stream_late_commits",
    f"""WITH c AS (
          SELECT event_id AS change_id, event_id AS vo_id, ts AS committed_at, 1 AS version, ts >= TIMESTAMP '{_CUT}' AS early FROM events
          UNION ALL SELECT -event_id, event_id, ts - INTERVAL 1 HOUR, 2, false FROM events WHERE ts >= TIMESTAMP '{_CUT}' AND event_id % 3 = 0),
        b AS (SELECT max(committed_at) - INTERVAL 6 DAYS AS border FROM c WHERE early)
        SELECT change_id, vo_id, CASE WHEN NOT late THEN version END AS sys_version,
               CASE WHEN NOT late THEN CASE version WHEN 1 THEN committed_at ELSE committed_at + INTERVAL 1 HOUR + INTERVAL 1 MICROSECOND END END AS sys_period_lower,
               CASE WHEN late THEN 'too late' END AS reason
        FROM (SELECT c.*, NOT early AND committed_at < border AS late FROM c, b)""",
)
def _(t):
    run = _run_dir(t, "late")
    cut = F.lit(_CUT).cast("timestamp_ntz")
    e = t.table("events").select("event_id", "user_id", "ts")

    def change(rows, change_id, kind, before, at):
        return rows.select(
            change_id.alias("change_id"), F.col("event_id").alias("vo_id"), F.col("user_id").alias("ehr_id"), F.lit(kind).alias("change_type"),
            F.lit(before).cast("int").alias("preceding_version"), at.alias("committed_at"),
        )

    early = change(e.filter(F.col("ts") >= cut), F.col("event_id"), "creation", None, F.col("ts"))
    late = change(e.filter(F.col("ts") < cut), F.col("event_id"), "creation", None, F.col("ts"))
    # an update that was made before its object's newest version
    updates = change(e.filter((F.col("ts") >= cut) & (F.col("event_id") % 3 == 0)), -F.col("event_id"), "modification", 1, F.col("ts") - F.expr("INTERVAL 1 HOUR"))
    for part in (early, late.unionByName(updates)):
        part.write.mode("append").parquet(f"{run}/arriving")
        stream = t.spark.readStream.schema(early.schema).parquet(f"{run}/arriving")
        commits.stream_apply_commits(stream, f"{run}/state", max_delay="6 DAYS")
    accepted = commits.read_versions(t.spark, f"{run}/state", early.schema).withColumn("reason", F.lit(None).cast("string"))
    refused = commits.read_rejects(t.spark, f"{run}/state", early.schema)
    columns = ["change_id", "vo_id", "sys_version", "sys_period_lower", "reason"]
    return accepted.select(*columns).unionByName(refused.select("change_id", "vo_id", "reason"), allowMissingColumns=True)


@query(
    "K6_stream_contains_filter",
    "SELECT DISTINCT doc_id FROM f_doc_nodes WHERE rm_entity = 'ELEMENT' AND value_str LIKE '%ing%'",
)
def _(t):
    run = _run_dir(t, "contains")

    class Arriving:
        """Documents made from the arriving texts."""

        spark = t.spark
        table = staticmethod(lambda name: _stream(t, name))

    def pattern(nodes):
        lines = c.nodes_as(nodes, "o", "OBSERVATION", key=["doc_id"])
        hits = c.nodes_as(nodes, "e", "ELEMENT", where=F.col("value_str").contains("ing"), key=["doc_id"])
        return c.contains(lines, "o", hits, "e", key=["doc_id"], how="left_semi")

    checks.stream_contains(documents(Arriving), "doc_id", "doc", pattern, f"{run}/out", f"{run}/checkpoint")
    return _all(t, f"{run}/out").select("doc_id")
