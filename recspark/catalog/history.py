"""Versions over time, batches of commits, owners, tags and definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from recspark.catalog.base import frame, query
from recspark.catalog.reports import _LATEST
from recspark.catalog.scans import _TEMPLATE, SYSTEM, template_name
from recspark.functions import ids
from recspark.operators import commits as cm
from recspark.operators import registry as reg
from recspark.operators import versions as ver

# ---------------------------------------------------------------------------------------------
# versions
# ---------------------------------------------------------------------------------------------


@query(
    "D12_version_to_audit",
    "SELECT vo_id, sys_version, committer, description FROM f_head h JOIN f_audit a ON a.audit_id = h.audit_id",
)
def _(t):
    rows = ver.with_audit(t.version_head, t.audit.drop("change_type"))
    return rows.select("vo_id", "sys_version", "committer", "description")


_PURCHASES = "(SELECT audit_id, committer FROM f_audit WHERE event_type <> 'error')"


@query(
    "D17_versions_to_audit_left",
    f"SELECT vo_id, sys_version, committer FROM f_versions v LEFT JOIN {_PURCHASES} a ON a.audit_id = v.audit_id",
)
def _(t):
    some = t.audit.filter("event_type <> 'error'").select("audit_id", "committer")
    return ver.with_audit(t.versions, some, "left").select("vo_id", "sys_version", "committer")


@query(
    "D18_inconsistent_objects",
    """SELECT DISTINCT v.ehr_id, v.vo_id FROM f_versions v
       WHERE EXISTS (SELECT 1 FROM f_versions w WHERE w.ehr_id = v.ehr_id AND w.vo_id <> v.vo_id)""",
)
def _(t):
    return ver.inconsistent_objects(ver.all_versions(t.version_head, t.version_history))


@query("F1_latest_version", _LATEST)
def _(t):
    rows = ver.latest_version(ver.all_versions(t.version_head, t.version_history))
    return rows.select("vo_id", "sys_version", "audit_id", "sys_deleted")


@query("F3_period_upper", "SELECT vo_id, sys_version, sys_period_lower, sys_period_upper, sys_deleted FROM f_versions")
def _(t):
    # tombstones that start too late are repaired from their predecessor's end
    shifted = F.when(F.col("sys_deleted"), F.col("sys_period_lower") + F.expr("INTERVAL 5 SECONDS")).otherwise(F.col("sys_period_lower"))
    rows = t.versions.withColumn("sys_period_lower", shifted)
    return ver.fill_period_upper(rows).select("vo_id", "sys_version", "sys_period_lower", "sys_period_upper", "sys_deleted")


@query(
    "F4_strictly_increasing_time",
    """SELECT vo_id, sys_version, make_timestamp(max(epoch_us(date_trunc('day', sys_period_lower)) - sys_version) OVER (
         PARTITION BY vo_id ORDER BY sys_version ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + sys_version) AS sys_period_lower
       FROM f_versions""",
)
def _(t):
    # commits of one day share a start time
    day = F.date_trunc("day", "sys_period_lower").cast("timestamp_ntz")
    rows = t.versions.withColumn("sys_period_lower", day)
    return ver.strict_times(rows).select("vo_id", "sys_version", "sys_period_lower")


_AT = "sys_period_lower <= {0} AND (sys_period_upper IS NULL OR sys_period_upper > {0})"
_NOON = "TIMESTAMP '2024-01-15 00:00:00'"


def _at(t):
    return ver.version_at(t.versions, "2024-01-15 00:00:00").select("vo_id", "sys_version", "sys_deleted")


@query("J5_version_at", f"SELECT vo_id, sys_version, sys_deleted FROM f_versions WHERE {_AT.format(_NOON)}")
def _(t):
    return _at(t)


@query("Q7_all_objects_as_of", f"SELECT vo_id, sys_version, sys_deleted FROM f_versions WHERE {_AT.format(_NOON)}")
def _(t):
    return _at(t)


_KEYS = """SELECT event_id, user_id * 10 + CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS vo_id,
 ts + INTERVAL 30 HOURS AS at FROM events"""


def _keys(t):
    return t.versions.select(F.col("audit_id").alias("event_id"), "vo_id", (F.col("sys_period_lower") + F.expr("INTERVAL 30 HOURS")).alias("at"))


@query(
    "J5_version_at_keys",
    f"""SELECT k.event_id, k.vo_id, v.sys_version, v.sys_deleted FROM ({_KEYS}) k JOIN f_versions v ON v.vo_id = k.vo_id
        AND v.sys_period_lower <= k.at AND (v.sys_period_upper IS NULL OR v.sys_period_upper > k.at)""",
)
def _(t):
    return ver.version_at_keys(t.versions, _keys(t)).select("event_id", "vo_id", "sys_version", "sys_deleted")


@query(
    "J6_version_n",
    """SELECT k.event_id, k.vo_id, k.sys_version, CASE WHEN v.vo_id IS NULL THEN 'not found' WHEN v.sys_deleted THEN 'deleted' ELSE 'found' END AS status
       FROM (SELECT audit_id AS event_id, vo_id, sys_version + 3 AS sys_version FROM f_versions) k
       LEFT JOIN f_versions v ON v.vo_id = k.vo_id AND v.sys_version = k.sys_version""",
)
def _(t):
    keys = t.versions.select(F.col("audit_id").alias("event_id"), "vo_id", (F.col("sys_version") + 3).alias("sys_version"))
    return ver.version_n(t.versions, keys).select("event_id", "vo_id", "sys_version", "status")


@query(
    "J7_revision_history",
    "SELECT vo_id, sys_version, change_type, time_committed, committer FROM f_versions v LEFT JOIN (SELECT audit_id, time_committed, committer FROM f_audit) a ON a.audit_id = v.audit_id",
)
def _(t):
    return ver.revision_history(t.versions, t.audit).select("vo_id", "sys_version", "change_type", "time_committed", "committer")


@query(
    "J8_original_version",
    """SELECT v.vo_id || '::rec.example::' || v.sys_version AS uid, CASE WHEN v.sys_version > 1 THEN v.vo_id || '::rec.example::' || (v.sys_version - 1) END AS preceding_uid,
              v.contribution_id, c.ehr_id AS contribution_ehr_id, a.committer
       FROM f_versions v JOIN f_audit a ON a.audit_id = v.audit_id JOIN f_contribution c ON c.contribution_id = v.contribution_id""",
)
def _(t):
    rows = ver.original_version(t.versions, t.audit, t.contribution, SYSTEM)
    return rows.select("uid", "preceding_uid", "contribution_id", "contribution_ehr_id", "committer")


@query("J10_object_header", "SELECT vo_id, ehr_id, sys_period_lower AS time_created FROM f_versions WHERE sys_version = 1")
def _(t):
    return ver.object_header(t.versions)


@query(
    "J15_find_by_subject",
    """SELECT ehr_id, subject_id, namespace FROM f_status WHERE namespace = 'demographic' AND subject_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""",
)
def _(t):
    subjects = t.table("supplier").select(F.col("s_suppkey").cast("string").alias("subject_id"), F.lit("demographic").alias("namespace"))
    return ver.find_by_subject(t.status, subjects)


@query(
    "J16_subject_unique",
    "SELECT subject_id, namespace, count(*) AS owners FROM f_status GROUP BY subject_id, namespace HAVING count(*) > 1",
)
def _(t):
    return ver.duplicate_subjects(t.status)


@query(
    "J17_purge",
    """SELECT vo_id, sys_version FROM f_versions WHERE ehr_id NOT IN (SELECT ehr_id FROM f_status WHERE NOT is_modifiable)""",
)
def _(t):
    gone = t.status.filter("NOT is_modifiable").select("ehr_id")
    return ver.purge({"versions": t.versions}, gone)["versions"].select("vo_id", "sys_version")


@query(
    "J18_template_usage",
    """SELECT template_id FROM (SELECT DISTINCT p_type AS template_id FROM part UNION SELECT template_id FROM f_template)
       WHERE template_id IN (SELECT template_name FROM f_comp_version)""",
)
def _(t):
    templates = t.table("part").select(F.col("p_type").alias("template_id")).distinct().union(t.template.select("template_id")).distinct()
    return ver.template_usage(templates, t.comp_version.select(F.col("template_name").alias("template_id")))


# ---------------------------------------------------------------------------------------------
# commits
# ---------------------------------------------------------------------------------------------

frame("f_empty_head", "SELECT * FROM f_head WHERE FALSE")


def _empty(t):
    columns = ["vo_id", "ehr_id", "contribution_id", "audit_id", "sys_version", "sys_period_lower", "change_type"]
    history = t.versions.select(*columns, "sys_period_upper", "sys_deleted").limit(0)
    return history.select(*columns), history


def _changes(t):
    return t.changes.withColumn("audit_id", F.col("change_id"))


_V = "vo_id, ehr_id, contribution_id, audit_id, sys_version, sys_period_lower, change_type"


def _replay(t):
    head, history = _empty(t)
    return cm.apply_commits(head, history, _changes(t))


@query("J1_commit_create", f"SELECT {_V}, (sys_period_upper IS NULL AND NOT sys_deleted) AS open FROM f_versions WHERE sys_version = 1")
def _(t):
    head, history = _empty(t)
    done = cm.apply_commits(head, history, _changes(t).filter("change_type = 'creation'"))
    # the first versions alone: none has a successor yet, so all are heads
    later = t.versions.filter("sys_version = 2").select("vo_id").withColumn("later", F.lit(True))
    rows = done.head.join(later, "vo_id", "left")
    return rows.select(*[x.strip() for x in _V.split(",")], F.col("later").isNull().alias("open"))


@query("J2_commit_update", f"SELECT {_V} FROM f_head")
def _(t):
    return _replay(t).head.select(*[x.strip() for x in _V.split(",")])


@query("J3_commit_delete", f"SELECT {_V}, sys_period_upper, sys_deleted FROM f_history")
def _(t):
    return _replay(t).history.select(*[x.strip() for x in _V.split(",")], "sys_period_upper", "sys_deleted")


@query(
    "J2_incremental_commits",
    f"SELECT {_V}, sys_period_upper, sys_deleted, is_head FROM f_versions",
)
def _(t):
    # two batches, cut in the middle of the month: the second one meets heads and tombstones of the first
    head, history = _empty(t)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    first = cm.apply_commits(head, history, _changes(t).filter(F.col("committed_at") < cut))
    second = cm.apply_commits(first.head, first.history, _changes(t).filter(F.col("committed_at") >= cut))
    rows = ver.all_versions(second.head.withColumn("is_head", F.lit(True)), second.history.withColumn("is_head", F.lit(False)))
    return rows.select(*[x.strip() for x in _V.split(",")], "sys_period_upper", "sys_deleted", "is_head")


@query(
    "J2_commit_delta",
    f"""WITH v AS (SELECT {_V}, sys_period_upper, sys_deleted, is_head, sys_period_lower >= TIMESTAMP '2024-01-28 00:00:00' AS new,
                          coalesce(sys_period_upper >= TIMESTAMP '2024-01-28 00:00:00', false) AS ends FROM f_versions)
        SELECT CASE WHEN new AND is_head THEN 'head' WHEN new THEN 'history' WHEN sys_deleted THEN 'ended' ELSE 'closed' END AS part, vo_id, sys_version,
               CASE WHEN new OR NOT sys_deleted THEN audit_id END AS audit_id, CASE WHEN new AND is_head THEN NULL ELSE sys_period_upper END AS sys_period_upper
        FROM v WHERE new OR ends
        UNION ALL SELECT 'latest', vo_id, max(sys_version), NULL, NULL FROM v GROUP BY vo_id HAVING bool_or(new)""",
)
def _(t):
    # the table as of the 28th, then the changes since
    cut = F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")
    before = t.versions.filter(F.col("sys_period_lower") < cut)
    head = before.filter((F.col("sys_period_upper").isNull() | (F.col("sys_period_upper") >= cut)) & ~F.col("sys_deleted"))
    head = head.select(*[x.strip() for x in _V.split(",")])
    latest = ver.latest_version(before.select(*cm.LATEST))
    done = cm.commit_delta(head, latest, _changes(t).filter(F.col("committed_at") >= cut))
    out = None
    for part in ("head", "history", "closed", "ended", "latest"):
        rows = getattr(done, part)
        own = {c: F.col(c) if c in rows.columns and part != "latest" else F.lit(None).cast(k) for c, k in (("audit_id", "bigint"), ("sys_period_upper", "timestamp_ntz"))}
        rows = rows.select(F.lit(part).alias("part"), "vo_id", "sys_version", *[v.alias(c) for c, v in own.items()])
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "J4_optimistic_check",
    """SELECT c.change_id, CASE WHEN h.vo_id IS NULL THEN 'unknown object' WHEN c.preceding_version <> h.sys_version THEN 'not the latest version' END AS reason
       FROM f_changes c LEFT JOIN f_head h ON h.vo_id = c.vo_id""",
)
def _(t):
    return cm.reject_stale(t.changes, t.version_head, t.ehr, SYSTEM).select("change_id", "reason")


@query(
    "J4_rejects_of_batch",
    """SELECT audit_id + 1000000000 AS change_id, CASE WHEN sys_version = 1 THEN 'object already exists' ELSE 'not the latest version' END AS reason
       FROM f_versions WHERE sys_period_lower < TIMESTAMP '2024-01-16 00:00:00'""",
)
def _(t):
    # everything of the first half month again, onto the finished table
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    again = _changes(t).filter(F.col("committed_at") < cut).withColumn("change_id", F.col("change_id") + 1000000000)
    tail = t.version_history
    done = cm.apply_commits(t.version_head, tail, again)
    return done.rejects.select("change_id", "reason")


@query(
    "J11_default_contribution",
    """SELECT change_id, CASE WHEN change_type = 'amendment' THEN md5('contribution:' || change_id) ELSE CAST(contribution_id AS VARCHAR) END AS contribution_id FROM f_changes""",
)
def _(t):
    missing = F.when(F.col("change_type") == "amendment", F.lit(None)).otherwise(F.col("contribution_id"))
    filled, _, _ = cm.fill_contribution(t.changes.withColumn("contribution_id", missing))
    return filled.select("change_id", "contribution_id")


@query(
    "J11_new_contributions",
    """SELECT md5('contribution:' || change_id) AS contribution_id, ehr_id, md5('audit:' || change_id) AS audit_id, committed_at AS time_committed
       FROM f_changes WHERE change_type = 'amendment'""",
)
def _(t):
    missing = F.when(F.col("change_type") == "amendment", F.lit(None)).otherwise(F.col("contribution_id"))
    _, contributions, audits = cm.fill_contribution(t.changes.withColumn("contribution_id", missing))
    return contributions.join(audits, "audit_id").select("contribution_id", "ehr_id", "audit_id", "time_committed")


_KIND = "CASE event_type WHEN 'signup' THEN 'status' WHEN 'view' THEN 'folder' WHEN 'error' THEN 'party' ELSE 'composition' END"
_MIXED = f"""SELECT event_id AS change_id, {_KIND} AS kind, change_type, sys_version - 1 AS preceding_version, value > 10 AS has_data
 FROM events JOIN f_versions ON audit_id = event_id"""


def _kind():
    return (
        F.when(F.col("event_type") == "signup", "status").when(F.col("event_type") == "view", "folder")
        .when(F.col("event_type") == "error", "party").otherwise("composition")
    )


@query(
    "J12_commit_contribution",
    f"""SELECT change_id, reason, CASE WHEN reason IS NULL THEN CASE change_type WHEN 'creation' THEN 'create' WHEN 'deleted' THEN 'delete' ELSE 'update' END END AS action
        FROM (SELECT *, CASE WHEN kind = 'party' THEN 'unsupported object kind'
                WHEN NOT has_data AND change_type <> 'deleted' THEN 'metadata-only change may only delete'
                WHEN has_data AND kind = 'status' AND change_type = 'creation' THEN 'status cannot be created'
                WHEN kind = 'status' AND change_type = 'deleted' THEN 'status cannot be deleted' END AS reason FROM ({_MIXED}))""",
)
def _(t):
    e = t.table("events").select("event_id", _kind().alias("kind"), (F.col("value") > 10).alias("has_data"))
    rows = t.changes.join(e, F.col("event_id") == F.col("change_id"))
    return cm.split_contribution(rows).select("change_id", "reason", "action")


@query(
    "J13_create_owner",
    "SELECT ehr_id, TRUE AS is_queryable, TRUE AS is_modifiable FROM f_ehr",
)
def _(t):
    _, status = cm.create_owners(t.ehr)
    return status.select("ehr_id", "is_queryable", "is_modifiable")


@query(
    "J14_modifiable_gate",
    """SELECT e.event_id, CASE WHEN event_type = 'signup' THEN TRUE ELSE coalesce(
         last_value(CASE WHEN event_type = 'signup' THEN value > 50 END IGNORE NULLS) OVER (
           PARTITION BY user_id * 1000 + day(ts) ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), s.is_modifiable, FALSE) END AS allowed
       FROM events e LEFT JOIN f_status s ON s.ehr_id = e.user_id""",
)
def _(t):
    signup = F.col("event_type") == "signup"
    rows = t.table("events").select(
        "event_id", F.col("event_id").alias("position"), F.col("user_id").alias("ehr_id"),
        (F.col("user_id") * 1000 + F.dayofmonth("ts")).alias("contribution_id"),
        F.when(signup, "status").otherwise("composition").alias("kind"), F.when(signup, F.col("value") > 50).alias("new_modifiable"),
    )
    return cm.reject_unmodifiable(rows, t.status).select("event_id", "allowed")


_P = ids.TEMPLATE_VERSION_PATTERN
_NEW_TEMPLATE = """CASE p_partkey % 3 WHEN 0 THEN template_id WHEN 1 THEN replace(p_name, ' ', '_') || '.fr.v' || (p_size % 4) || '.1'
  ELSE 'other_' || replace(p_name, ' ', '_') END"""


def _part(alias: str, group: int) -> str:
    return f"CAST(nullif(regexp_extract({alias}, '{_P}', {group}), '') AS INT)"


@query(
    "J19_template_compatible",
    f"""WITH d AS (SELECT p_partkey AS vo_id, p_partkey, p_name, p_size, {_TEMPLATE} AS template_id FROM part),
        n AS (SELECT vo_id, template_id AS o, {_NEW_TEMPLATE} AS n FROM d),
        x AS (SELECT vo_id, o, n, regexp_extract(o, '{_P}', 1) AS ob, regexp_extract(n, '{_P}', 1) AS nb,
          {_part('o', 2)} AS o1, {_part('o', 3)} AS o2, {_part('o', 4)} AS o3, {_part('n', 2)} AS n1, {_part('n', 3)} AS n2, {_part('n', 4)} AS n3 FROM n)
        SELECT vo_id, CASE WHEN o = n THEN NULL WHEN ob <> nb THEN 'different template'
          WHEN CASE WHEN o1 IS NULL THEN FALSE WHEN n1 IS NULL THEN TRUE WHEN n1 <> o1 THEN n1 < o1
                    WHEN o2 IS NULL THEN FALSE WHEN n2 IS NULL THEN TRUE WHEN n2 <> o2 THEN n2 < o2
                    WHEN o3 IS NULL THEN FALSE WHEN n3 IS NULL THEN TRUE WHEN n3 <> o3 THEN n3 < o3 ELSE FALSE END THEN 'older template version' END AS reason
        FROM x""",
)
def _(t):
    head = t.table("part").select(F.col("p_partkey").alias("vo_id"), template_name().alias("template_id"), "p_name", "p_size")
    base = F.regexp_replace("p_name", " ", "_")
    new = (
        F.when(F.col("vo_id") % 3 == 0, F.col("template_id"))
        .when(F.col("vo_id") % 3 == 1, F.concat(base, F.lit(".fr.v"), F.col("p_size") % 4, F.lit(".1")))
        .otherwise(F.concat(F.lit("other_"), base))
    )
    changes = head.select("vo_id", new.alias("template_id"))
    return cm.reject_template_change(changes, head).select("vo_id", "reason")


@query(
    "I22_semver_is_older",
    """SELECT namespace, name, semver, CASE WHEN major <> 2 THEN major < 2 WHEN minor <> 5 THEN minor < 5 ELSE FALSE END AS older
       FROM (SELECT *, CAST(split_part(semver, '.', 1) AS INT) AS major, CAST(split_part(semver, '.', 2) AS INT) AS minor FROM f_definition)""",
)
def _(t):
    parts = ids.semver_parts(F.col("semver"))
    old = (F.lit(2), F.lit(5), F.lit(None).cast("int"))
    older = ids.is_older((parts["major"], parts["minor"], parts["patch"]), old)
    return t.definition.select("namespace", "name", "semver", older.alias("older"))


# ---------------------------------------------------------------------------------------------
# definitions and tags
# ---------------------------------------------------------------------------------------------

_SEM = "CAST(split_part(semver, '.', 1) AS INT) DESC, CAST(split_part(semver, '.', 2) AS INT) DESC, CAST(split_part(split_part(semver, '.', 3), '-', 1) AS INT) DESC, split_part(split_part(semver, '.', 3), '-', 2) DESC"


@query(
    "F2_latest_definition",
    f"""SELECT namespace, name, semver, text FROM (SELECT *, row_number() OVER (PARTITION BY namespace, name ORDER BY {_SEM}) AS rn
        FROM f_definition WHERE NOT contains(semver, '-')) WHERE rn = 1""",
)
def _(t):
    return reg.latest_definition(t.definition)


frame(
    "f_requests",
    """SELECT p_partkey AS change_id, p_brand AS namespace, p_type AS name, CASE p_partkey % 5 WHEN 0 THEN NULL
         WHEN 1 THEN CAST(p_size % 5 + 1 AS VARCHAR) WHEN 2 THEN CAST(p_size % 5 + 1 AS VARCHAR) || '.' || (p_partkey % 12)
         WHEN 3 THEN CAST(p_size % 4 + 1 AS VARCHAR) || '.' || (p_partkey % 12) || '.' || (p_partkey % 5)
         ELSE CAST(p_size % 4 + 1 AS VARCHAR) || '.' || (p_partkey % 12) || '.' || (p_partkey % 5) || '-beta' END AS version,
       'new ' || p_partkey AS text FROM part""",
)
frame(
    "f_resolved",
    f"""SELECT namespace, name, version, semver, text FROM (
          SELECT r.namespace, r.name, r.version, d.semver, d.text,
                 row_number() OVER (PARTITION BY r.namespace, r.name, r.version ORDER BY {_SEM.replace('semver', 'd.semver')}) AS rn
          FROM (SELECT DISTINCT namespace, name, version FROM f_requests) r LEFT JOIN f_definition d
            ON d.namespace = r.namespace AND d.name = r.name AND CASE WHEN r.version IS NULL THEN NOT contains(d.semver, '-')
               WHEN split_part(r.version, '.', 3) <> '' THEN d.semver = r.version
               ELSE starts_with(d.semver, r.version || '.') AND NOT contains(d.semver, '-') END) WHERE rn = 1""",
)
frame(
    "f_next",
    """SELECT r.change_id, r.namespace, r.name, r.version, r.text, s.semver AS stored, CASE
         WHEN r.version IS NULL THEN CASE WHEN s.semver IS NULL THEN '1.0.0' ELSE (CAST(split_part(s.semver, '.', 1) AS INT) + 1) || '.0.0' END
         WHEN split_part(r.version, '.', 2) = '' THEN r.version || '.' || CASE WHEN s.semver IS NULL THEN 0 ELSE CAST(split_part(s.semver, '.', 2) AS INT) + 1 END || '.0'
         WHEN split_part(r.version, '.', 3) = '' THEN r.version || '.' || CASE WHEN s.semver IS NULL THEN 0 ELSE CAST(split_part(s.semver, '.', 3) AS INT) + 1 END
         WHEN s.semver IS NOT NULL AND NOT contains(r.version, '-') THEN NULL ELSE r.version END AS semver
       FROM f_requests r LEFT JOIN f_resolved s ON s.namespace = r.namespace AND s.name = r.name AND s.version IS NOT DISTINCT FROM r.version""",
)


def _requests(t):
    k, size = F.col("p_partkey"), F.col("p_size")
    two = F.concat((size % 5 + 1).cast("string"), F.lit("."), k % 12)
    full = F.concat((size % 4 + 1).cast("string"), F.lit("."), k % 12, F.lit("."), k % 5)
    version = (
        F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, (size % 5 + 1).cast("string")).when(k % 5 == 2, two)
        .when(k % 5 == 3, full).otherwise(F.concat(full, F.lit("-beta")))
    )
    return t.table("part").select(
        k.alias("change_id"), F.col("p_brand").alias("namespace"), F.col("p_type").alias("name"), version.alias("version"),
        F.concat(F.lit("new "), k).alias("text"),
    )


@query("I23_semver_resolve", "SELECT namespace, name, version, semver, text FROM f_resolved")
def _(t):
    return reg.semver_resolve(t.definition, _requests(t))


@query("I24_semver_next", "SELECT DISTINCT namespace, name, version, semver AS next FROM f_next")
def _(t):
    found = reg.semver_resolve(t.definition, _requests(t))
    return found.select("namespace", "name", "version", ids.semver_next(F.col("version"), F.col("semver")).alias("next"))


@query(
    "J22_definition_upsert",
    """WITH first AS (SELECT namespace, name, semver, min(change_id) AS change_id FROM f_next WHERE semver IS NOT NULL GROUP BY namespace, name, semver),
       stored AS (SELECT n.namespace, n.name, n.semver, n.text FROM f_next n JOIN first f ON f.change_id = n.change_id)
       SELECT namespace, name, semver, text FROM f_definition d
       WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.namespace = d.namespace AND s.name = d.name AND s.semver = d.semver)
       UNION ALL SELECT namespace, name, semver, text FROM stored""",
)
def _(t):
    return reg.upsert_definitions(t.definition, _requests(t))[0]


@query(
    "J22_definition_rejects",
    """WITH first AS (SELECT namespace, name, semver, min(change_id) AS change_id FROM f_next WHERE semver IS NOT NULL GROUP BY namespace, name, semver)
       SELECT change_id, CASE WHEN semver IS NULL THEN 'version already exists' ELSE 'version taken by another change' END AS reason
       FROM f_next WHERE change_id NOT IN (SELECT change_id FROM first)""",
)
def _(t):
    return reg.upsert_definitions(t.definition, _requests(t))[1].select("change_id", "reason")


def _tag_changes(t):
    columns = ["change_id", "id", "new_id", "ehr_id", "target_vo_id", "target_type", "key", "value", "target_path"]
    d = F.col("doc_id")
    labels = t.table("labels").select(
        "*", (d % 50).alias("ehr_id"), d.alias("target_vo_id"), F.lit("COMPOSITION").alias("target_type"),
        F.lit(None).cast("string").alias("target_path"),
    )
    update = labels.filter("quality = 1").withColumns(
        {"change_id": d, "id": d * 2, "new_id": F.lit(None).cast("long"), "key": F.lit("quality"), "value": F.lit("gold")}
    )
    unknown = labels.filter("toxic = 1").withColumns(
        {"change_id": d + 1000000, "id": -d - 1, "new_id": F.lit(None).cast("long"), "key": F.lit("toxic"), "value": F.lit("x")}
    )
    insert = labels.withColumns(
        {"change_id": d + 2000000, "id": F.lit(None).cast("long"), "new_id": d * 2 + 1000000000, "key": F.lit("seen"), "value": F.lit(None).cast("string")}
    )
    return update.select(*columns).unionByName(unknown.select(*columns)).unionByName(insert.select(*columns))


@query(
    "J20_tag_upsert",
    """SELECT id, ehr_id, target_vo_id, key, CASE WHEN key = 'quality' AND value = '1' THEN 'gold' ELSE value END AS value,
              CASE WHEN key = 'quality' AND value = '1' THEN NULL ELSE target_path END AS target_path FROM f_item_tag
       UNION ALL SELECT doc_id * 2 + 1000000000, doc_id % 50, doc_id, 'seen', NULL, NULL FROM labels""",
)
def _(t):
    return reg.upsert_tags(t.item_tag, _tag_changes(t))[0].select("id", "ehr_id", "target_vo_id", "key", "value", "target_path")


@query("J20_tag_rejects", "SELECT doc_id + 1000000 AS change_id, 'tag not found' AS reason FROM labels WHERE toxic = 1")
def _(t):
    return reg.upsert_tags(t.item_tag, _tag_changes(t))[1].select("change_id", "reason")


@query("J21_tag_delete", "SELECT id, key, value FROM f_item_tag WHERE value <> '0'")
def _(t):
    keys = t.item_tag.filter("value = '0'").select("ehr_id", "target_vo_id", "target_type", "id")
    return reg.delete_tags(t.item_tag, keys).select("id", "key", "value")
