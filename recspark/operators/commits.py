"""Batches of commits applied to a system-versioned table in one job.

A change carries ``change_id, vo_id, ehr_id, change_type, preceding_version, committed_at`` and any payload.
Within a batch the changes of an object are chained by their preceding version. For one preceding version the
earliest change (time, then id) counts; a delete that would hit a deleted object gives way to the earliest change
that is no delete. Every step is an aggregation or an equi join on (object, version), or a running maximum in
blocks, so an object with very many changes is spread over tasks. The slim rows of the chain (object, version,
change id, times; no payload) are checkpointed between the steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark import model
from recspark.functions import ids
from recspark.operators.versions import all_versions, latest_version, strict_times
from recspark.plans.ordered import ordered, running_max
from recspark.plans.stable import stable

UPDATES = ("modification", "amendment")
LATEST = ["vo_id", "ehr_id", "sys_version", "sys_period_lower", "sys_deleted"]


@dataclass
class Commits:
    """Result of a batch: new head and history, the versions written, and the refused changes with reasons."""

    head: DataFrame
    history: DataFrame
    accepted: DataFrame
    rejects: DataFrame


@dataclass
class Delta:
    """What a batch changes: rows to add, and the few existing rows that get an end.

    ``head`` and ``history``: new rows. ``closed``: heads of touched objects, as the history rows they become.
    ``ended``: object, version and end of tombstones that a new version follows. ``latest``: the newest versions of the
    touched objects, which replace theirs.
    """

    closed: DataFrame
    ended: DataFrame
    head: DataFrame
    history: DataFrame
    latest: DataFrame
    accepted: DataFrame
    rejects: DataFrame


def change_rule_violation(change_type: Column, preceding: Column) -> Column:
    """Reason why a change is malformed, or NULL."""
    has = preceding.isNotNull() & (preceding > 0)
    return (
        F.when(~change_type.isin(*UPDATES, "creation", "deleted"), "change type not supported")
        .when((change_type == "creation") & has, "creation with preceding version")
        .when(change_type.isin(*UPDATES) & ~has, "preceding version missing")
        .when((change_type == "deleted") & ~has, "preceding version missing")
    )


def chain_commits(latest: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) for changes against ``latest(vo_id, ehr_id, sys_version, sys_period_lower, sys_deleted)``.

    Accepted rows are the changes plus ``sys_version, sys_period_lower, sys_period_upper, sys_deleted``.
    """
    model.require(changes, "change_id", "vo_id", "ehr_id", "change_type", "preceding_version", "committed_at")
    base = latest.select(
        "vo_id", F.col("ehr_id").alias("_owner"), F.col("sys_version").cast("int").alias("_v0"),
        F.col("sys_period_lower").alias("_lower0"), F.col("sys_deleted").alias("_deleted0"),
    )
    p = F.coalesce(F.col("preceding_version"), F.lit(0)).cast("int")
    rows = changes.join(base, "vo_id", "left").withColumns({"_p": p, "_v0": F.coalesce("_v0", F.lit(0))})
    early = (
        F.coalesce(
            change_rule_violation(F.col("change_type"), F.col("preceding_version")),
            F.when((F.col("change_type") == "creation") & (F.col("_v0") > 0), "object already exists"),
            F.when((F.col("_v0") > 0) & (F.col("_owner") != F.col("ehr_id")), "object does not exist"),
            F.when(F.col("_p") < F.col("_v0"), "not the latest version"),
        )
    )
    rows = rows.withColumn("_early", early)

    # per preceding version: earliest change that is no delete, earliest delete
    this = F.struct("committed_at", "change_id")
    delete = F.col("change_type") == "deleted"
    steps = rows.filter("_early IS NULL").groupBy("vo_id", "_p").agg(
        F.min(F.when(~delete, this)).alias("_n"), F.min(F.when(delete, this)).alias("_d"),
        F.first("_v0").alias("_v0"), F.first("_lower0").alias("_lower0"),
        F.first(F.coalesce("_deleted0", F.lit(False))).alias("_deleted0"),
    )
    # slim rows (one per object and version), read several times below
    steps = stable(steps)
    n, d = F.col("_n"), F.col("_d")
    delete_first = d.isNotNull() & (n.isNull() | (d < n))
    before = steps.select("vo_id", (F.col("_p") + 1).alias("_p"), F.lit(True).alias("_linked"))
    steps = steps.join(before, ["vo_id", "_p"], "left")
    gap = F.col("_linked").isNull() & (F.col("_p") > F.col("_v0"))
    steps = steps.withColumns({"_delete_first": delete_first, "_gap": gap})
    # runs of delete-first steps alternate between deleting and reviving, counted from the last step that is not
    steps = running_max(steps, ["vo_id"], "_p", {"_reset": F.when(~F.col("_delete_first"), F.col("_p"))}, inclusive=False)
    start = F.col("_v0") - 1 - F.col("_deleted0").cast("int")
    run = F.col("_p") - 1 - F.coalesce("_reset", start)
    gone = run % 2 == 1
    choice = F.when(~F.col("_delete_first"), n).when(gone, n).otherwise(d)
    steps = steps.withColumn("_choice", choice)
    broken = (F.col("_gap") | F.col("_choice").isNull()).cast("int")
    steps = running_max(steps, ["vo_id"], "_p", {"_broken": broken})
    chosen = steps.filter("_broken = 0").select(
        "vo_id", (F.col("_p") + 1).alias("sys_version"), F.col("_choice.change_id").alias("change_id"),
        F.col("_choice.committed_at").alias("sys_period_lower"), "_v0", "_lower0",
    )
    chosen = stable(chosen)

    # strictly increasing start times, counted on from the version before the batch
    first = chosen.filter("sys_version = _v0 + 1 AND _v0 > 0").select(
        "vo_id", F.col("_v0").alias("sys_version"), F.lit(None).cast(chosen.schema["change_id"].dataType).alias("change_id"),
        F.col("_lower0").alias("sys_period_lower"),
    )
    timed = strict_times(chosen.drop("_v0", "_lower0").unionByName(first)).filter("change_id IS NOT NULL")
    after = timed.select("vo_id", (F.col("sys_version") - 1).alias("sys_version"), F.col("sys_period_lower").alias("sys_period_upper"))
    timed = stable(timed.join(after, ["vo_id", "sys_version"], "left"))

    accepted = changes.join(timed.drop("vo_id"), "change_id").withColumn("sys_deleted", F.col("change_type") == "deleted")
    late = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when((F.col("_v0") == 0) & (F.col("_p") > 0), "object or preceding version does not exist")
        .otherwise("not the latest version")
    )
    rejects = rows.join(timed.select("change_id"), "change_id", "left_anti").select(*changes.columns, late.alias("reason"))
    return accepted, rejects


def commit_delta(head: DataFrame, latest: DataFrame, changes: DataFrame, history_columns: Sequence[str] | None = None) -> Delta:
    """What a batch of changes does to a table, without reading its history.

    ``latest`` has the newest version of every object, tombstones included (``vo_id, ehr_id, sys_version,
    sys_period_lower, sys_deleted``); ``latest_version`` makes it once, each delta says what replaces its rows. Only
    rows of touched objects are read from ``head`` and ``latest``.
    """
    touched = changes.select("vo_id").distinct()
    known = latest.select(*LATEST).join(touched, "vo_id", "left_semi")
    accepted, rejects = chain_commits(known, changes)
    columns = list(history_columns) if history_columns else [*head.columns, "sys_period_upper", "sys_deleted"]

    # the version before the batch ends where the first new one starts
    ends = accepted.groupBy("vo_id").agg(F.min("sys_period_lower").alias("_end"), F.min("sys_version").alias("_first"))
    closed = head.join(ends.select("vo_id", "_end"), "vo_id").withColumns({"sys_deleted": F.lit(False), "sys_period_upper": F.col("_end")})
    ended = known.filter("sys_deleted").join(ends, "vo_id").filter("sys_version = _first - 1")
    ended = ended.select("vo_id", "sys_version", F.col("_end").alias("sys_period_upper"))

    written = accepted.withColumn("_open", F.col("sys_period_upper").isNull() & ~F.col("sys_deleted"))
    kinds = {**{f.name: f.dataType for f in head.schema}, **{f.name: f.dataType for f in accepted.schema}}
    for c in {*head.columns, *columns} - set(written.columns):
        written = written.withColumn(c, F.lit(None).cast(kinds[c]))
    newest = latest_version(known.unionByName(accepted.select(*LATEST)))
    return Delta(
        closed=closed.select(*columns), ended=ended, head=written.filter("_open").select(*head.columns),
        history=written.filter("NOT _open").select(*columns), latest=newest.select(*LATEST), accepted=accepted, rejects=rejects,
    )


def apply_commits(head: DataFrame, history: DataFrame, changes: DataFrame, latest: DataFrame | None = None) -> Commits:
    """Create, update and delete objects from a batch of changes: the whole table afterwards.

    With ``latest`` (the newest version of every object) the versions of touched objects are not looked for in the history.
    """
    if latest is None:
        touched = changes.select("vo_id").distinct()
        latest = latest_version(all_versions(head, history).join(touched, "vo_id", "left_semi").select(*LATEST))
    delta = commit_delta(head, latest, changes, history.columns)
    ended = delta.ended.withColumnRenamed("sys_period_upper", "_end")
    old = history.join(ended, ["vo_id", "sys_version"], "left")
    old = old.withColumn("sys_period_upper", F.coalesce("_end", "sys_period_upper")).select(*history.columns)
    kept = head.join(delta.accepted.select("vo_id").distinct(), "vo_id", "left_anti").select(*head.columns)
    return Commits(
        head=kept.unionByName(delta.head), history=old.unionByName(delta.closed).unionByName(delta.history),
        accepted=delta.accepted, rejects=delta.rejects,
    )


def reject_stale(changes: DataFrame, head: DataFrame, owners: DataFrame | None = None, system: str | None = None) -> DataFrame:
    """Check each change alone against the current head: adds ``reason`` (NULL = the change may be applied).

    ``changes`` may carry ``preceding_vo_id`` and ``preceding_system`` of the uid it builds on.
    """
    current = head.select("vo_id", F.col("ehr_id").alias("_owner"), F.col("sys_version").alias("_head"))
    rows = changes.join(current, "vo_id", "left")
    reasons = []
    if owners is not None:
        known = owners.select("ehr_id").distinct().withColumn("_known", F.lit(True))
        rows = rows.join(known, "ehr_id", "left")
        reasons.append(F.when(F.col("_known").isNull(), "unknown owner"))
    reasons.append(F.when(F.col("_head").isNull() | (F.col("_owner") != F.col("ehr_id")), "unknown object"))
    if "preceding_vo_id" in changes.columns:
        reasons.append(F.when(F.col("preceding_vo_id") != F.col("vo_id"), "wrong id"))
    if system is not None and "preceding_system" in changes.columns:
        reasons.append(F.when(F.col("preceding_system") != system, "wrong system"))
    stale = F.col("preceding_version").isNull() | (F.col("preceding_version") != F.col("_head"))
    reasons.append(F.when(stale, "not the latest version"))
    return rows.select(*changes.columns, F.coalesce(*reasons).alias("reason"))


# ---------------------------------------------------------------------------------------------
# contributions and owners
# ---------------------------------------------------------------------------------------------


def _hash_id(prefix: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(prefix), key.cast("string")))


def fill_contribution(changes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Changes without a contribution get one, with an audit of its own: (changes, contributions, audits).

    Ids are text: the given id, or a hash of the change id, the same in every run.
    """
    missing = F.col("contribution_id").isNull()
    contribution = F.when(missing, _hash_id("contribution:", F.col("change_id"))).otherwise(F.col("contribution_id").cast("string"))
    filled = changes.withColumn("contribution_id", contribution)
    new = changes.filter(missing).select(
        _hash_id("contribution:", F.col("change_id")).alias("contribution_id"), "ehr_id",
        _hash_id("audit:", F.col("change_id")).alias("audit_id"), "change_type", "committed_at",
    )
    contributions = new.select("contribution_id", "ehr_id", "audit_id")
    audits = new.select("audit_id", "change_type", F.col("committed_at").alias("time_committed"), F.lit("CONTRIBUTION").alias("target_type"))
    return filled, contributions, audits


def split_contribution(changes: DataFrame) -> DataFrame:
    """Route a mixed batch: adds ``action`` (create, update, delete) and ``reason`` for changes that are refused.

    ``kind`` is composition, folder or status; ``has_data`` tells metadata-only rows, which may only delete.
    """
    model.require(changes, "kind", "change_type", "preceding_version", "has_data")
    kind, change_type = F.col("kind"), F.col("change_type")
    reason = F.coalesce(
        F.when(~kind.isin("composition", "folder", "status"), "unsupported object kind"),
        F.when(~F.col("has_data") & (change_type != "deleted"), "metadata-only change may only delete"),
        F.when(F.col("has_data") & (kind == "status") & (change_type == "creation"), "status cannot be created"),
        F.when((kind == "status") & (change_type == "deleted"), "status cannot be deleted"),
        change_rule_violation(change_type, F.col("preceding_version")),
    )
    action = F.when(change_type == "creation", "create").when(change_type == "deleted", "delete").otherwise("update")
    return changes.withColumn("reason", reason).withColumn("action", F.when(F.col("reason").isNull(), action))


def create_owners(owners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New owners with their default status: (ehr, status). Given status values are kept."""
    model.require(owners, "ehr_id", "creation_date")
    ehr = owners.select("ehr_id", "creation_date")

    def given(name: str, default, kind: str) -> Column:
        value = F.lit(default).cast(kind)
        return F.coalesce(F.col(name), value) if name in owners.columns else value

    status = owners.select(
        "ehr_id", given("subject_id", None, "string").alias("subject_id"), given("namespace", None, "string").alias("namespace"),
        given("is_queryable", True, "boolean").alias("is_queryable"), given("is_modifiable", True, "boolean").alias("is_modifiable"),
    )
    return ehr, status


def reject_unmodifiable(changes: DataFrame, status: DataFrame, limit: int | None = None) -> DataFrame:
    """Changes with ``allowed``: a status earlier in the same contribution decides, else the owner's status.

    ``changes`` has ``contribution_id, position, ehr_id, kind`` and ``new_modifiable`` for status rows. A change to
    a status itself is always allowed. Unknown owners are not allowed.
    """
    model.require(changes, "contribution_id", "position", "ehr_id", "kind", "new_modifiable")
    is_status = F.col("kind") == "status"
    seen = F.when(is_status, F.struct(F.col("position"), F.col("new_modifiable")))
    rows = ordered(changes, ["contribution_id"], ["position"], maxes={"_seen": seen}, limit=limit)
    rows = rows.join(status.select("ehr_id", F.col("is_modifiable").alias("_owner")), "ehr_id", "left")
    allowed = F.when(is_status, F.lit(True)).otherwise(
        F.when(F.col("_seen").isNotNull(), F.col("_seen.new_modifiable")).otherwise(F.col("_owner"))
    )
    return rows.select(*changes.columns, F.coalesce(allowed, F.lit(False)).alias("allowed"))


def reject_template_change(changes: DataFrame, head: DataFrame) -> DataFrame:
    """Updates with ``reason``: the template's base name must stay and its version must not go down."""
    rows = changes.join(head.select("vo_id", F.col("template_id").alias("_old")), "vo_id")
    new, old = ids.template_version(F.col("template_id")), ids.template_version(F.col("_old"))

    def numbers(parts):
        return parts["major"], parts["minor"], parts["patch"]

    reason = (
        F.when(F.col("template_id") == F.col("_old"), F.lit(None).cast("string"))
        .when(new["name"] != old["name"], "different template")
        .when(ids.is_older(numbers(new), numbers(old)), "older template version")
    )
    return rows.select(*changes.columns, F.col("_old").alias("old_template_id"), reason.alias("reason"))
