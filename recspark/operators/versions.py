"""Reads of system-versioned tables.

Neighbouring versions are found by their number (an equi join on object and version), never by gathering all
versions of an object in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark import model
from recspark.functions import ids
from recspark.functions.times import micros, of_micros
from recspark.plans.ordered import ordered, running_max

VERSION = ["vo_id", "sys_version"]


def all_versions(head: DataFrame, history: DataFrame) -> DataFrame:
    """Head rows, open and not deleted, together with history rows."""
    upper = history.schema["sys_period_upper"].dataType
    head = head.withColumn("sys_period_upper", F.lit(None).cast(upper)).withColumn("sys_deleted", F.lit(False))
    return head.unionByName(history)


def union_versions(head: DataFrame, history: DataFrame) -> DataFrame:
    """Head and history restricted to their common columns."""
    common = [c for c in head.columns if c in history.columns]
    return head.select(*common).unionByName(history.select(*common))


def union_kinds(kinds: Mapping[str, DataFrame]) -> DataFrame:
    """Versions of several object kinds, tagged, ordered by id and version."""
    out = None
    for kind, versions in kinds.items():
        part = versions.withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("vo_id", "sys_version")


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def with_data(versions: DataFrame, nodes: DataFrame) -> DataFrame:
    """Version rows with their node rows."""
    return versions.join(nodes.hint("merge"), "vo_id")


def with_audit(versions: DataFrame, audit: DataFrame, how: str = "inner") -> DataFrame:
    """Version rows with their commit audit; ``how='left'`` allows a missing audit."""
    return versions.join(audit, "audit_id", how)


def latest_version(versions: DataFrame) -> DataFrame:
    """Highest version per object, over head and history."""
    rest = [c for c in versions.columns if c != "vo_id"]
    latest = versions.groupBy("vo_id").agg(F.max_by(F.struct(*rest), "sys_version").alias("_v"))
    return latest.select("vo_id", "_v.*")


def _neighbour(versions: DataFrame, step: int, columns: Mapping[str, str]) -> DataFrame:
    """Columns of the version ``step`` before each version, keyed by that version."""
    return versions.select(
        "vo_id", (F.col("sys_version") + step).cast("int").alias("sys_version"),
        *[F.col(c).alias(out) for out, c in columns.items()],
    )


def fill_period_upper(versions: DataFrame) -> DataFrame:
    """Set each version's end to its successor's start; a tombstone starts where its predecessor ended."""
    before = _neighbour(versions, 1, {"_pred_upper": "sys_period_upper"})
    repaired = versions.join(before, VERSION, "left").withColumn(
        "sys_period_lower",
        F.when(F.col("sys_deleted") & F.col("_pred_upper").isNotNull(), F.col("_pred_upper")).otherwise(F.col("sys_period_lower")),
    ).drop("_pred_upper")
    after = _neighbour(repaired, -1, {"_next_lower": "sys_period_lower"})
    filled = repaired.join(after, VERSION, "left")
    return filled.withColumn("sys_period_upper", F.coalesce("_next_lower", "sys_period_upper")).drop("_next_lower").select(*versions.columns)


def strict_times(versions: DataFrame, time: str = "sys_period_lower") -> DataFrame:
    """Make start times strictly increase: a version not later than its predecessor starts 1 microsecond after it.

    With ``u = time - version * 1us`` this fold is the running maximum of ``u`` by version.
    """
    kind = versions.schema[time].dataType
    u = micros(F.col(time), kind) - F.col("sys_version")
    rows = running_max(versions, ["vo_id"], "sys_version", {"_u": u})
    fixed = of_micros(F.col("_u") + F.col("sys_version"), kind)
    return rows.withColumn(time, fixed).select(*versions.columns)


def version_at(versions: DataFrame, at) -> DataFrame:
    """Version valid at a time, tombstones included: a literal or a Column of the row."""
    t = at if isinstance(at, Column) else F.lit(at).cast(versions.schema["sys_period_lower"].dataType)
    lower, upper = F.col("sys_period_lower"), F.col("sys_period_upper")
    return versions.filter((lower <= t) & (upper.isNull() | (upper > t)))


def version_at_keys(versions: DataFrame, keys: DataFrame, limit: int | None = None) -> DataFrame:
    """Version valid per row of ``keys(vo_id, at)``; rows without a valid version are dropped.

    Versions and keys are put in one time order per object; the last start before a key names its version, which
    is then fetched by number. No pair of a key and another version is ever built.
    """
    starts = versions.select("vo_id", F.col("sys_period_lower").alias("at"), F.lit(0).alias("_kind"), F.col("sys_version").alias("_version"))
    asked = keys.withColumns({"_kind": F.lit(1), "_version": F.lit(None).cast("int")})
    both = asked.unionByName(starts, allowMissingColumns=True)
    found = ordered(both, ["vo_id"], ["at", "_kind"], maxes={"sys_version": "_version"}, limit=limit)
    found = found.filter("_kind = 1 AND sys_version IS NOT NULL").drop("_kind", "_version")
    rows = found.join(versions, VERSION)
    return rows.filter(F.col("sys_period_upper").isNull() | (F.col("sys_period_upper") > F.col("at")))


def version_n(versions: DataFrame, keys: DataFrame) -> DataFrame:
    """Exact version per row of ``keys(vo_id, sys_version)`` with a status: found, deleted or not found."""
    rest = [c for c in versions.columns if c not in VERSION]
    found = versions.withColumn("_hit", F.lit(True))
    joined = keys.join(found, VERSION, "left")
    status = F.when(F.col("_hit").isNull(), "not found").when(F.col("sys_deleted"), "deleted").otherwise("found")
    return joined.select(*keys.columns, status.alias("status"), *[c for c in rest if c not in keys.columns])


def revision_history(versions: DataFrame, audit: DataFrame) -> DataFrame:
    """All versions with their audits, by object and version; a missing audit keeps the row."""
    audit = audit.select(*[c for c in audit.columns if c == "audit_id" or c not in versions.columns])
    return with_audit(versions, audit, "left").orderBy("vo_id", "sys_version")


def original_version(versions: DataFrame, audit: DataFrame, contribution: DataFrame, system: str) -> DataFrame:
    """Version with audit, contribution and the uid of its predecessor (NULL for version 1)."""
    audit = audit.select(*[c for c in audit.columns if c == "audit_id" or c not in versions.columns])
    contribution = contribution.select("contribution_id", F.col("ehr_id").alias("contribution_ehr_id"))
    rows = with_audit(versions, audit).join(contribution, "contribution_id")
    before = F.col("sys_version") - 1
    return rows.withColumns(
        {
            "uid": ids.version_id(F.col("vo_id"), system, F.col("sys_version")),
            "preceding_uid": F.when(before > 0, ids.version_id(F.col("vo_id"), system, before)),
        }
    )


def contribution_contents(kinds: Mapping[str, DataFrame], contributions: DataFrame | None = None) -> DataFrame:
    """Versions written by contributions, over all object kinds."""
    rows = union_kinds(kinds).select("contribution_id", "kind", "vo_id", "sys_version")
    return rows if contributions is None else rows.join(contributions.select("contribution_id"), "contribution_id", "left_semi")


def object_header(versions: DataFrame) -> DataFrame:
    """Owner and creation time of each object, from its first version."""
    first = versions.filter("sys_version = 1")
    return first.select("vo_id", "ehr_id", F.col("sys_period_lower").alias("time_created"))


def inconsistent_objects(versions: DataFrame, owner: str = "ehr_id") -> DataFrame:
    """Objects of owners that have more than one object id, over head and history.

    Smallest and largest id per owner decide; the pairs of ids are never built.
    """
    model.require(versions, owner, "vo_id")
    spread = versions.groupBy(owner).agg(F.min("vo_id").alias("_lo"), F.max("vo_id").alias("_hi")).filter("_lo <> _hi")
    return versions.join(spread.select(owner), owner, "left_semi").select(owner, "vo_id").distinct()


def find_by_subject(status: DataFrame, subjects: DataFrame) -> DataFrame:
    """Owners by (subject_id, namespace)."""
    return status.join(subjects.select("subject_id", "namespace").distinct(), ["subject_id", "namespace"]).select(
        "ehr_id", "subject_id", "namespace"
    )


def duplicate_subjects(status: DataFrame) -> DataFrame:
    """(subject_id, namespace) pairs of more than one owner."""
    rows = status.filter("subject_id IS NOT NULL AND namespace IS NOT NULL")
    counts = rows.groupBy("subject_id", "namespace").agg(F.count(F.lit(1)).alias("owners"))
    return counts.filter("owners > 1")


def template_usage(template: DataFrame, *versions: DataFrame) -> DataFrame:
    """Templates that any head or history object uses."""
    used = None
    for v in versions:
        part = v.select("template_id")
        used = part if used is None else used.unionByName(part)
    return template.join(used.distinct(), "template_id", "left_semi")


def purge(frames: Mapping[str, DataFrame], keys: DataFrame) -> dict[str, DataFrame]:
    """Frames without the rows of the given objects or owners (the columns of ``keys`` decide)."""
    on = list(keys.columns)
    return {name: frame.join(keys, on, "left_anti") for name, frame in frames.items()}
