"""Stored definitions with semantic versions, and item tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark import model
from recspark.functions.ids import is_prerelease, semver_key, semver_next, semver_parts

NAME = ["namespace", "name"]


def latest_definition(definitions: DataFrame) -> DataFrame:
    """Highest release version per name; pre-releases do not count."""
    model.require(definitions, "namespace", "name", "semver", "text")
    releases = definitions.filter(~is_prerelease(F.col("semver")))
    best = releases.groupBy(*NAME).agg(F.max_by(F.struct("semver", "text"), semver_key(F.col("semver"))).alias("_d"))
    return best.select(*NAME, "_d.semver", "_d.text")


def semver_resolve(definitions: DataFrame, requests: DataFrame) -> DataFrame:
    """Stored version for each distinct ``requests(namespace, name, version)``; NULL if there is none.

    A full version matches exactly; a missing or partial one the highest matching release.
    """
    asked = requests.select(*NAME, "version").distinct()
    stored = definitions.select(*NAME, F.col("semver").alias("_semver"), F.col("text").alias("_text"))
    v = F.coalesce(F.col("version"), F.lit(""))
    full = semver_parts(v)["patch"].isNotNull()
    # exact matches are an equi join, prefixes too: a stored release answers to its own three prefixes
    parts = F.split("_semver", r"\.")
    prefixes = F.when(
        ~is_prerelease(F.col("_semver")), F.array(F.lit(""), F.get(parts, F.lit(0)), F.concat_ws(".", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))
    ).otherwise(F.array().cast("array<string>"))
    answers = stored.select("*", F.explode(F.array_append(prefixes, F.col("_semver"))).alias("_key"))
    best = answers.groupBy(*NAME, "_key").agg(F.max_by(F.struct("_semver", "_text"), semver_key(F.col("_semver"))).alias("_b"))
    keyed = asked.withColumn("_key", F.when(full, F.col("version")).otherwise(v))
    return keyed.join(best, [*NAME, "_key"], "left").select(*NAME, "version", F.col("_b._semver").alias("semver"), F.col("_b._text").alias("text"))


def upsert_definitions(definitions: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Store ``changes(change_id, namespace, name, version, text)``: (definitions, rejects).

    Releases are immutable, pre-releases are replaced, partial versions store the next one. Of several changes
    of a batch that lead to the same version, the one with the lowest id is stored.
    """
    model.require(changes, "change_id", "namespace", "name", "version", "text")
    found = semver_resolve(definitions, changes).select(
        F.col("namespace").alias("_ns"), F.col("name").alias("_n"), F.col("version").alias("_v"), F.col("semver").alias("_stored")
    )
    same = (F.col("namespace") == F.col("_ns")) & (F.col("name") == F.col("_n")) & F.col("version").eqNullSafe(F.col("_v"))
    rows = changes.join(found, same).drop("_ns", "_n", "_v")
    rows = rows.withColumn("semver", semver_next(F.col("version"), F.col("_stored")))
    good = rows.filter("semver IS NOT NULL")
    first = good.groupBy(*NAME, "semver").agg(F.min("change_id").alias("change_id"))
    stored = good.join(first, [*NAME, "semver", "change_id"]).select(*NAME, "semver", "text")
    kept = definitions.select(*NAME, "semver", "text").join(stored.select(*NAME, "semver"), [*NAME, "semver"], "left_anti")
    refused = rows.join(first.select("change_id"), "change_id", "left_anti")
    reason = F.when(F.col("semver").isNull(), "version already exists").otherwise("version taken by another change")
    return kept.unionByName(stored), refused.select(*changes.columns, reason.alias("reason"))


def upsert_tags(tags: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insert tags without id, update tags with one: (tags, rejects).

    ``changes`` has the columns of ``tags`` and ``change_id``; a new tag's id comes from ``new_id``. An id that does
    not exist is refused. The last change (by ``change_id``) of one id counts.
    """
    columns = tags.columns
    last = changes.filter("id IS NOT NULL").groupBy("id").agg(F.max_by(F.struct(*[c for c in changes.columns if c != "id"]), "change_id").alias("_c"))
    updates = last.select("id", "_c.*")
    changed = updates.join(tags.select("id"), "id", "left_semi").select(*columns)
    unknown = changes.filter("id IS NOT NULL").join(tags.select("id"), "id", "left_anti")
    inserts = changes.filter("id IS NULL").withColumn("id", F.col("new_id")).select(*columns)
    kept = tags.join(changed.select("id"), "id", "left_anti").select(*columns)
    return kept.unionByName(changed).unionByName(inserts), unknown.select(*changes.columns, F.lit("tag not found").alias("reason"))


def delete_tags(tags: DataFrame, keys: DataFrame) -> DataFrame:
    """Tags without those named by ``keys(ehr_id, target_vo_id, target_type, id)``."""
    return tags.join(keys, ["ehr_id", "target_vo_id", "target_type", "id"], "left_anti").select(*tags.columns)
