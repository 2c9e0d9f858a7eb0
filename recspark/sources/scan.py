"""Scans of the record frames; filters and columns are pushed into the files by Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark import model
from recspark.functions.ids import semver_key

NODE_KINDS = {"composition": "COMPOSITION", "status": "EHR_STATUS", "folder": "FOLDER"}


def scan_nodes(
    nodes: DataFrame, kind: str = "composition", types: Sequence[str] | None = None, attribute: str | None = None
) -> DataFrame:
    """Head node rows of one object kind, restricted to structural types and an attribute.

    ``nodes`` holds one kind, or several told apart by a column ``kind``.
    """
    if kind not in NODE_KINDS:
        raise ValueError(f"unknown object kind: {kind}")
    if "kind" in nodes.columns:
        nodes = nodes.filter(F.col("kind") == kind)
    if types is not None:
        nodes = nodes.filter(F.col("rm_entity").isin(model.concrete_types(*types)))
    if attribute is not None:
        nodes = nodes.filter(F.col("entity_attribute") == attribute)
    return nodes


def scan_roots(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.col("num") == 0)


def scan_versions(version_head: DataFrame) -> DataFrame:
    model.require(version_head, "vo_id", "ehr_id", "sys_version", "sys_period_lower")
    return version_head


def scan_ehr(ehr: DataFrame) -> DataFrame:
    return ehr.select("ehr_id", "creation_date")


def scan_audit(audit: DataFrame) -> DataFrame:
    return audit.select("audit_id", "description", "change_type")


def scan_history(version_history: DataFrame, node_history: DataFrame) -> DataFrame:
    """Old versions with their node rows."""
    return version_history.join(node_history, ["vo_id", "sys_version"])


def scan_tags(
    tags: DataFrame, owner, target, target_type: str, ids: Sequence | None = None, keys: Sequence[str] | None = None
) -> DataFrame:
    """Tags of one target, optionally by tag id and key."""
    found = tags.filter(
        (F.col("ehr_id") == owner) & (F.col("target_vo_id") == target) & (F.col("target_type") == target_type)
    )
    if ids:
        found = found.filter(F.col("id").isin(list(ids)))
    if keys:
        found = found.filter(F.col("key").isin(list(keys)))
    return found


def scan_definitions(definitions: DataFrame, namespace: str | None = None, name: str | None = None) -> DataFrame:
    """Stored definitions by namespace and name; by name, newest version first."""
    if namespace is not None:
        definitions = definitions.filter(F.col("namespace") == namespace)
    if name is not None:
        definitions = definitions.filter(F.col("name") == name)
    return definitions.orderBy("namespace", "name", semver_key(F.col("semver")).desc())
