"""Folders of an owner as of a time or a version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.contains import folder_by_path
from recspark.operators.versions import version_at


def folder_at(folders: DataFrame, versions: DataFrame, at, path: str = "/") -> DataFrame:
    """Folder at ``path`` in the folder tree that was valid at a time, or in version number ``at`` (int).

    ``versions`` are the folder tree's versions by owner. If ``folders`` has a ``sys_version`` column, it holds the
    nodes of every version and the matching ones are read; deleted versions have no folders.
    """
    valid = versions.filter(F.col("sys_version") == at) if isinstance(at, int) else version_at(versions, at)
    valid = valid.filter(~F.col("sys_deleted")).select("ehr_id", "vo_id", "sys_version")
    if "sys_version" in folders.columns:
        live = folders.join(valid, ["ehr_id", "sys_version"], "left_semi")
        return folder_by_path(live, path).join(valid, "ehr_id")
    return folder_by_path(folders, path).join(valid, "ehr_id")
