"""Paths that are answered from relational columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark import model
from recspark.functions import ids


def x_name_value(df: DataFrame) -> Column:
    return df["entity_name"]


def x_uid_value(df: DataFrame, system: str) -> Column:
    return ids.version_id(df["vo_id"], system, df["sys_version"])


def x_root_concept(df: DataFrame) -> Column:
    return F.concat(F.lit(model.ARCHETYPE_PREFIX + "COMPOSITION"), df["root_concept"])


def x_archetype_node_id(df: DataFrame) -> Column:
    return ids.archetype_join(df["rm_entity"], df["entity_concept"])


def with_template_id(df: DataFrame, template: DataFrame, out: str = "template_id") -> DataFrame:
    """Template uid to name; unknown uids give NULL."""
    names = template.select("template_uid", F.col("template_id").alias(out))
    return df.join(names, "template_uid", "left")


def x_ehr_id(df: DataFrame) -> Column:
    return df["ehr_id"]


def x_ehr_system(system: str) -> Column:
    return F.lit(system)


def x_ehr_system_object(system: str) -> Column:
    return F.struct(F.lit("HIER_OBJECT_ID").alias("_type"), F.lit(system).alias("value"))


def x_ehr_created(df: DataFrame) -> Column:
    return ids.iso_format(df["creation_date"])


def x_contribution_id(df: DataFrame) -> Column:
    return df["contribution_id"]


def x_time_committed(df: DataFrame) -> Column:
    return ids.iso_format(df["sys_period_lower"])


def date_time_object(ts: Column) -> Column:
    return F.struct(F.lit("DV_DATE_TIME").alias("_type"), ids.iso_format(ts).alias("value"))


def x_audit_system(system: str) -> Column:
    return F.lit(system)


def x_audit_description(df: DataFrame) -> Column:
    return df["description"]


def text_object(text: Column) -> Column:
    return F.when(text.isNotNull(), F.struct(F.lit("DV_TEXT").alias("_type"), text.alias("value")))


def x_change_type(change_type: Column) -> dict[str, Column]:
    """The sub-paths of a commit's change type."""
    value = F.lower(change_type)
    return {
        "value": value,
        "code_string": ids.change_type_code(change_type),
        "preferred_term": value,
        "terminology_id": F.lit(model.CHANGE_TYPE_TERMINOLOGY),
    }
