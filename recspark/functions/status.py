"""Values of an owner's status document."""

from __future__ import annotations

from pyspark.sql import Column

from recspark.functions.json_values import json_path


def subject_paths(data: Column) -> dict[str, Column]:
    """Subject id, its namespace and the modifiable flag."""
    return {
        "subject_id": json_path(data, "subject.external_ref.id.value", "string"),
        "namespace": json_path(data, "subject.external_ref.namespace", "string"),
        "is_modifiable": json_path(data, "is_modifiable", "boolean"),
    }
