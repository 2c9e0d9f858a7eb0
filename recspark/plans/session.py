"""Session settings the operators are written for."""

from __future__ import annotations

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # joins on object or owner split the partition of a hot key by themselves
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # only small dimension tables are broadcast; node frames look small on disk and are not
    "spark.sql.autoBroadcastJoinThreshold": "512KB",
}


def configure(builder):
    """Apply the settings to a SparkSession builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
