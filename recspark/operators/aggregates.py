"""Aggregates over paths; all of them combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions.ids import archetype_join, version_id
from recspark.functions.json_values import json_number, json_order_key


def agg_count(col: Column | None = None) -> Column:
    """COUNT(*) without a column, else the number of non-NULL values."""
    return F.count(F.lit(1)) if col is None else F.count(col)


def agg_count_distinct(*cols: Column) -> Column:
    """Distinct values; several columns count as one row value, also with NULL parts."""
    if len(cols) == 1:
        return F.count_distinct(cols[0])
    return F.count_distinct(F.struct(*cols))


def agg_min(col: Column) -> Column:
    return F.min(col)


def agg_max(col: Column) -> Column:
    return F.max(col)


def agg_avg(number: Column, scale: int = 6) -> Column:
    """Exact mean of a decimal column; values that are no numbers come in as NULL and are ignored."""
    return F.avg(number.cast("decimal(28,6)")).cast(f"decimal(38,{scale})")


def agg_sum(number: Column) -> Column:
    return F.sum(number)


def agg_min_json(value: Column) -> Column:
    """The smallest JSON value of a VARIANT column, by ``json_order_key``; missing values are skipped, a JSON null is not."""
    return F.min_by(value, json_order_key(value))


def agg_max_json(value: Column) -> Column:
    """The largest JSON value of a VARIANT column, by ``json_order_key``."""
    return F.max_by(value, json_order_key(value))


def agg_sum_json(value: Column) -> Column:
    """Exact sum of the numbers of a VARIANT column; other values are ignored, no number at all gives NULL."""
    return F.sum(json_number(value))


def agg_avg_json(value: Column, scale: int = 6) -> Column:
    """Exact mean of the numbers of a VARIANT column; other values are ignored, no number at all gives NULL."""
    number = json_number(value)
    return F.try_divide(F.sum(number), F.count(number)).cast(f"decimal(38,{scale})")


def _by(value: Column, key: Column, present: Column) -> Column:
    return F.max_by(value, F.when(present, key))


def agg_max_ordered(value: Column, magnitude: Column, *tiebreak: Column) -> Column:
    """The value with the largest magnitude; among equal ones the last by ``tiebreak``."""
    return _by(value, F.struct(magnitude, *tiebreak), magnitude.isNotNull())


def agg_min_ordered(value: Column, magnitude: Column, *tiebreak: Column) -> Column:
    """The value with the smallest magnitude; among equal ones the last by ``tiebreak``."""
    return _by(value, F.struct(-magnitude, *tiebreak), magnitude.isNotNull())


def agg_string(col: Column, sep: str = ",") -> Column:
    """Values joined by ``sep`` in value order, NULL shown as ``-``. For groups of a bounded number of values."""
    return F.array_join(F.sort_array(F.collect_list(F.coalesce(col.cast("string"), F.lit("-")))), sep)


def group_by_paths(
    df: DataFrame, keys: Sequence[Column | str], aggregates: Sequence[Column], order_magnitude: Column | None = None
) -> DataFrame:
    """Group by all projected paths; a magnitude that is only sorted by becomes a further key and is sorted by."""
    if order_magnitude is None:
        return df.groupBy(*keys).agg(*aggregates)
    grouped = df.groupBy(*keys, order_magnitude.alias("_order")).agg(*aggregates)
    return grouped.orderBy(F.col("_order").asc_nulls_last()).drop("_order")


@dataclass(frozen=True)
class Projected:
    """A projected path of a grouped query; its kind says what it is grouped by.

    ``column``: a plain path, by its value. ``uid``: a version's id, by object and version. ``archetype``: an archetype
    node id, by type and concept. ``object``: a whole node, by its key. ``constant``: a literal, by nothing.
    ``prefix`` is that of the node's columns (``o`` for ``o_num``).
    """

    kind: str
    out: str
    value: Column | None = None
    prefix: str = ""
    system: str = ""

    def _column(self, name: str) -> str:
        return f"{self.prefix}_{name}" if self.prefix else name

    def keys(self, df: DataFrame) -> dict[str, Column]:
        """The implicit group keys, by the column names they get."""
        if self.kind == "constant":
            return {}
        if self.kind == "column":
            return {f"_{self.out}": self.value}
        if self.kind == "uid":
            return {"_k_vo_id": F.col("vo_id"), "_k_sys_version": F.col("sys_version")}
        if self.kind == "archetype":
            names = [self._column(c) for c in ("rm_entity", "entity_concept")]
        elif self.kind == "object":
            # the index is fixed by the number, but stays at hand for rebuilding the object
            names = [c for c in (self._column(x) for x in ("num", "num_cap", "entity_idx")) if c in df.columns]
            return {"_k_vo_id": F.col("vo_id"), **{f"_k_{c}": F.col(c) for c in names}}
        else:
            raise ValueError(f"unknown kind of path: {self.kind}")
        return {f"_k_{c}": F.col(c) for c in names}

    def project(self, df: DataFrame) -> Column:
        """The path's value from the keys."""
        if self.kind == "constant":
            return self.value.alias(self.out)
        if self.kind == "column":
            return F.col(f"_{self.out}").alias(self.out)
        if self.kind == "uid":
            return version_id(F.col("_k_vo_id"), self.system, F.col("_k_sys_version")).alias(self.out)
        if self.kind == "archetype":
            return archetype_join(F.col(f"_k_{self._column('rm_entity')}"), F.col(f"_k_{self._column('entity_concept')}")).alias(self.out)
        return F.struct(*[F.col(k).alias(k.removeprefix("_k_").removeprefix(f"{self.prefix}_")) for k in self.keys(df)]).alias(self.out)


def group_by_projected(
    df: DataFrame, paths: Sequence[Projected], aggregates: Sequence[Column], order_magnitude: Column | None = None
) -> DataFrame:
    """Group by the keys that the projected paths imply; paths of one node or version share theirs.

    Two versions that are shown alike are still two groups, and so are two nodes. Without any key there is one row. A
    magnitude that is only sorted by becomes a further key and is sorted by.
    """
    keys: dict[str, Column] = {}
    for path in paths:
        keys.update(path.keys(df))
    if order_magnitude is not None:
        keys["_order"] = order_magnitude
    grouped = df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*aggregates)
    if order_magnitude is not None:
        grouped = grouped.orderBy(F.col("_order").asc_nulls_last())
    rest = [c for c in grouped.columns if c not in keys]
    return grouped.select(*[p.project(df) for p in paths], *rest)


def distinct_paths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows of the selected (comparable) columns."""
    return (df.select(*columns) if columns else df).distinct()


def collect_nodes(
    df: DataFrame, keys: Sequence[str], position: str, *data: str, start: Column | None = None, max_nodes: int = 1_000_000
) -> DataFrame:
    """Nodes of one object or subtree as an ordered array, one row per group.

    A group is one document. ``position`` is a node number counted from ``start`` (0); a number beyond
    ``max_nodes`` is an error raised before the group is gathered, nothing is cut.
    """
    offset = F.col(position) if start is None else F.col(position) - start
    too_large = F.raise_error(F.lit("group is too large for one document")).cast(df.schema[position].dataType)
    checked = df.withColumn(position, F.when(offset > max_nodes, too_large).otherwise(F.col(position)))
    return checked.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(position, *data))).alias("nodes"))


def exists_any(keys: DataFrame, *frames: DataFrame) -> DataFrame:
    """Which ``keys`` occur in any of the frames: adds a boolean column ``found``."""
    on = list(keys.columns)
    seen = None
    for f in frames:
        part = f.select(*on)
        seen = part if seen is None else seen.unionByName(part)
    found = seen.distinct().withColumn("_found", F.lit(True))
    return keys.join(found, on, "left").select(*on, F.coalesce("_found", F.lit(False)).alias("found"))


def is_any(*frames: DataFrame) -> DataFrame:
    """Whether any row exists in any frame: one row, reading at most one row of each."""
    rows = None
    for f in frames:
        part = f.select(F.lit(1).alias("x")).limit(1)
        rows = part if rows is None else rows.unionByName(part)
    return rows.agg((F.count(F.lit(1)) > 0).alias("found"))
