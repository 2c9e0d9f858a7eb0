"""Sort orders. NULLs sort last ascending and first descending, everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark import model
from recspark.functions.ids import case_map, change_type_code, semver_key


def direction(col: Column, descending: bool = False) -> Column:
    return col.desc_nulls_first() if descending else col.asc_nulls_last()


def order_by(df: DataFrame, keys: Sequence[tuple[Column | str, str]]) -> DataFrame:
    """Sort by (column, 'asc'|'desc')."""
    out = []
    for col, how in keys:
        if how not in ("asc", "desc"):
            raise ValueError(f"unknown direction: {how}")
        out.append(direction(F.col(col) if isinstance(col, str) else col, how == "desc"))
    return df.orderBy(*out)


def magnitude_key(magnitude: Column, descending: bool = False) -> list[Column]:
    return [direction(magnitude, descending)]


def archetype_keys(rm: Column, concept: Column, descending: bool = False) -> list[Column]:
    """Codes before archetypes, archetypes by type name, then concept."""
    ranks = {name: i for i, name in enumerate(sorted(model.STRUCTURE_TYPES))}
    archetyped = concept.like(".%")
    keys = [archetyped, F.when(archetyped, case_map(rm, ranks)), concept]
    return [direction(k, descending) for k in keys]


def with_template_order(df: DataFrame, template: DataFrame, out: str = "template_order") -> DataFrame:
    """Sort key of the template name in English collation; unknown uids get NULL."""
    names = template.select("template_uid", F.collate("template_id", "en_USA").alias(out))
    return df.join(names, "template_uid", "left")


def change_type_keys(change_type: Column, by: str = "value", descending: bool = False) -> list[Column]:
    """By lower-case value or by numeric code."""
    key = change_type_code(change_type) if by == "code" else F.lower(change_type)
    return [direction(key, descending)]


def semver_order(semver: Column, descending: bool = False) -> Column:
    key = semver_key(semver)
    return key.desc() if descending else key.asc()


def collated(name: Column) -> Column:
    """Name in the collation in which names compare."""
    return F.collate(name, "en_USA")


def limit_offset(df: DataFrame, n: int | None = None, m: int = 0) -> DataFrame:
    """LIMIT n OFFSET m of a sorted frame."""
    if m:
        df = df.offset(m)
    return df if n is None else df.limit(n)
