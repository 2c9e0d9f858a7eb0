"""Access to values inside a node's JSON (VARIANT) column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions.predicates import json_is_number, json_type_rank

NUMBER_TYPE = "decimal(38,9)"


def _path(path: str) -> str:
    return "$" + "".join(f".{p}" for p in path.split(".") if p)


def parse(text: Column) -> Column:
    """JSON text to VARIANT; NULL if malformed."""
    return F.try_parse_json(text)


def json_path(value: Column, path: str, as_type: str = "variant") -> Column:
    """Single-valued attribute path; NULL if it is missing or of another type."""
    return F.try_variant_get(value, _path(path), as_type)


def json_get(value: Column, path: str) -> Column:
    return json_path(value, path, "variant")


def json_get_text(value: Column, path: str) -> Column:
    """Scalar at ``path`` as text."""
    return json_path(value, path, "string")


def json_extract_path_text(text: Column, *path: str) -> Column:
    """The same straight from JSON text."""
    return F.get_json_object(text, "$" + "".join(f".{p}" for p in path))


def json_array(value: Column, path: str = "") -> Column:
    """Array at ``path`` as ARRAY<VARIANT>; NULL if it is no array."""
    return F.try_variant_get(value, _path(path), "array<variant>")


def json_path_multi(
    df: DataFrame, column: str, path: str, out: str, position: str | None = None, condition: Column | None = None
) -> DataFrame:
    """One row per element of the array at ``path``; a missing or empty array keeps the row with NULL.

    ``condition`` filters the rows before they multiply. Nested arrays: call again on ``out``.
    """
    if condition is not None:
        df = df.filter(condition)
    elements = json_array(F.col(column), path)
    if position:
        return df.select("*", F.posexplode_outer(elements).alias(position, out))
    return df.select("*", F.explode_outer(elements).alias(out))


def json_set(value: Column, attribute: str, new: Column) -> Column:
    """Put an attribute into a JSON object, replacing an existing one."""
    members = F.try_variant_get(value, "$", "map<string,variant>")
    kept = F.map_filter(members, lambda k, _: k != F.lit(attribute))
    added = F.create_map(F.lit(attribute), F.try_parse_json(F.to_json(F.struct(new.alias("x")))).cast("variant"))
    added = F.transform_values(added, lambda _, v: F.try_variant_get(v, "$.x", "variant"))
    return F.to_variant_object(F.map_concat(kept, added))


def json_number(value: Column, kind: str = NUMBER_TYPE) -> Column:
    """A JSON number as an exact decimal; NULL for every other type, also for text that reads like a number.

    Digits beyond the ninth decimal are rounded; a number that does not fit is an error, never left out.
    """
    return F.when(json_is_number(value), F.variant_get(value, "$", kind))


def json_order_key(value: Column) -> Column:
    """A struct that sorts VARIANT values as JSON: null < string < number < boolean < array < object, then by value.

    Texts go by code points. Numbers are compared as doubles first, which never reverses their order, and as decimals
    where doubles are equal. Arrays and objects go by their size, then by their text. NULL for a missing value.
    """
    rank = json_type_rank(value)
    number, text = json_is_number(value), F.schema_of_variant(value) == "STRING"
    exact = [F.when(number, F.try_variant_get(value, "$", f"decimal(38,{scale})")) for scale in (0, 18)]
    size = F.coalesce(F.size(F.try_variant_get(value, "$", "array<variant>")), F.size(F.try_variant_get(value, "$", "map<string,variant>")))
    key = F.struct(
        rank.alias("rank"), F.when(number, F.try_variant_get(value, "$", "double")).alias("double"), exact[0].alias("whole"), exact[1].alias("parts"),
        F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean")).alias("flag"),
        F.when(~number & ~text, size).alias("size"), F.when(text, F.try_variant_get(value, "$", "string")).when(~number, F.to_json(value)).alias("text"),
    )
    return F.when(rank.isNotNull(), key)


def array_to_json(array: Column) -> Column:
    return F.to_json(array)


def scalar_to_json(value: Column) -> Column:
    """JSON of a scalar; NULL stays NULL."""
    return F.when(value.isNotNull(), F.regexp_extract(F.to_json(F.struct(value.alias("x"))), r'^\{"x":(.*)\}$', 1))
