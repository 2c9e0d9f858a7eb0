"""Identifiers: version ids, archetype ids, change type codes, template and definition versions, ISO times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recspark import model
from recspark.functions.times import iso_text, micros_of_text, ntz_of_micros

# Fixed value: template id = name, optional language, optional version with one of several separators
TEMPLATE_VERSION_PATTERN = (
    r"^(.+?)(?:\.[a-zA-Z]{2}(?:-[a-zA-Z]{2})?)?"
    r"(?:[._ ][vV](0|[1-9]\d*)(?:\.(0|[1-9]\d*)(?:\.(0|[1-9]\d*))?)?)?$"
)


def version_id(vo: Column, system: str | Column, version: Column) -> Column:
    """``id::system::version``; NULL if the id is NULL."""
    system = F.lit(system) if isinstance(system, str) else system
    text = F.concat_ws(model.VERSION_ID_SEPARATOR, vo.cast("string"), system, version.cast("string"))
    return F.when(vo.isNotNull(), text)


def version_id_parts(text: Column) -> dict[str, Column]:
    parts = F.split(text, model.VERSION_ID_SEPARATOR)
    return {
        "object_id": F.get(parts, F.lit(0)),
        "system_id": F.get(parts, F.lit(1)),
        "version": F.get(parts, F.lit(2)).try_cast("int"),
    }


def archetype_join(rm: Column, concept: Column) -> Column:
    """Full archetype id if the concept starts with a dot, else the code itself."""
    return F.when(concept.startswith("."), F.concat(F.lit(model.ARCHETYPE_PREFIX), rm, concept)).otherwise(concept)


def archetype_split(node_id: Column) -> dict[str, Column]:
    pattern = "^" + model.ARCHETYPE_PREFIX + r"([A-Z_]+)(\..*)$"
    full = node_id.startswith(model.ARCHETYPE_PREFIX)
    return {
        "rm_type": F.when(full, F.nullif(F.regexp_extract(node_id, pattern, 1), F.lit(""))),
        "concept": F.when(full, F.nullif(F.regexp_extract(node_id, pattern, 2), F.lit(""))).otherwise(node_id),
    }


def case_map(col: Column, mapping: dict) -> Column:
    """Value -> value lookup; NULL for unknown values."""
    literals = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*literals), col)


def change_type_code(name: Column) -> Column:
    return case_map(name, model.CHANGE_TYPE_CODES)


def change_type_name(code: Column) -> Column:
    return case_map(code, {c: n for n, c in model.CHANGE_TYPE_CODES.items()})


def iso_format(ts: Column) -> Column:
    """A UTC time without zone as ISO text, with as many fraction digits as needed."""
    return iso_text(ts)


def iso_parse(text: Column) -> Column:
    """ISO text to UTC time without zone; NULL if unparsable."""
    return ntz_of_micros(micros_of_text(text))


def template_version(template_id: Column) -> dict[str, Column]:
    """Base name and version numbers of a template id; the language is ignored."""
    def group(i: int) -> Column:
        return F.nullif(F.regexp_extract(template_id, TEMPLATE_VERSION_PATTERN, i), F.lit(""))

    return {"name": group(1), "major": group(2).cast("int"), "minor": group(3).cast("int"), "patch": group(4).cast("int")}


def is_older(new: tuple[Column, Column, Column], old: tuple[Column, Column, Column]) -> Column:
    """Whether version ``new`` is lower than ``old``; a missing number of ``old`` ends the comparison."""
    result = F.lit(False)
    for n, o in reversed(list(zip(new, old))):
        result = F.when(o.isNull(), F.lit(False)).when(n.isNull(), F.lit(True)).when(n != o, n < o).otherwise(result)
    return result


def semver_parts(semver: Column) -> dict[str, Column]:
    """major, minor, patch as numbers, then the suffix; missing parts are NULL (suffix: empty)."""
    def number(text: Column) -> Column:
        return text.try_cast("int")

    third = F.split_part(semver, F.lit("."), F.lit(3))
    return {
        "major": number(F.split_part(semver, F.lit("."), F.lit(1))),
        "minor": number(F.split_part(semver, F.lit("."), F.lit(2))),
        "patch": number(F.split_part(third, F.lit("-"), F.lit(1))),
        "suffix": F.split_part(third, F.lit("-"), F.lit(2)),
    }


def semver_key(semver: Column) -> Column:
    """Sortable struct of a semantic version."""
    p = semver_parts(semver)
    return F.struct(*[c.alias(n) for n, c in p.items()])


def is_prerelease(semver: Column) -> Column:
    return semver.contains("-")


def semver_next(requested: Column, stored: Column) -> Column:
    """Version to store for a request, given the highest stored match; NULL on a conflict with a release.

    No request: next major; ``major`` only: next minor; ``major.minor``: next patch; full: itself.
    """
    r, s = semver_parts(F.coalesce(requested, F.lit(""))), semver_parts(F.coalesce(stored, F.lit("")))
    none = s["major"].isNull()

    def bump(part: Column, first: int) -> Column:
        return F.when(none, F.lit(first)).otherwise(part + 1)

    def text(major, minor, patch) -> Column:
        return F.concat_ws(".", major.cast("string"), minor.cast("string"), patch.cast("string"))

    zero = F.lit(0)
    conflict = ~none & ~is_prerelease(requested)
    return (
        F.when(r["major"].isNull(), text(bump(s["major"], 1), zero, zero))
        .when(r["minor"].isNull(), text(r["major"], bump(s["minor"], 0), zero))
        .when(r["patch"].isNull(), text(r["major"], r["minor"], bump(s["patch"], 0)))
        .when(conflict, F.lit(None).cast("string"))
        .otherwise(requested)
    )
