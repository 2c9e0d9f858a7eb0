"""Fixed values of the record model: node types, value types, codes, schemas."""

from __future__ import annotations

# ---------------------------------------------------------------------------------------------
# Results depend on these exact names, codes and patterns.
# ---------------------------------------------------------------------------------------------

ARCHETYPE_PREFIX = "openEHR-EHR-"
VERSION_ID_SEPARATOR = "::"
CHANGE_TYPE_TERMINOLOGY = "openehr"

# structural type -> types it may be placed under (empty = root of an object)
ALLOWED_PARENTS: dict[str, tuple[str, ...]] = {
    "COMPOSITION": (),
    "FOLDER": ("FOLDER",),
    "EHR_STATUS": (),
    "EVENT_CONTEXT": ("COMPOSITION",),
    "SECTION": ("COMPOSITION", "SECTION"),
    "GENERIC_ENTRY": ("COMPOSITION", "SECTION"),
    "ADMIN_ENTRY": ("COMPOSITION", "SECTION"),
    "OBSERVATION": ("COMPOSITION", "SECTION"),
    "INSTRUCTION": ("COMPOSITION", "SECTION"),
    "ACTION": ("COMPOSITION", "SECTION"),
    "EVALUATION": ("COMPOSITION", "SECTION"),
    "INSTRUCTION_DETAILS": ("ACTION",),
    "ACTIVITY": ("INSTRUCTION",),
    "HISTORY": ("OBSERVATION",),
    "POINT_EVENT": ("HISTORY",),
    "INTERVAL_EVENT": ("HISTORY",),
    "FEEDER_AUDIT": (
        "COMPOSITION", "FOLDER", "EHR_STATUS", "SECTION", "GENERIC_ENTRY", "ADMIN_ENTRY", "OBSERVATION",
        "INSTRUCTION", "ACTION", "EVALUATION", "ACTIVITY", "HISTORY", "POINT_EVENT", "INTERVAL_EVENT",
    ),
    "FEEDER_AUDIT_DETAILS": ("FEEDER_AUDIT",),
}
_ITEM_STRUCTURE_PARENTS = (
    "FOLDER", "EHR_STATUS", "FEEDER_AUDIT_DETAILS", "EVENT_CONTEXT", "ADMIN_ENTRY", "OBSERVATION", "INSTRUCTION",
    "ACTION", "EVALUATION", "INSTRUCTION_DETAILS", "ACTIVITY", "HISTORY", "POINT_EVENT", "INTERVAL_EVENT",
)
ALLOWED_PARENTS.update(
    {
        "ITEM_LIST": _ITEM_STRUCTURE_PARENTS,
        "ITEM_SINGLE": _ITEM_STRUCTURE_PARENTS,
        "ITEM_TABLE": _ITEM_STRUCTURE_PARENTS,
        "ITEM_TREE": _ITEM_STRUCTURE_PARENTS + ("GENERIC_ENTRY",),
        # nesting a type in itself is allowed for SECTION, FOLDER and CLUSTER
        "CLUSTER": ("ITEM_TABLE", "ITEM_TREE", "CLUSTER"),
        "ELEMENT": ("ITEM_LIST", "ITEM_SINGLE", "ITEM_TREE", "CLUSTER"),
    }
)

ALLOWED_PARENTS["FEEDER_AUDIT"] += ("ITEM_LIST", "ITEM_SINGLE", "ITEM_TABLE", "ITEM_TREE", "CLUSTER", "ELEMENT")

STRUCTURE_TYPES = tuple(ALLOWED_PARENTS)
# walked through, but without a row of their own
INTERMEDIATE_TYPES = ("INSTRUCTION_DETAILS", "FEEDER_AUDIT_DETAILS")
ROOT_TYPES = ("COMPOSITION", "FOLDER", "EHR_STATUS")

# abstract type -> concrete structural types
ABSTRACT_TYPES: dict[str, tuple[str, ...]] = {
    "CONTENT_ITEM": (
        "ACTION", "ADMIN_ENTRY", "EVALUATION", "GENERIC_ENTRY", "INSTRUCTION", "OBSERVATION", "SECTION",
    ),
    "ENTRY": ("ACTION", "ADMIN_ENTRY", "EVALUATION", "INSTRUCTION", "OBSERVATION"),
    "CARE_ENTRY": ("ACTION", "EVALUATION", "INSTRUCTION", "OBSERVATION"),
    "EVENT": ("INTERVAL_EVENT", "POINT_EVENT"),
    "ITEM_STRUCTURE": ("ITEM_LIST", "ITEM_SINGLE", "ITEM_TABLE", "ITEM_TREE"),
    "ITEM": ("CLUSTER", "ELEMENT"),
}

# change type -> code
CHANGE_TYPE_CODES: dict[str, str] = {
    "creation": "249",
    "amendment": "250",
    "modification": "251",
    "synthesis": "252",
    "Unknown": "253",
    "deleted": "523",
}

# ordered value types
NUMERIC_ORDERED = ("DV_ORDINAL", "DV_SCALE", "DV_PROPORTION", "DV_COUNT", "DV_QUANTITY")
TEMPORAL_ORDERED = ("DV_DATE", "DV_DATE_TIME", "DV_TIME", "DV_DURATION")
ORDERED_TYPES = NUMERIC_ORDERED + TEMPORAL_ORDERED

# seconds from 0001-01-01T00:00Z to the Unix epoch
EPOCH_OFFSET_SECONDS = 62135596800
# days of a year and of a month in a duration magnitude
DURATION_YEAR_DAYS = "365.24"
DURATION_MONTH_DAYS = "30.42"

NAMESPACE_PATTERN = r"^[a-zA-Z][a-zA-Z0-9-_:/&+?]*$"
TAG_KEY_PATTERN = r"^[a-zA-Z0-9/\-_:]*$"
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
MANDATORY_ATTRIBUTES = (
    "name", "archetype_node_id", "language", "category", "composer", "archetype_details", "template_id",
)


def concrete_types(*names: str) -> list[str]:
    """Concrete structural types for a mix of concrete and abstract names."""
    out: list[str] = []
    for name in names:
        if name in ABSTRACT_TYPES:
            out += [t for t in ABSTRACT_TYPES[name] if t not in out]
        elif name in ALLOWED_PARENTS:
            if name not in out:
                out.append(name)
        else:
            raise ValueError(f"unknown structural type: {name}")
    return out


def require(df, *columns: str) -> None:
    """Raise ValueError naming the first column that ``df`` lacks."""
    for c in columns:
        if c not in df.columns:
            raise ValueError(f"missing column: {c}")
