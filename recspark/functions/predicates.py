"""Column predicates with the literal rules of the record model.

Literals whose type does not fit a column are dropped first; a comparison left without literals is constant:
``=`` and ``MATCHES`` are FALSE, ``!=`` is TRUE.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
import re
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark import model

_OPS = {
    "=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}
ORDER_OPS = ("<", "<=", ">", ">=")


def _false() -> Column:
    return F.lit(False)


def _true() -> Column:
    return F.lit(True)


def any_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.or_, conditions) if conditions else _false()


def all_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.and_, conditions) if conditions else _true()


def _as_list(values) -> list:
    return list(values) if isinstance(values, (list, tuple, set, frozenset)) else [values]


def _fits(kind: str, v) -> bool:
    if kind == "text":
        return isinstance(v, str)
    if kind == "number":
        return isinstance(v, (int, float, Decimal)) and not isinstance(v, bool)
    if kind == "boolean":
        return isinstance(v, bool)
    if kind == "timestamp":
        return isinstance(v, dt.datetime)
    raise ValueError(f"unknown column kind: {kind}")


def _constant(op: str) -> Column:
    if op in ("=", "MATCHES", "LIKE"):
        return _false()
    if op == "!=":
        return _true()
    raise ValueError(f"{op} needs one literal")


def compare(col: Column, op: str, values, kind: str) -> Column:
    """``col op literal`` for a column of ``kind`` (text, number, boolean, timestamp); MATCHES takes many."""
    values = _as_list(values)
    if op in ORDER_OPS:
        (value,) = values
        if _fits(kind, value):
            return _OPS[op](col, F.lit(value))
        # a literal of another type: only the order of the types counts
        mine, other = _TYPE_RANK[kind if kind != "timestamp" else "text"], _rank_of(value)
        return F.when(col.isNotNull(), F.lit(_OPS[op](mine, other)))
    fitting = [v for v in values if _fits(kind, v)]
    if not fitting:
        return _constant(op)
    if op == "MATCHES":
        return col.isin(fitting)
    if len(fitting) > 1:
        raise ValueError(f"{op} needs one literal")
    return _OPS[op](col, F.lit(fitting[0]))


def matches(col: Column, values: Sequence, kind: str = "text") -> Column:
    return compare(col, "MATCHES", list(values), kind)


def matches_frame(df: DataFrame, column: str, values: DataFrame, value_column: str) -> DataFrame:
    """MATCHES against a long list held in a frame: a semi join."""
    return df.join(values.select(F.col(value_column).alias(column)), column, "left_semi")


# order of JSON types: null < string < number < boolean < array < object
_TYPE_RANK = {"null": 0, "text": 1, "number": 2, "boolean": 3, "array": 4, "object": 5}


def _rank_of(value) -> int:
    if isinstance(value, bool):
        return _TYPE_RANK["boolean"]
    if isinstance(value, (int, float, Decimal)):
        return _TYPE_RANK["number"]
    if isinstance(value, str):
        return _TYPE_RANK["text"]
    raise ValueError(f"unsupported literal: {value!r}")


def json_is_number(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def json_type_rank(value: Column) -> Column:
    """Rank of a VARIANT scalar's type; NULL for a missing value."""
    kind = F.schema_of_variant(value)
    number = json_is_number(value)
    return (
        F.when(kind == "VOID", _TYPE_RANK["null"]).when(kind == "STRING", _TYPE_RANK["text"])
        .when(number, _TYPE_RANK["number"]).when(kind == "BOOLEAN", _TYPE_RANK["boolean"])
        .when(kind.startswith("ARRAY"), _TYPE_RANK["array"]).when(kind.startswith("OBJECT"), _TYPE_RANK["object"])
    )


def compare_json(value: Column, op: str, literal) -> Column:
    """Compare a VARIANT scalar with a literal: by type first, by value within one type."""
    rank, mine = json_type_rank(value), _rank_of(literal)
    if isinstance(literal, bool):
        typed, lit = F.try_variant_get(value, "$", "boolean"), F.lit(literal)
    elif isinstance(literal, str):
        typed, lit = F.try_variant_get(value, "$", "string"), F.lit(literal)
    else:
        typed = F.try_variant_get(value, "$", "decimal(38,9)")
        lit = F.lit(Decimal(str(literal))).cast("decimal(38,9)")
    return F.when(rank == mine, _OPS[op](typed, lit)).otherwise(_OPS[op](rank, F.lit(mine)))


def like_pattern(pattern: str) -> str:
    """``*`` any text, ``?`` one character, ``\\`` escapes ``* ? \\``; the result is a SQL LIKE pattern."""
    out, chars = [], iter(pattern)
    for c in chars:
        if c in "%_":
            out.append("\\" + c)
        elif c == "*":
            out.append("%")
        elif c == "?":
            out.append("_")
        elif c == "\\":
            escaped = next(chars, None)
            if escaped is None or escaped not in "*?\\":
                raise ValueError(f"invalid LIKE pattern: {pattern}")
            out.append("\\\\" if escaped == "\\" else escaped)
        else:
            out.append(c)
    return "".join(out)


def like_text(col: Column, pattern: str) -> Column:
    return col.like(like_pattern(pattern))


def like_json(value: Column, pattern: str) -> Column:
    """LIKE on a VARIANT: JSON strings only, other types never match, a missing value stays NULL."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return F.when(value.isNull(), F.lit(None).cast("boolean")).otherwise((kind == "STRING") & text.like(like_pattern(pattern)))


def exists(col: Column) -> Column:
    return col.isNotNull()


# ---------------------------------------------------------------------------------------------
# ordered values
# ---------------------------------------------------------------------------------------------

_DURATION = re.compile(
    r"^(-)?P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"
)
_HIGH_PRECISION_DATE_TIME = re.compile(r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}|\d{8}T\d{6})\.\d+(Z|[+-]\d{2}:?\d{2})?$")
_HIGH_PRECISION_TIME = re.compile(r"^(\d{2}:\d{2}:\d{2})\.\d+(Z|[+-]\d{2}:?\d{2})?$")


def duration_seconds(text: str) -> Decimal | None:
    """Magnitude of an ISO duration; None if ``text`` is not one."""
    m = _DURATION.match(text)
    if not m or text.lstrip("-") in ("P", "PT") or text.endswith("T"):
        return None
    sign, y, mo, w, d, h, mi, s = m.groups()
    days = Decimal(y or 0) * Decimal(model.DURATION_YEAR_DAYS) + Decimal(mo or 0) * Decimal(model.DURATION_MONTH_DAYS)
    days += Decimal(w or 0) * 7 + Decimal(d or 0)
    seconds = days * 86400 + Decimal(h or 0) * 3600 + Decimal(mi or 0) * 60 + Decimal(s or 0)
    return -seconds if sign else seconds


def _temporal_of_text(text: str):
    try:
        if _HIGH_PRECISION_DATE_TIME.match(text):
            return dt.datetime.fromisoformat(text)
        if _HIGH_PRECISION_TIME.match(text):
            return dt.time.fromisoformat(text)
    except ValueError:
        pass
    return None


def _date_time_magnitude(value: dt.datetime) -> Decimal:
    value = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return Decimal((value - epoch) // dt.timedelta(seconds=1)) + model.EPOCH_OFFSET_SECONDS


def _ordered_literals(value, types: set[str], equality: bool) -> list[tuple[str, Decimal]]:
    """(type, magnitude) pairs a literal can be compared with."""
    if isinstance(value, str):
        out = []
        parsed = _temporal_of_text(value)
        if parsed is not None:
            out += _ordered_literals(parsed, types, equality)
        seconds = duration_seconds(value)
        if seconds is not None and "DV_DURATION" in types:
            out.append(("DV_DURATION", seconds))
        return out
    if isinstance(value, dt.datetime):
        out = []
        if not equality and "DV_DATE" in types:
            out.append(("DV_DATE", Decimal(value.date().toordinal() - 1)))
        if "DV_DATE_TIME" in types:
            out.append(("DV_DATE_TIME", _date_time_magnitude(value)))
        return out
    if isinstance(value, dt.date):
        out = [("DV_DATE", Decimal(value.toordinal() - 1))]
        out.append(("DV_DATE_TIME", _date_time_magnitude(dt.datetime(value.year, value.month, value.day))))
        return [x for x in out if x[0] in types]
    if isinstance(value, dt.time):
        seconds = Decimal(value.hour * 3600 + value.minute * 60 + value.second) + Decimal(value.microsecond) / 1_000_000
        return [("DV_TIME", seconds)] if "DV_TIME" in types else []
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return [("number", Decimal(str(value)))] if types & set(model.NUMERIC_ORDERED) else []
    return []


def compare_ordered(type_col: Column, magnitude: Column, op: str, values, types: Sequence[str] = model.ORDERED_TYPES) -> Column:
    """Compare ordered values by magnitude, restricted to the types a literal fits; none fits: FALSE."""
    if op not in _OPS and op != "MATCHES":
        raise ValueError(f"{op} on ordered values is not supported")
    allowed = set(types)
    by_type: dict[str, list[Decimal]] = {}
    for value in _as_list(values):
        for kind, m in _ordered_literals(value, allowed, op in ("=", "MATCHES")):
            if m not in by_type.setdefault(kind, []):
                by_type[kind].append(m)
    conditions = []
    for kind, literals in by_type.items():
        members = [t for t in types if t in model.NUMERIC_ORDERED] if kind == "number" else [kind]
        lits = [F.lit(m).cast("decimal(38,9)") for m in literals]
        if op == "MATCHES":
            test = magnitude.isin(lits)
        else:
            (lit,) = lits
            test = _OPS[op](magnitude, lit)
        conditions.append(type_col.isin(members) & test)
    return any_of(conditions)


def timestamp_literal(text: str) -> dt.datetime | None:
    """ISO text to UTC time without zone: no offset = UTC, date only = start of the day, unparsable = None."""
    try:
        value = dt.datetime.fromisoformat(text)
    except ValueError:
        return None
    return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def compare_time(col: Column, op: str, texts) -> Column:
    """Compare a zone-less UTC timestamp column with ISO texts."""
    parsed = [t for t in (timestamp_literal(x) for x in _as_list(texts)) if t is not None]
    if not parsed:
        return _constant(op)
    lits = [F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in parsed]
    if op == "MATCHES":
        return any_of([col == x for x in lits])
    (lit,) = lits
    return _OPS[op](col, lit)


# ---------------------------------------------------------------------------------------------
# identifiers
# ---------------------------------------------------------------------------------------------

def parse_uid(text: str, system: str | None = None) -> tuple[str, int | None]:
    """``id`` or ``id::system::version``; a foreign system or a malformed id is an error."""
    parts = text.split(model.VERSION_ID_SEPARATOR)
    if len(parts) == 1 and parts[0]:
        return parts[0], None
    if len(parts) == 3 and parts[0] and re.fullmatch(r"[1-9]\d*", parts[2]):
        if system is not None and parts[1] != system:
            raise ValueError(f"foreign system in {text}")
        return parts[0], int(parts[2])
    raise ValueError(f"not a valid uid: {text}")


def uid_predicate(vo: Column, version: Column, op: str, ids, system: str | None = None, id_type: str = "bigint") -> Column:
    """``uid`` compared with ids with or without version; order is lexicographic on (id, version)."""
    parsed = [parse_uid(i, system) for i in _as_list(ids)]
    if not parsed:
        return _constant("=" if op == "MATCHES" else op)

    def one(vo_lit, v):
        key = F.lit(vo_lit).cast(id_type)
        return (vo, key) if v is None else (F.struct(vo.alias("a"), version.alias("b")), F.struct(key.alias("a"), F.lit(v).alias("b")))

    if op in ("MATCHES", "NOT MATCHES"):
        plain = [F.lit(i).cast(id_type) for i, v in parsed if v is None]
        cond = []
        if plain:
            cond.append(vo.isin(plain))
        cond += [(vo == F.lit(i).cast(id_type)) & (version == v) for i, v in parsed if v is not None]
        return any_of(cond) if op == "MATCHES" else ~any_of(cond)
    (pair,) = parsed
    if pair[1] is not None and op in ("=", "!="):
        same = (vo == F.lit(pair[0]).cast(id_type)) & (version == pair[1])
        return same if op == "=" else ~same
    left, right = one(*pair)
    return _OPS[op](left, right)


def split_archetype(node_id: str) -> tuple[str | None, str]:
    """(type, concept) of an archetype id, (None, code) of an ``at``/``id`` code."""
    if node_id.startswith(model.ARCHETYPE_PREFIX):
        rest = node_id[len(model.ARCHETYPE_PREFIX):]
        rm, dot, concept = rest.partition(".")
        if not dot:
            raise ValueError(f"archetype id is not valid: {node_id}")
        if rm not in model.ALLOWED_PARENTS:
            raise ValueError(f"archetype id of an unknown type: {node_id}")
        return rm, "." + concept
    if node_id.startswith(("at", "id")):
        return None, node_id
    raise ValueError(f"invalid node id: {node_id}")


def archetype_predicate(rm: Column, concept: Column, op: str, ids) -> Column:
    """Node id = : type and concept; != : type or concept differs; codes check the concept only."""
    conds = []
    for node_id in _as_list(ids):
        kind, name = split_archetype(node_id)
        if op in ("=", "MATCHES"):
            conds.append((concept == name) if kind is None else ((rm == kind) & (concept == name)))
        elif op == "!=":
            conds.append((concept != name) if kind is None else ((rm != kind) | (concept != name)))
        else:
            raise ValueError(f"{op} on node ids is not supported")
    return any_of(conds) if op != "!=" else all_of(conds)


def root_concept_predicate(root_concept: Column, op: str, ids) -> Column:
    """Node id of an object's root: ids of other types are dropped."""
    split = [split_archetype(i) for i in _as_list(ids)]
    return compare(root_concept, op, [c for kind, c in split if kind == "COMPOSITION"], "text")


def template_predicate(uid: Column, template: DataFrame, op: str, names) -> Column:
    """Template name compared through the name -> uid table; unknown names are dropped."""
    if op not in ("=", "!=", "MATCHES"):
        raise ValueError(f"{op} on template names is not supported")
    # at most one uid per given name
    uids = template.filter(F.col("template_id").isin(_as_list(names))).agg(F.collect_set("template_uid").alias("u")).scalar()
    found = F.array_contains(uids, uid)
    if op == "!=":
        return F.when(F.size(uids) == 0, F.lit(True)).otherwise(F.when(uid.isNotNull(), ~found))
    return F.when(F.size(uids) == 0, F.lit(False)).otherwise(F.when(uid.isNotNull(), found))


def name_predicate(name: Column, value: str) -> Column:
    return name == value


def owner_predicate(col: Column, op: str, ids, id_type: str = "bigint") -> Column:
    """Owner id; texts that are no ids of ``id_type`` (bigint or uuid) are dropped."""
    pattern = r"-?\d+" if id_type == "bigint" else model.UUID_PATTERN
    good = [str(i) for i in _as_list(ids) if re.fullmatch(pattern, str(i))]
    if not good:
        return _constant(op)
    typed = [int(i) for i in good] if id_type == "bigint" else [i.lower() for i in good]
    if op == "MATCHES":
        return col.isin(typed)
    (value,) = typed
    return _OPS[op](col, F.lit(value))


def bracket(*or_of_and: Sequence[Column]) -> Column:
    """``[a AND b OR c]``: each argument is one AND list."""
    return any_of([all_of(list(group)) for group in or_of_and])


def change_type_predicate(col: Column, op: str, values, by: str = "value") -> Column:
    """Change type by ``value`` (literal name) or by ``code``; unknown values are dropped."""
    if by == "code":
        names = {code: name for name, code in model.CHANGE_TYPE_CODES.items()}
    else:
        names = {name: name for name in model.CHANGE_TYPE_CODES}
        names["unknown"] = "Unknown"
    return compare(col, op, [names[v] for v in _as_list(values) if v in names], "text")


def type_filter(col: Column, *names: str) -> Column:
    """Structural type filter; abstract names stand for their concrete types."""
    return col.isin(model.concrete_types(*names))
