"""Data checks: input frame -> violations ``(key columns, path, rule, message)``."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark import model
from recspark.operators.commits import change_rule_violation
from recspark.operators.versions import inconsistent_objects


def _violations(df: DataFrame, key: Sequence[str], rules: Sequence[tuple[Column, str, str, Column | str]]) -> DataFrame:
    """One row per broken rule (condition, path, rule, message); one pass over the rows."""
    found = [
        F.when(cond, F.struct(F.lit(path).alias("path"), F.lit(rule).alias("rule"), (F.lit(m) if isinstance(m, str) else m).cast("string").alias("message")))
        for cond, path, rule, m in rules
    ]
    return df.select(*key, F.explode(F.array_compact(F.array(*found))).alias("_v")).select(*key, "_v.path", "_v.rule", "_v.message")


def check_mandatory(docs: DataFrame, key: Sequence[str] = ("vo_id",), attributes: Sequence[str] = model.MANDATORY_ATTRIBUTES) -> DataFrame:
    """Attributes that must exist."""
    model.require(docs, *key, *attributes)
    rules = [(F.col(a).isNull(), f"/{a}", "mandatory", f"missing mandatory attribute: {a}") for a in attributes]
    return _violations(docs, key, rules)


def check_namespace(status: DataFrame) -> DataFrame:
    """A subject's namespace, if present, has the allowed form."""
    bad = ~F.col("namespace").rlike(model.NAMESPACE_PATTERN)
    return _violations(status, ["ehr_id"], [(bad, "/subject/external_ref/namespace", "pattern", F.concat(F.lit("invalid namespace: "), "namespace"))])


def check_contribution(contribution: DataFrame, changes: DataFrame) -> DataFrame:
    """Contributions have versions; the client must not set commit time or contribution of a version."""
    rules = []
    if "client_time_committed" in changes.columns:
        rules.append((F.col("client_time_committed").isNotNull(), "/audit/time_committed", "must be null", "time_committed must not be set"))
    if "client_contribution" in changes.columns:
        rules.append((F.col("client_contribution").isNotNull(), "/version/contribution", "must be null", "contribution must not be set"))
    key = ["contribution_id"]
    empty = contribution.join(changes.select(*key), key, "left_anti").select(
        *key, F.lit("/versions").alias("path"), F.lit("cardinality").alias("rule"), F.lit("versions must not be empty").alias("message")
    )
    return empty.unionByName(_violations(changes, key, rules)) if rules else empty


def check_change_rules(changes: DataFrame) -> DataFrame:
    """Change type and preceding version fit together."""
    reason = change_rule_violation(F.col("change_type"), F.col("preceding_version"))
    return _violations(changes, ["change_id"], [(reason.isNotNull(), "/preceding_version_uid", "change rule", reason)])


def check_tag(tags: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Key, value and path of tags are well-formed; owner and type match the target ``(vo_id, ehr_id, kind)``."""
    key, value, path = F.col("key"), F.col("value"), F.col("target_path")
    blank_key = key.isNull() | (F.trim(key) == "")
    rules = [
        (blank_key, "/key", "not blank", "key must not be blank"),
        (~blank_key & ~key.rlike(model.TAG_KEY_PATTERN), "/key", "characters", F.concat(F.lit("invalid characters in key: "), key)),
        (F.trim(value) == "", "/value", "not blank", "value must not be blank"),
        (~path.startswith("/"), "/target_path", "starts at root", F.concat(F.lit("path does not start at root: "), path)),
        (path == "/", "/target_path", "not the root", "path must not be the root itself"),
    ]
    if targets is not None:
        t = targets.select(F.col("vo_id").alias("target_vo_id"), F.col("ehr_id").alias("_owner"), F.col("kind").alias("_kind"))
        tags = tags.join(t, "target_vo_id", "left")
        rules += [
            (F.col("_owner").isNull(), "/target", "exists", "target does not exist"),
            (F.col("_owner") != F.col("ehr_id"), "/owner_id", "owner", "owner does not match the target"),
            (F.col("_kind") != F.col("target_type"), "/target_type", "type", "type does not match the target"),
        ]
    return _violations(tags, ["id"], rules)


def expand_value_set(value_sets: DataFrame, uri: str) -> DataFrame:
    """(system, code, display) of one value set."""
    return value_sets.filter(F.col("uri") == uri).select("system", "code", "display")


def check_codes(values: DataFrame, value_sets: DataFrame, mode: str, key: Sequence[str]) -> DataFrame:
    """Coded values ``(uri, system, code)`` against ``value_sets(uri, system, code)``.

    ``mode='code_system'``: the value's system is the uri and the code exists in it. ``mode='value_set'``: the code
    matches an entry of the set; a single match must also have the value's system.
    """
    uri, system, code = F.col("uri"), F.col("system"), F.col("code")
    missing = uri.isNull() | (uri == "")
    no_url = (missing, "/", "url", "missing value-set url")
    if mode == "code_system":
        known = value_sets.select(F.col("system").alias("_s"), F.col("code").alias("_c")).distinct().withColumn("_known", F.lit(True))
        rows = values.join(known, (system == F.col("_s")) & (code == F.col("_c")), "left")
        other = ~missing & ~system.eqNullSafe(uri)
        return _violations(rows, key, [
            no_url,
            (other, "/terminology_id", "system", F.concat(F.lit("the terminology "), F.coalesce(system, F.lit("null")), F.lit(" must be "), uri)),
            (~missing & ~other & F.col("_known").isNull(), "/code_string", "code", F.concat(F.lit("unknown code "), code)),
        ])
    if mode != "value_set":
        raise ValueError(f"unknown mode: {mode}")
    entries = value_sets.groupBy(F.col("uri").alias("_u"), F.col("code").alias("_c")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("system").alias("_system")
    )
    rows = values.join(entries, (uri == F.col("_u")) & (code == F.col("_c")), "left")
    return _violations(rows, key, [
        no_url,
        (~missing & F.col("_n").isNull(), "/code_string", "code",
         F.concat(F.lit("the value "), code, F.lit(" does not match any option from value set "), uri)),
        ((F.col("_n") == 1) & ~system.eqNullSafe(F.col("_system")), "/terminology_id", "system",
         F.concat(F.lit("the terminology "), F.coalesce(system, F.lit("null")), F.lit(" must be "), F.col("_system"))),
    ])


def _known(columns: Sequence[str]) -> Column:
    """No column is null: as in a join, null matches nothing."""
    return functools.reduce(operator.and_, [F.col(c).isNotNull() for c in columns])


def _allowed_pairs() -> list[str]:
    return [f"{parent}>{child}" for child, parents in model.ALLOWED_PARENTS.items() for parent in parents]


def check_structure(nodes: DataFrame, key: Sequence[str] = ("vo_id",)) -> DataFrame:
    """The type of every node may stand under the type of its parent; roots are root types.

    A node whose parent has no row (``parent_num`` -1) is of a type that may stand under such a parent.
    """
    num = F.col("num")
    # Every node stands once at its own number, there without num, and once at its parent's, so nodes that lie by object are
    # not moved to find each other. Roots stand there without a parent.
    none = F.lit(None).cast(nodes.schema["num"].dataType)
    at = F.array(F.struct(none.alias("num"), num.alias("at")), F.struct(num.alias("num"), F.when(num > 0, F.col("parent_num")).alias("at")))
    rows = nodes.select(*key, "rm_entity", F.explode(at).alias("_r")).select(*key, "_r.num", "rm_entity", F.col("_r.at").alias("_at"))
    above = F.collect_list(F.when(num.isNull(), F.struct("rm_entity"))).over(Window.partitionBy(*key, "_at"))
    rows = rows.withColumn("_above", F.when(_known([*key, "_at"]), above)).filter("num >= 0")
    # a parent that stands twice is found twice
    rows = rows.select(*key, "num", "rm_entity", "_at", F.explode_outer("_above").alias("_p")).withColumn("_parent", F.col("_p.rm_entity"))
    pair = F.concat_ws(">", F.col("_parent"), F.col("rm_entity"))
    detached = F.col("_at") == -1
    may_be = [t for t, parents in model.ALLOWED_PARENTS.items() if set(parents) & set(model.INTERMEDIATE_TYPES)]
    return _violations(rows, [*key, "num"], [
        ((num > 0) & F.col("_parent").isNull() & ~detached, "/", "parent", "parent does not exist"),
        ((num > 0) & detached & ~F.col("rm_entity").isin(may_be), "/", "type", F.concat(F.lit("not allowed without a parent: "), F.col("rm_entity"))),
        ((num > 0) & F.col("_parent").isNotNull() & ~pair.isin(_allowed_pairs()), "/", "type", F.concat(F.lit("not allowed: "), pair)),
        ((num == 0) & ~F.col("rm_entity").isin(*model.ROOT_TYPES), "/", "root type", F.concat(F.lit("not a root: "), F.col("rm_entity"))),
    ])


def check_tree(nodes: DataFrame, key: Sequence[str] = ("vo_id",)) -> DataFrame:
    """Numbers are dense from 0 with one root, and every interval lies inside its parent's.

    A node whose parent has no row (``parent_num`` -1) lies inside the root's.
    """
    num, cap, parent = F.col("num"), F.col("num_cap"), F.col("parent_num")
    rows = nodes.select(*key, "num", "num_cap", F.when(parent == -1, 0).otherwise(parent).alias("parent_num"))
    own = [
        (num < 0, "/", "number", "negative number"),
        (cap < num, "/", "cap", "num_cap below num"),
        ((num > 0) & (parent >= num), "/", "parent", "parent_num not below num"),
    ]
    # every node stands once at its own number and once at its parent's, so no join is needed
    at = F.explode(F.array(F.struct(F.lit(False).alias("child"), num.alias("at")), F.struct(F.lit(True).alias("child"), F.col("parent_num").alias("at"))))
    nested = rows.withColumn("_r", at).withColumns({"_child": F.col("_r.child"), "_at": F.col("_r.at")}).drop("_r")
    above = F.max(F.when(~F.col("_child"), cap)).over(Window.partitionBy(*key, "_at"))
    nested = nested.withColumn("_cap", F.when(_known([*key, "_at"]), above)).filter("_child")
    inside = (num > 0) & (F.col("_cap").isNull() | (cap > F.col("_cap")))
    per_node = _violations(nested, [*key, "num"], [*own, (inside, "/", "nesting", "not inside the parent's interval")])
    # dense and unique: as many rows as the largest number says, each number once
    repeated = rows.groupBy(*key, "num").agg(F.count(F.lit(1)).alias("_n"))
    per_object = repeated.groupBy(*key).agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_numbers"), F.max("num").alias("_max"), F.min("num").alias("_min"),
        F.sum(F.when(num == 0, F.col("_n")).otherwise(0)).alias("_roots"),
    )
    objects = _violations(per_object.withColumn("num", F.lit(0)), [*key, "num"], [
        (F.col("_roots") != 1, "/", "root", "not exactly one root"),
        ((F.col("_numbers") != F.col("_max") + 1) | (F.col("_min") != 0), "/", "dense", "numbers are not dense"),
        (F.col("_rows") != F.col("_numbers"), "/", "unique", "number occurs twice"),
    ])
    return per_node.unionByName(objects)


def check_object_identity(kinds: Mapping[str, DataFrame], owners: Mapping[str, str] | None = None) -> DataFrame:
    """One object id per owner and kind, over all versions."""
    owners = owners or {}
    out = None
    for kind, versions in kinds.items():
        owner = owners.get(kind, "ehr_id")
        part = inconsistent_objects(versions, owner).select(F.col(owner).alias("owner"), "vo_id").withColumns(
            {"path": F.lit("/"), "rule": F.lit("identity"), "message": F.lit(f"inconsistent {kind} found")}
        )
        out = part if out is None else out.unionByName(part)
    return out


def check_periods(versions: DataFrame) -> DataFrame:
    """Versions follow each other without gap; a tombstone starts where its predecessor ends."""
    on = ["vo_id", "sys_version"]
    after = versions.select("vo_id", (F.col("sys_version") - 1).alias("sys_version"), F.col("sys_period_lower").alias("_next"), F.col("sys_deleted").alias("_next_deleted"))
    rows = versions.join(after, on, "left")
    last = versions.groupBy("vo_id").agg(F.max("sys_version").alias("_last"), F.min("sys_version").alias("_first"))
    rows = rows.join(last, "vo_id")
    upper, nxt = F.col("sys_period_upper"), F.col("_next")
    is_last = F.col("sys_version") == F.col("_last")
    return _violations(rows, on, [
        (~is_last & nxt.isNull(), "/", "contiguous", "next version is missing"),
        (nxt.isNotNull() & ~upper.eqNullSafe(nxt) & ~F.col("_next_deleted"), "/sys_period_upper", "period", "end is not the next version's start"),
        (nxt.isNotNull() & ~upper.eqNullSafe(nxt) & F.col("_next_deleted"), "/sys_period_lower", "tombstone", "tombstone does not start at the predecessor's end"),
        (upper <= F.col("sys_period_lower"), "/sys_period_upper", "order", "end is not after start"),
        ((F.col("sys_version") == F.col("_first")) & (F.col("_first") != 1), "/", "first", "first version is missing"),
    ])


def check_folder_items(items: DataFrame, column: str = "item_id") -> DataFrame:
    """Item ids are UUIDs."""
    bad = ~F.coalesce(F.col(column).rlike(model.UUID_PATTERN), F.lit(False))
    key = [c for c in ("ehr_id", "folder_idx", "num") if c in items.columns]
    return _violations(items, [*key, column], [(bad, "/items", "uuid", F.concat(F.lit("not a uuid: "), F.coalesce(F.col(column), F.lit("null"))))])


def check_cardinality(nodes: DataFrame, constraints: DataFrame, key: Sequence[str] = ("vo_id",)) -> DataFrame:
    """Occurrences per parent against ``constraints(parent_concept, entity_attribute, entity_concept, min_occ, max_occ)``.

    ``max_occ`` NULL = unbounded. A parent without any such child counts as zero. The constraints are few, as they come
    from definitions, and are broadcast; nodes are not, and only children that some constraint names are counted.
    """
    parents = nodes.select(*key, "num", F.col("entity_concept").alias("parent_concept"))
    expected = parents.join(F.broadcast(constraints), "parent_concept")
    named = F.broadcast(constraints.select("entity_attribute", "entity_concept").distinct())
    counts = nodes.filter("num > 0").join(named, ["entity_attribute", "entity_concept"], "left_semi").groupBy(
        *key, F.col("parent_num").alias("num"), "entity_attribute", F.col("entity_concept")
    ).agg(F.count(F.lit(1)).alias("_n"))
    rows = expected.join(counts.hint("merge"), [*key, "num", "entity_attribute", "entity_concept"], "left")
    n = F.coalesce("_n", F.lit(0))
    path = F.concat(F.lit("/"), "entity_attribute", F.lit("["), "entity_concept", F.lit("]"))
    rows = rows.withColumns({"_path": path, "_count": n})
    found = _violations(rows, [*key, "num", "_path"], [
        (F.col("_count") < F.col("min_occ"), "", "min occurrences", F.concat(F.col("_count"), F.lit(" < "), F.col("min_occ"))),
        (F.col("_count") > F.col("max_occ"), "", "max occurrences", F.concat(F.col("_count"), F.lit(" > "), F.col("max_occ"))),
    ])
    return found.withColumn("path", F.col("_path")).drop("_path")
