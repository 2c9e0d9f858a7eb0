"""Containment joins over nested-set trees.

Frames carry the object key (``vo_id`` or ``ehr_id, folder_idx``) and, per node alias ``x``, the columns
``x_num, x_num_cap, x_parent_num, x_citem_num, ...``.

"A contains B" is ``A.num < B.num <= A.num_cap`` within one object. Numbers are cut into blocks: an A row is
repeated for every block its interval touches (one, for objects of ordinary size), a B row lies in exactly one.
The join is then an equi join on (key, block) with the interval as residual, so that neither one huge object nor
one huge subtree ends up in a single task or compares all its pairs.

``blocks=False`` leaves the blocks out: all joins of a query then share one partitioning by object key. Use it only
where ``objects_fit`` has shown that no object has more nodes than a block.

Node frames are merge-joined by hint: they are generated from smaller rows, so that Spark takes them for a fraction of
their size and would send them through the driver to all executors.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark import model
from recspark.plans.ordered import running_max

BLOCK_BITS = 10  # 1,024 numbers per block
OBJECT = ("vo_id",)
FOLDER = ("ehr_id", "folder_idx")

_NODE_COLUMNS = (
    "num", "num_cap", "parent_num", "citem_num", "rm_entity", "entity_concept", "entity_name", "entity_attribute",
)


def nodes_as(
    nodes: DataFrame,
    alias: str,
    *types: str,
    where: Column | None = None,
    columns: Sequence[str] = (),
    key: Sequence[str] = OBJECT,
) -> DataFrame:
    """Node rows under an alias: filtered by type and condition, columns renamed to ``alias_*``."""
    model.require(nodes, *key, "num", "num_cap")
    if types:
        nodes = nodes.filter(F.col("rm_entity").isin(model.concrete_types(*types)))
    if where is not None:
        nodes = nodes.filter(where)
    keep = [c for c in ("num", "num_cap", "parent_num", "citem_num") if c in nodes.columns]
    keep += [c for c in columns if c not in keep]
    return nodes.select(*key, *[F.col(c).alias(f"{alias}_{c}") for c in keep])


def contains_owner(ehr: DataFrame, versions: DataFrame, how: str = "inner") -> DataFrame:
    """Owner CONTAINS object."""
    return versions.join(ehr, "ehr_id", how)


def contains_root(left: DataFrame, b: DataFrame, key: Sequence[str] = OBJECT, root: str | None = None, alias: str | None = None) -> DataFrame:
    """Object root CONTAINS B: key equality; with ``root`` and ``alias`` the root itself is no B."""
    joined = left.join(b, list(key))
    return joined.filter(F.col(f"{alias}_num") > F.col(f"{root}_num")) if root and alias else joined


def objects_fit(nodes: DataFrame) -> bool:
    """Whether every object has at most one block of nodes; reads ``num_cap`` of the roots only."""
    largest = nodes.filter("num = 0").agg(F.max("num_cap").alias("n")).first()["n"]
    return largest is None or largest < (1 << BLOCK_BITS)


def _block(c: Column) -> Column:
    return F.shiftright(c, BLOCK_BITS)


def _plain(left: DataFrame, a: str, right: DataFrame, b: str, key: Sequence[str], local: str | None, how: str) -> DataFrame:
    """Join on the object key with everything else as residual, for objects of known small size."""
    cond = (F.col(f"{b}_num") > F.col(f"{a}_num")) & (F.col(f"{b}_num") <= F.col(f"{a}_num_cap"))
    if local == "archetype":
        cond = F.col(f"{b}_citem_num") == F.col(f"{a}_num")
    elif local == "node":
        cond = cond & (F.col(f"{b}_citem_num") == F.col(f"{a}_citem_num"))
    return join_by_object(left, right, key, cond, how)


def join_by_object(left: DataFrame, right: DataFrame, key: Sequence[str], cond: Column, how: str) -> DataFrame:
    """Join on the object key alone, ``cond`` as residual; both frames otherwise have different columns."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in key})
    for k in key:
        cond = cond & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(other.hint("merge"), cond, how).drop(*[f"_r_{k}" for k in key])


def _pairs(left: DataFrame, a: str, right: DataFrame, b: str, key: Sequence[str], local: str | None) -> DataFrame:
    """Inner join; ``local``: None, 'archetype' or 'node'."""
    a_num, a_cap, b_num = F.col(f"{a}_num"), F.col(f"{a}_num_cap"), F.col(f"{b}_num")
    if local == "archetype":
        # the nearest archetyped ancestor of B is A: an equality, no interval needed
        b_rows = right.withColumn(f"{a}_num", F.col(f"{b}_citem_num"))
        return left.join(b_rows.hint("merge"), [*key, f"{a}_num"])
    if local not in (None, "node"):
        raise ValueError(f"unknown local mode: {local}")
    on = [*key, "_block"]
    blocks = F.when(a_cap > a_num, F.sequence(_block(a_num + 1), _block(a_cap)))
    a_rows = left.withColumn("_block", F.explode(blocks))
    b_rows = right.withColumn("_block", _block(b_num))
    if local == "node":
        a_rows = a_rows.withColumn("_citem", F.col(f"{a}_citem_num"))
        b_rows = b_rows.withColumn("_citem", F.col(f"{b}_citem_num"))
        on.append("_citem")
    return a_rows.join(b_rows.hint("merge"), on).filter((b_num > a_num) & (b_num <= a_cap)).drop("_block", "_citem")


def _holders(
    intervals: DataFrame, a: str, right: DataFrame, b: str, key: Sequence[str], local: str | None, columns: Sequence[str] = ()
) -> DataFrame:
    """The intervals that hold some B, without any pair: the first B above A decides. ``columns`` stay with them.

    A and B are merged by number; walking backwards, the B met last is the first one above. Each row is read once,
    however deep the A are nested.
    """
    if local == "archetype":
        below = right.select(*key, F.col(f"{b}_citem_num").alias(f"{a}_num")).distinct()
        return intervals.join(below.hint("merge"), [*key, f"{a}_num"], "left_semi")
    if local not in (None, "node"):
        raise ValueError(f"unknown local mode: {local}")
    group, none = list(key), F.lit(None).cast("int")
    if local == "node":
        group.append("_citem")
        intervals, right = intervals.withColumn("_citem", F.col(f"{a}_citem_num")), right.withColumn("_citem", F.col(f"{b}_citem_num"))
    # a node that is A and B comes as A first, so that it does not hold itself
    more = [x for x in columns if x not in (*group, f"{a}_num", f"{a}_num_cap")]
    openings = intervals.select(*group, (-2 * F.col(f"{a}_num") - 1).alias("_back"), F.col(f"{a}_num"), F.col(f"{a}_num_cap"), none.alias("_b"), *more)
    # a B that stands twice is one maximum
    found = right.select(*group, (-2 * F.col(f"{b}_num")).alias("_back"), none.alias(f"{a}_num"), none.alias(f"{a}_num_cap"), (-F.col(f"{b}_num")).alias("_b"))
    merged = running_max(openings.unionByName(found, allowMissingColumns=True), group, "_back", {"_first": F.col("_b")}, inclusive=False)
    return merged.filter(F.col(f"{a}_num").isNotNull() & (-F.col("_first") <= F.col(f"{a}_num_cap")))


def contains(
    left: DataFrame,
    a: str,
    right: DataFrame,
    b: str,
    key: Sequence[str] = OBJECT,
    how: str = "inner",
    local: str | None = None,
    blocks: bool = True,
) -> DataFrame:
    """Node alias ``a`` of ``left`` CONTAINS node alias ``b`` of ``right``.

    ``local='archetype'``: B belongs to A's own archetype (nested archetypes excluded); ``local='node'``: A and B
    belong to the same archetype. ``how``: inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    if not blocks:
        return _plain(left, a, right, b, key, local, how)
    if how == "inner":
        return _pairs(left, a, right, b, key, local)
    if how == "left_semi" and local != "archetype":
        # the rows go along themselves, so that they are not read again to be found by number
        return _holders(left, a, right, b, key, local, left.columns).select(*left.columns)
    ids = [*key, f"{a}_num"]
    intervals = left.select(*ids, f"{a}_num_cap", *([f"{a}_citem_num"] if local == "node" else [])).distinct()
    if how in ("left_semi", "left_anti"):
        return left.join(_holders(intervals, a, right, b, key, local).select(*ids).hint("merge"), ids, how)
    pairs = _pairs(intervals, a, right, b, key, local)
    pairs = pairs.drop(f"{a}_num_cap", *([f"{a}_citem_num"] if local == "node" else []))
    return left.join(pairs.hint("merge"), ids, "left")


def contains_or_is(left: DataFrame, a: str, right: DataFrame, b: str, key: Sequence[str] = OBJECT, blocks: bool = True) -> DataFrame:
    """Node alias ``a`` of ``left`` CONTAINS node alias ``b`` of ``right`` or is it."""
    a_num, b_num = F.col(f"{a}_num"), F.col(f"{b}_num")
    top = F.greatest(a_num, f"{a}_num_cap")
    within = (b_num >= a_num) & (b_num <= top)
    if not blocks:
        return join_by_object(left, right, key, within, "inner")
    a_rows = left.withColumn("_block", F.explode(F.sequence(_block(a_num), _block(top))))
    b_rows = right.withColumn("_block", _block(b_num))
    return a_rows.join(b_rows.hint("merge"), [*key, "_block"]).filter(within).drop("_block")


def not_contains(
    left: DataFrame, a: str, right: DataFrame, b: str, key: Sequence[str] = OBJECT, blocks: bool = True
) -> DataFrame:
    return contains(left, a, right, b, key, how="left_anti", blocks=blocks)


def contains_all(
    left: DataFrame, a: str, parts: Sequence[tuple[str, DataFrame]], key: Sequence[str] = OBJECT, blocks: bool = True
) -> DataFrame:
    """A CONTAINS (B AND C ...): all combinations of the parts within one A."""
    for b, frame in parts:
        left = contains(left, a, frame, b, key, blocks=blocks)
    return left


def chain(
    first: DataFrame, b: str, second: DataFrame, d: str, key: Sequence[str] = OBJECT, blocks: bool = True
) -> tuple[str, DataFrame]:
    """B CONTAINS D as one part: present only as a whole."""
    return b, contains(first, b, second, d, key, blocks=blocks)


def contains_any(
    left: DataFrame, a: str, parts: Sequence[tuple[str, DataFrame]], key: Sequence[str] = OBJECT, blocks: bool = True
) -> DataFrame:
    """A CONTAINS (B OR C ...): combinations with NULLs for absent parts, at least one part present."""
    for b, frame in parts:
        left = contains(left, a, frame, b, key, how="left", blocks=blocks)
    present = [F.col(f"{b}_num").isNotNull() for b, _ in parts]
    return left.filter(functools.reduce(operator.or_, present))


# ---------------------------------------------------------------------------------------------
# folders
# ---------------------------------------------------------------------------------------------

def folders_as(folders: DataFrame, alias: str, where: Column | None = None, columns: Sequence[str] = ()) -> DataFrame:
    return nodes_as(folders, alias, where=where, columns=columns, key=FOLDER)


def folder_items(folders: DataFrame, f: str, items: DataFrame) -> DataFrame:
    """Item ids of folder ``f`` and of all folders below it; an item listed twice comes twice.

    An item carries the number of its folder, so the interval of ``f`` meets the items directly.
    """
    num, cap = F.col(f"{f}_num"), F.col(f"{f}_num_cap")
    spans = folders.withColumn("_block", F.explode(F.sequence(_block(num), _block(cap))))
    rows = items.withColumnRenamed("num", "_item_folder").withColumn("_block", _block(F.col("_item_folder")))
    found = spans.join(rows, [*FOLDER, "_block"])
    return found.filter((F.col("_item_folder") >= num) & (F.col("_item_folder") <= cap)).drop("_block", "_item_folder")


def folder_contains(folders: DataFrame, f: str, items: DataFrame, versions: DataFrame) -> DataFrame:
    """Folder CONTAINS object: objects referenced by items of the folder's subtree, whoever owns them."""
    found = folder_items(folders, f, items)
    found = found.withColumnsRenamed({"item_vo_id": "vo_id", "ehr_id": "folder_ehr_id"})
    return versions.join(found, "vo_id")


def folder_step(parents: DataFrame, f: str, folders: DataFrame, child: str, name: str | None = None) -> DataFrame:
    """Direct sub-folders of folder ``f``, optionally by name."""
    where = F.col("num") > 0
    if name is not None:
        where = where & (F.col("entity_name") == name)
    steps = folders_as(folders, child, where, ["entity_name"])
    steps = steps.withColumn(f"{f}_num", F.col(f"{child}_parent_num"))
    return parents.join(steps, [*FOLDER, f"{f}_num"])


def folder_by_path(folders: DataFrame, path: str) -> DataFrame:
    """Folder at ``/a/b/c`` of every owner: one step per name from the root; the empty path is the root."""
    names = [p for p in path.split("/") if p]
    found = folders_as(folders, "s0", F.col("num") == 0, ["entity_name"])
    for i, name in enumerate(names):
        found = folder_step(found, f"s{i}", folders, f"s{i + 1}", name)
    last = f"s{len(names)}"
    return found.select(
        *FOLDER, F.col(f"{last}_num").alias("num"), F.col(f"{last}_num_cap").alias("num_cap"),
        F.col(f"{last}_entity_name").alias("entity_name"),
    )


def folder_name_paths(folders: DataFrame) -> DataFrame:
    """Name path of every folder, ``/a/b/c``, the root's is ``/``. Folders may be nested to any depth.

    The folders above one are those whose interval holds it; their names in the order of their numbers are the path, so
    the pairs that are made are the steps of the paths.
    """
    above = folders_as(folders, "a", F.col("num") > 0, ["entity_name"])
    below = folders_as(folders, "b", F.col("num") > 0, ["entity_name"])
    steps = _pairs(above, "a", below, "b", FOLDER, None)
    steps = steps.groupBy(*FOLDER, F.col("b_num").alias("num")).agg(F.sort_array(F.collect_list(F.struct("a_num", "a_entity_name"))).alias("_steps"))
    names = F.transform("_steps", lambda s: F.concat(F.lit("/"), s["a_entity_name"]))
    paths = folders.select(*FOLDER, "num", "entity_name").join(steps, [*FOLDER, "num"], "left")
    own = F.concat(F.coalesce(F.array_join(names, ""), F.lit("")), F.lit("/"), "entity_name")
    return paths.select(*FOLDER, "num", F.when(F.col("num") == 0, "/").otherwise(own).alias("path"))
