"""Paths from nodes to structural children and the values found there."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions.predicates import split_archetype
from recspark.operators.contains import OBJECT, contains, contains_or_is, join_by_object, nodes_as
from recspark.plans.path_tree import Path, PathNode, Step, path_tree


def node_condition(attribute: str | None = None, node_id: str | None = None, name: str | None = None) -> Column:
    """Condition on node columns for one path step."""
    cond = F.lit(True) if attribute is None else (F.col("entity_attribute") == attribute)
    if node_id is not None:
        rm, concept = split_archetype(node_id)
        cond = cond & (F.col("entity_concept") == concept)
        if rm is not None:
            cond = cond & (F.col("rm_entity") == rm)
    if name is not None:
        cond = cond & (F.col("entity_name") == name)
    return cond


def path_step(
    parents: DataFrame,
    p: str,
    nodes: DataFrame,
    c: str,
    attribute: str,
    node_id: str | None = None,
    name: str | None = None,
    how: str = "left",
    columns: Sequence[str] = (),
    skip: str | None = None,
    key: Sequence[str] = OBJECT,
) -> DataFrame:
    """Child ``c`` of node ``p`` by attribute and predicates.

    ``skip`` leaves out intermediate nodes: 'archetype' (``p`` is the child's nearest archetyped ancestor) or
    'node' (``p`` and child share it, child inside ``p``).
    """
    children = nodes_as(nodes, c, where=(F.col("num") > 0) & node_condition(attribute, node_id, name), columns=columns, key=key)
    if skip in ("archetype", "node"):
        return contains(parents, p, children, c, key, how, local=skip)
    if skip is not None:
        raise ValueError(f"unknown skip mode: {skip}")
    return parents.join(children.withColumn(f"{p}_num", F.col(f"{c}_parent_num")), [*key, f"{p}_num"], how)


def same_parent(a: str, b: str) -> Column:
    """Two skipped-to siblings belong together if both exist and share the parent, or one is absent."""
    return F.coalesce(F.col(f"{a}_parent_num") == F.col(f"{b}_parent_num"), F.lit(True))


def path_filter(value: Column, condition: Column) -> Column:
    """Show a value only where its own predicate holds; the row stays."""
    return F.when(condition, value)


def _residual(step: Step, identity: tuple[str | None, str | None]) -> Column | None:
    node_id = step.node_id if step.node_id != identity[0] else None
    name = step.name if step.name != identity[1] else None
    return None if node_id is None and name is None else node_condition(None, node_id, name)


def project_paths(
    df: DataFrame, root: str, nodes: DataFrame, paths: Sequence[Path], key: Sequence[str] = OBJECT, blocks: bool = True
) -> DataFrame:
    """Add one column per path, read from the structural descendants of node ``root``.

    Paths with a common prefix share its node. A path never removes a row; a node on the way that yields no value
    of its own appears only together with the node(s) below it.

    Parent and child are matched on (object, number), which spreads large objects. ``blocks=False``: all joins share
    the partitioning by object; only where ``objects_fit`` holds.
    """
    paths = list(paths)
    tree = path_tree(paths)
    if tree.ends:
        raise ValueError("a path needs at least one step")
    counter = iter(range(1_000_000))

    def build(node: PathNode, members: list[Path], level: int) -> tuple[DataFrame, str]:
        alias = f"_p{next(counter)}"
        rows = nodes.filter((F.col("num") > 0) & node_condition(node.attribute, *node.identity))
        out = [F.col(k) for k in key] + [F.col("num").alias(f"{alias}_num"), F.col("parent_num").alias(f"{alias}_parent")]
        for p in members:
            rest = _residual(p.steps[level - 1], node.identity)
            if rest is not None:
                out.append(F.coalesce(rest, F.lit(False)).alias(f"_ok_{p.out}_{level}"))
        out += [F.col(p.column).alias(f"_value_{p.out}") for p in node.ends]
        frame = rows.select(*out)
        single = not node.ends and len(node.children) == 1
        present = []
        for child in node.children:
            frame, num = attach(frame, f"{alias}_num", child, members, level, "inner" if single else "left")
            present.append(F.col(num).isNotNull())
        if not node.ends and len(present) > 1:
            frame = frame.filter(functools.reduce(operator.or_, present))
        return frame, alias

    def below(child: PathNode) -> list[Path]:
        return child.ends + [p for c in child.children for p in below(c)]

    def attach(frame: DataFrame, num: str, child: PathNode, members: list[Path], level: int, how: str):
        mine = set(p.out for p in below(child))
        sub, alias = build(child, [p for p in members if p.out in mine], level + 1)
        if blocks:
            return frame.join(sub.withColumnRenamed(f"{alias}_parent", num), [*key, num], how), f"{alias}_num"
        # two bounds instead of an equality, which would become a join key and so another partitioning
        parent = F.col(f"{alias}_parent")
        child_of = (F.col(num) >= parent) & (F.col(num) <= parent)
        return join_by_object(frame, sub, key, child_of, how).drop(f"{alias}_parent"), f"{alias}_num"

    result = df
    for child in tree.children:
        result, _ = attach(result, f"{root}_num", child, paths, 0, "left")
    columns = [F.col(c) for c in df.columns]
    for p in paths:
        checks = [f"_ok_{p.out}_{i + 1}" for i in range(len(p.steps)) if f"_ok_{p.out}_{i + 1}" in result.columns]
        value = F.col(f"_value_{p.out}")
        if checks:
            value = path_filter(value, functools.reduce(operator.and_, [F.col(c) for c in checks]))
        columns.append(value.alias(p.out))
    return result.select(*columns)


def with_owner_status(df: DataFrame, status: DataFrame, how: str = "inner") -> DataFrame:
    """Columns of the owner's status object for every row."""
    return df.join(status, "ehr_id", how)


def constant_column(df: DataFrame, value, name: str) -> DataFrame:
    """A literal per matched row."""
    return df.withColumn(name, F.lit(value))


def result_columns(df: DataFrame, columns: Sequence[tuple[Column, str | None]]) -> DataFrame:
    """Project in order; columns without alias are named ``#0``, ``#1``, ... by position."""
    return df.select(*[c.alias(alias if alias else f"#{i}") for i, (c, alias) in enumerate(columns)])


def subtree_nodes(
    df: DataFrame, a: str, nodes: DataFrame, key: Sequence[str] = OBJECT, columns: Sequence[str] = (), blocks: bool = True
) -> DataFrame:
    """All nodes of the subtree below ``a``, ``a`` itself included, under the alias ``n``: one join."""
    rows = nodes_as(nodes, "n", columns=columns, key=key)
    found = contains_or_is(df, a, rows, "n", key, blocks)
    first = [*key, f"{a}_num"]
    return found.select(*first, *[c for c in found.columns if c not in first])
