"""Prefix tree of projected paths: which paths of one row must read the same node."""

from __future__ import annotations

from dataclasses import dataclass, field

from recspark import model


@dataclass(frozen=True)
class Step:
    """One step to a structural child: attribute, optional node id and name predicates."""

    attribute: str
    node_id: str | None = None
    name: str | None = None


@dataclass(frozen=True)
class Path:
    """Steps from the root and the column to read at the end, under the name ``out``."""

    out: str
    steps: tuple[Step, ...]
    column: str = "entity_name"


@dataclass
class PathNode:
    attribute: str | None
    identity: tuple[str | None, str | None]
    ends: list[Path] = field(default_factory=list)
    children: list["PathNode"] = field(default_factory=list)


def _is_archetype(step: Step) -> bool:
    return step.node_id is not None and step.node_id.startswith(model.ARCHETYPE_PREFIX)


def resolution(step: Step) -> str:
    """What a single step identifies: the bare attribute, an archetype, a node id or a name."""
    if step.node_id is None:
        return "base" if step.name is None else "name"
    if step.name is not None:
        return "node"
    return "archetype" if _is_archetype(step) else "node"


def common_resolution(steps: list[Step]) -> str:
    """The resolution on which all steps to one attribute agree.

    Equal ones stay; archetype and node together identify by archetype; any other mix falls back to the attribute.
    """
    kinds = {resolution(s) for s in steps}
    if len(kinds) == 1:
        return kinds.pop()
    return "archetype" if kinds == {"archetype", "node"} else "base"


def identity(step: Step, kind: str) -> tuple[str | None, str | None]:
    """The part of a step's predicates that selects the node; the rest only filters that path's value."""
    if kind == "base":
        return None, None
    if kind == "name":
        return None, step.name
    if kind == "archetype":
        return step.node_id, None
    # a node code is unique by itself, an archetype may occur several times under different names
    return step.node_id, (step.name if step.node_id is None or _is_archetype(step) else None)


def path_tree(paths: list[Path]) -> PathNode:
    """Group the paths by common prefix."""

    def grow(node: PathNode, members: list[Path], level: int) -> PathNode:
        node.ends = [p for p in members if len(p.steps) == level]
        longer = [p for p in members if len(p.steps) > level]
        for attribute in dict.fromkeys(p.steps[level].attribute for p in longer):
            same = [p for p in longer if p.steps[level].attribute == attribute]
            kind = common_resolution([p.steps[level] for p in same])
            groups: dict[tuple, list[Path]] = {}
            for p in same:
                groups.setdefault(identity(p.steps[level], kind), []).append(p)
            for ident, group in groups.items():
                node.children.append(grow(PathNode(attribute, ident), group, level + 1))
        return node

    return grow(PathNode(None, (None, None)), paths, 0)
