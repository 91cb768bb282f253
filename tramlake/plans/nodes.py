"""Nodes and their graph: what is collected, what is derived from what, and what answers questions."""

from __future__ import annotations

import tomllib
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial
from graphlib import TopologicalSorter
from importlib import import_module
from pathlib import Path

KINDS = ("collectors", "harvesters", "handlers")


@dataclass
class Node:
    """A node of the graph. Edges hold (name, number of rows)."""

    name: str
    kind: str
    run: str | Callable | None = None
    data_type: str = "json"
    data_format: str = ""
    schedule: str | None = None
    source: str | None = None
    source_range: str | int = 1
    strict: bool = True
    multiple: bool = False
    dependencies: list[tuple[str, int]] = field(default_factory=list)
    optional: list[tuple[str, int]] = field(default_factory=list)
    parameters: dict[str, str] = field(default_factory=dict)
    levels: list[tuple[str, list[str]]] = field(default_factory=list)
    item_types: dict[str, str] = field(default_factory=dict)
    options: dict = field(default_factory=dict)

    def load(self) -> Callable:
        """The function to run, with the node's options: itself, or what a path module:name names."""
        if callable(self.run):
            found = self.run
        else:
            module, _, name = (self.run or "").partition(":")
            found = getattr(import_module(module), name)
        return partial(found, **self.options) if self.options else found


def qualified(file: str, name: str) -> str:
    """A name inside a file belongs to it; a dotted one names its file."""
    return name.replace(".", "_") if "." in name else f"{file}_{name}"


def load(folder: str) -> dict[str, Node]:
    """All nodes of the TOML files under a folder, by name; every edge must lead to one."""
    out: dict[str, Node] = {}
    for path in sorted(Path(folder).rglob("*.toml")):
        tables = tomllib.loads(path.read_text())
        for kind in KINDS:
            for entry in tables.get(kind, []):
                node = _node(path.stem, kind, entry)
                if node.name in out:
                    raise ValueError(f"{node.name} is there twice")
                out[node.name] = node
    for c in out.values():
        for name in [*([c.source] if c.source else []), *(n for n, _ in (*c.dependencies, *c.optional))]:
            if name not in out:
                raise ValueError(f"{c.name} needs {name}, which is not there")
    return out


def _edges(file: str, names: list[str], limits: list[int] | None) -> list[tuple[str, int]]:
    limits = limits or [1] * len(names)
    if len(limits) != len(names):
        raise ValueError("as many limits as dependencies are needed")
    return [(qualified(file, n), k) for n, k in zip(names, limits, strict=True)]


def _node(file: str, kind: str, entry: dict) -> Node:
    e = {k.lower(): v for k, v in entry.items()}
    batch = e.get("parquetize") or {}
    levels = [(batch["batch"], [])] if batch.get("batch") else []
    levels += [(g["period"], list(g.get("keys", []))) for g in batch.get("groups", [])]
    return Node(
        name=f"{file}_{e['name']}", kind=kind, run=e.get("run"), data_type=e.get("data_type", "json"), data_format=e.get("data_format", ""), schedule=e.get("schedule"),
        source=qualified(file, e["source"]) if e.get("source") else None, source_range=e.get("source_range", 1), strict=e.get("source_range_strict", True), multiple=e.get("multiple_results", False),
        dependencies=_edges(file, e.get("dependencies", []), e.get("dependencies_limit")), optional=_edges(file, e.get("optional_dependencies", []), e.get("optional_dependencies_limit")),
        parameters=e.get("query_parameters", {}), levels=levels, item_types=batch.get("types", {}), options=e.get("options", {}),
    )


def order(nodes: dict[str, Node]) -> list[str]:
    """Sources before what is derived from them; a node may feed on its own output."""
    graph = {c.name: {n for n in [c.source, *(n for n, _ in (*c.dependencies, *c.optional))] if n and n != c.name} for c in nodes.values()}
    return [*TopologicalSorter(graph).static_order()]


def selected(nodes: dict[str, Node], kind: str, names: list[str]) -> list[Node]:
    """The nodes of a kind that are named; `all` or `*` names all."""
    every = [c for c in nodes.values() if c.kind == kind]
    if names in (["all"], ["*"]):
        return every
    missing = set(names) - {c.name for c in every}
    if missing:
        raise ValueError(f"no such {kind}: {sorted(missing)}")
    return [c for c in every if c.name in names]
