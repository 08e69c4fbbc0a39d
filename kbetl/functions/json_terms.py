"""Terms of JSON trees, for an index that answers containment.

Every node yields its path of tags, its path with each attribute and value, and its path with its text, each as a 64-bit
hash. A tree that contains a pattern has all terms of the pattern. Trees have any depth, so they are walked in Python,
in Arrow batches.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, functions as F

# Workers get these functions with the task, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])


def term(path: tuple[str, ...], name: str = "", value: str = "") -> int:
    """A signed 64-bit hash of a path, of a path and an attribute (``@name``), or of a path and a text (``=``)."""
    plain = json.dumps([*path, [name, value]], ensure_ascii=False)
    return int.from_bytes(hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def node_terms(nodes: list[dict], above: tuple[str, ...] = ()) -> Iterator[int]:
    for node in nodes:
        path = (*above, node["tag"])
        yield term(path)
        for name, value in node.get("attributes", {}).items():
            yield term(path, "@" + name, value)
        if "text" in node:
            yield term(path, "=", node["text"])
        yield from node_terms(node.get("children", []), path)


def pattern_terms(pattern: list[dict], above: tuple[str, ...] = ()) -> list[int]:
    """Terms that every tree with the pattern has.

    Terms of values, and of paths where a branch has no value: a shorter path says nothing more. Below a node
    without a tag, or at any depth, the path isn't known and there are none.
    """
    found: set[int] = set()
    for p in pattern:
        if p.get("tag") is None:
            continue
        path = (*above, p["tag"])
        own = {term(path, "@" + name, value) for name, value in p.get("attributes", {}).items()}
        if p.get("text") is not None:
            own.add(term(path, "=", p["text"]))
        own.update(pattern_terms(p.get("children", []), path))
        found |= own or {term(path)}
    return sorted(found)


def _matches(node: dict, p: dict) -> bool:
    if any(p.get(k) is not None and node.get(k) != p[k] for k in ("tag", "text")):
        return False
    attributes = node.get("attributes", {})
    if any(attributes.get(k) != v for k, v in p.get("attributes", {}).items()):
        return False
    below = node.get("children", [])
    return _holds(below, p.get("children", [])) and all(any(_matches(n, q) for n in _walk(below)) for q in p.get("descendants", []))


def _walk(nodes: list[dict]) -> Iterator[dict]:
    for node in nodes:
        yield node
        yield from _walk(node.get("children", []))


def _holds(nodes: list[dict], pattern: list[dict]) -> bool:
    return all(any(_matches(n, p) for n in nodes) for p in pattern)


def tree_contains(blob: Column, pattern: list[dict]) -> Column:
    """Whether the trees contain the pattern; NULL for NULL."""

    @F.arrow_udf("boolean")
    def contains(batch: pa.Array) -> pa.Array:
        return pa.array([_holds(json.loads(b.as_py()), pattern) if b.is_valid else None for b in batch], pa.bool_())

    return contains(blob)


def blob_terms(blob: Column) -> Column:
    """The distinct terms of a blob's trees; NULL for NULL."""

    @F.arrow_udf("array<bigint>")
    def terms(batch: pa.Array) -> pa.Array:
        return pa.array([sorted(set(node_terms(json.loads(b.as_py())))) if b.is_valid else None for b in batch], pa.list_(pa.int64()))

    return terms(blob)
