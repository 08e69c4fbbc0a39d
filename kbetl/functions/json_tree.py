"""Element subtrees as ordered JSON.

Free-form subtrees mix element names in document order, which no fixed struct can hold, so they
are the one part of an entry that is read in Python: one Arrow batch in, one parse per entry,
all requested blobs out.
"""

from __future__ import annotations

import json
import sys
import xml.etree.ElementTree as ET
from array import array

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, functions as F

# Workers get these functions with the task, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

# Blob columns, comment types of the reduced profile, reference types that have
# tables of their own.
BLOBS = ("comments_data", "features_data", "db_references_data", "evidence_data")
STANDARD_COMMENT_TYPES = ("function", "disease", "subcellular location")
TABULAR_REFERENCE_TYPES = ("GO", "NCBI Taxonomy")


_encode = json.JSONEncoder(ensure_ascii=False, check_circular=False).encode


def tree(el: ET.Element) -> dict:
    """{tag, attributes, text, children}; parts that are empty are left out."""
    node: dict = {"tag": el.tag.rpartition("}")[2]}
    if el.attrib:
        node["attributes"] = el.attrib
    if el.text and (text := el.text.strip()):
        node["text"] = text
    if len(el):
        node["children"] = [tree(child) for child in el]
    return node


def _members(entry: ET.Element, blob: str, standard: bool) -> list[ET.Element]:
    """The elements a blob is made of. Tags are matched in the namespace of the entry itself."""
    ns = entry.tag[: entry.tag.find("}") + 1]
    if blob == "comments_data":
        comments = entry.findall(f"{ns}comment")
        return [c for c in comments if c.get("type") in STANDARD_COMMENT_TYPES] if standard else comments
    if blob == "features_data":
        return entry.findall(f"{ns}feature")
    if blob == "db_references_data":
        references = entry.findall(f"{ns}dbReference")
        return [r for r in references if r.get("type") not in TABULAR_REFERENCE_TYPES]
    return list(entry.iter(f"{ns}evidence"))


class Texts:
    """A string array in the making. A text is kept as its UTF-8 alone, in the array's own buffer, so a batch holds no
    Python strings and no second copy of its output."""

    def __init__(self) -> None:
        self.data, self.ends, self.valid = bytearray(), array("i", [0]), []

    def append(self, text: str | None) -> None:
        if text is not None:
            self.data += text.encode()
        self.ends.append(len(self.data))
        self.valid.append(text is not None)

    def finish(self) -> pa.Array:
        valid = pa.array(self.valid, pa.bool_()).buffers()[1]
        return pa.StringArray.from_buffers(len(self.valid), pa.py_buffer(self.ends), pa.py_buffer(self.data), valid)


def _to_json(elements: list[ET.Element]) -> str | None:
    return _encode([tree(el) for el in elements]) if elements else None


def _parsed(text: bytes, namespaces: str | None) -> ET.Element:
    """The entry; where a prefix isn't bound in it, inside an element with the root's declarations."""
    try:
        return ET.fromstring(text)
    except ET.ParseError:
        if not namespaces:
            raise
        return ET.fromstring(b"<_ " + namespaces.encode() + b">" + text + b"</_>")[0]


def entry_blobs(raw: Column, profile: str, blobs: tuple[str, ...] = BLOBS, namespaces: Column | None = None, strict: bool = True) -> Column:
    """Struct of JSON text, one field per name in ``blobs``, from one parse of ``raw``, and ``broken``.

    A NULL input gives NULL fields without a parse. ``namespaces`` holds the prefix declarations of the document's
    root. An entry that can't be parsed fails the job, or with ``strict=False`` is marked by ``broken``.
    """
    standard = profile == "standard"

    @F.arrow_udf(", ".join(f"{b} string" for b in blobs) + ", broken boolean")
    def parse(batch: pa.Array, declared: pa.Array) -> pa.Array:
        out = {b: Texts() for b in blobs}
        broken = []
        for text, prefixes in zip(batch, declared):
            entry = None
            if text.is_valid:
                try:
                    entry = _parsed(text.as_buffer().to_pybytes(), prefixes.as_py())
                except ET.ParseError:
                    if strict:
                        raise
            broken.append(text.is_valid and entry is None)
            for b in blobs:
                out[b].append(None if entry is None else _to_json(_members(entry, b, standard)))
        return pa.StructArray.from_arrays([*(out[b].finish() for b in blobs), pa.array(broken, pa.bool_())], names=[*blobs, "broken"])

    return parse(raw, F.lit(None).cast("string") if namespaces is None else namespaces)
