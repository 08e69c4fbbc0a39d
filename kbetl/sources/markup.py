"""What is markup and what only looks like it, for documents read in pieces.

A document is read as records, each the text behind a ``<`` up to the next one. Every opener (``<!--``, ``<![CDATA[``,
``<?``, ``<!DOCTYPE``, a tag) then starts a record and every closer lies inside one, so that no token is ever cut, at
whatever byte a split starts. What a record means depends on the state at its start alone. That makes a split a map from
the state at its start to the one at its end, and maps are composed over the splits of a file in order.

These classes see records in order and know nothing of Spark; ``entries`` runs them inside the scan.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.cloudpickle import register_pickle_by_value

# Workers get these functions with the task, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

# States at the start of a record.
TEXT, COMMENT, CDATA, INSTRUCTION, DOCTYPE = STATES = range(5)
OPENERS = ((b"!--", COMMENT), (b"![CDATA[", CDATA), (b"?", INSTRUCTION))
CLOSERS = {COMMENT: b"-->", CDATA: b"]]>", INSTRUCTION: b"?>"}
_SUBSET_END = re.compile(rb"\]\s*>")
_NAME = rb"[^\s<>/:=\"'!?&;]+"
_TAG_NAME = re.compile(rb"[^\s<>/=\"'!?&;]+")
_CLOSE = re.compile(rb"/([^\s<>/]+)\s*>\s*\Z")
_EMPTY = re.compile(rb"[^\s<>/=]+(?:\s+[^\s=<>/]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*\s*/>")
_DECLARATION = re.compile(rb"xmlns:[\w.\-]+\s*=\s*(?:\"[^\"]*\"|'[^']*')")


def step(state: int, record: bytes) -> tuple[int, int]:
    """The state behind a record, and how much of the record is hidden (0: none, -1: all)."""
    start = 0
    if state == TEXT:
        for opener, opened in OPENERS:
            if record.startswith(opener):
                state, start = opened, len(opener)
                break
        else:
            if not record.startswith(b"!DOCTYPE") or b"[" not in record:
                return TEXT, 0
            state, start = DOCTYPE, record.index(b"[")
    if state == DOCTYPE:
        found = _SUBSET_END.search(record, start)
        return (TEXT, found.end()) if found else (DOCTYPE, -1)
    closer = CLOSERS[state]
    end = record.find(closer, start)
    return (state, -1) if end < 0 else (TEXT, end + len(closer))


@dataclass(frozen=True)
class Tags:
    """Start and end tags of the row element, with or without a prefix."""

    row_tag: str
    start: re.Pattern = field(init=False)
    end: re.Pattern = field(init=False)

    def __post_init__(self):
        tag = re.escape(self.row_tag.encode())
        object.__setattr__(self, "start", re.compile(rb"(?:(%s):)?%s(?=[\s/>])" % (_NAME, tag)))
        object.__setattr__(self, "end", re.compile(rb"/(?:%s:)?%s\s*>" % (_NAME, tag)))

    @property
    def marked(self) -> str:
        """Pattern (for the scan) of the records that can change a state or belong to the row element."""
        return rf"^(?:!|\?|/?(?:[^\s<>/:=\"'!?&;]+:)?{re.escape(self.row_tag)}[\s/>])|-->|\]\]>|\?>|\]\s*>"

    def opens(self, record: bytes) -> re.Match | None:
        found = self.start.match(record)
        return None if found is None or _EMPTY.match(record) else found


# The entry that is open at a split's end, where it isn't one that started in a known split: none; the one that was open
# at the split's start, if any; that one or else the one started here.
OUTSIDE, SAME, SAME_OR_HERE = -1, -2, -3


@dataclass
class Survey:
    """The map of one split: for each state at its start, the state at its end and the entry open there."""

    tags: Tags
    block: int
    ends: list[int] = field(default_factory=lambda: list(STATES))
    open_block: list[int] = field(default_factory=lambda: [SAME] * len(STATES))
    prefix: list[bytes] = field(default_factory=lambda: [b""] * len(STATES))

    def feed(self, record: bytes) -> None:
        opens, closes = self.tags.opens(record), self.tags.end.match(record)
        for s, before in enumerate(self.ends):
            self.ends[s], hidden = step(before, record)
            if before != TEXT or hidden:
                continue
            if closes:
                self.open_block[s] = OUTSIDE
            elif opens and self.open_block[s] in (SAME, OUTSIDE):
                # A start tag inside an open entry opens no other.
                self.open_block[s] = self.block if self.open_block[s] == OUTSIDE else SAME_OR_HERE
                self.prefix[s] = opens[1] or b""


@dataclass
class Context:
    """What is true at the start of a split."""

    state: int = TEXT
    open_block: int = OUTSIDE
    prefix: bytes = b""
    declared: str = ""

    def after(self, block: int, ends: Sequence[int], open_block: Sequence[int], prefix: Sequence[bytes]) -> Context:
        s, opened = self.state, open_block[self.state]
        if opened == SAME or (opened == SAME_OR_HERE and self.open_block != OUTSIDE):
            return Context(ends[s], self.open_block, self.prefix, self.declared)
        if opened == OUTSIDE:
            return Context(ends[s], OUTSIDE, b"", self.declared)
        return Context(ends[s], block, prefix[s], self.declared)


def declarations(record: bytes) -> str:
    """Namespace declarations with a prefix in a start tag."""
    return b" ".join(_DECLARATION.findall(record)).decode("utf-8", "replace")


@dataclass
class Root:
    """Looks for the root's start tag, the first tag that isn't hidden, in the records of a file's first split.

    If it isn't there, the file counts as incomplete.
    """

    state: int = TEXT
    seen: int = 0
    record: bytes | None = None

    def feed(self, record: bytes) -> None:
        self.seen += 1
        if self.seen == 1:  # stands before the first '<'
            return
        before = self.state
        self.state, hidden = step(before, record)
        if before == TEXT and not hidden and _TAG_NAME.match(record):
            self.record = record


@dataclass
class Piece:
    """An entry, or with ``whole`` false the part of it that lies in one split."""

    start_block: int
    text: bytes
    starts: int
    ends: bool
    whole: bool


class Cutter:
    """Entries of one split, from its records in order and the context at its start."""

    def __init__(self, tags: Tags, block: int, context: Context):
        self.tags, self.block, self.state = tags, block, context.state
        self.open_block, self.prefix = context.open_block, context.prefix
        self.declared = context.declared
        self.root = Root() if block == 0 else None
        self.parts: list[bytes] = []
        self.starts = 0
        self.first = True
        self.last: bytes | None = None  # the last record that is a tag
        self.rest = False  # text that isn't blank behind the last hidden part

    def _taken(self, records: Sequence[bytes], start: int, end: int, hidden: list[tuple[int, int]]) -> None:
        """Records of the open entry; its own prefix is taken off tags, so that they read like those of other entries."""
        if self.prefix:
            inside = {i for a, b in hidden for i in range(a, b + 1)}
            own, own_end = self.prefix + b":", b"/" + self.prefix + b":"
            for i in range(start, end):
                r = records[i]
                if i not in inside:
                    r = r[len(own) :] if r.startswith(own) else b"/" + r[len(own_end) :] if r.startswith(own_end) else r
                self.parts.append(r)
        else:
            self.parts.extend(records[start:end])

    def feed(self, records: Sequence[bytes], marked: Sequence[int]) -> Iterator[Piece]:
        """``marked`` are the places of records that match ``Tags.marked``; all others are tags or text."""
        if self.root and self.root.record is None:
            for r in records:
                self.root.feed(r)
                if self.root.record is not None:
                    self.declared = declarations(self.root.record)
                    break
        hidden: list[tuple[int, int]] = []  # places of hidden records
        behind: list[bool] = []  # whether text that isn't blank follows in the same record
        since = 0  # where the hidden part that is open starts
        taken = 0  # up to where the open entry has its records
        skipped = 1 if self.first and self.block == 0 else 0  # what stands before the first '<'
        for i in marked:
            r, before = records[i], self.state
            if i < skipped:
                continue
            self.state, end = step(before, r)
            if end or before != TEXT:
                since = i if before == TEXT else since
                if self.state == TEXT:
                    hidden.append((since, i))
                    behind.append(bool(r[end:].strip()))
            elif self.tags.end.match(r):
                close = b"/" + self.tags.row_tag.encode() + b">"
                if self.open_block == OUTSIDE:
                    yield Piece(self.block, close, 0, True, True)
                    continue
                self._taken(records, taken, i, hidden)
                yield self._piece(b"<".join([*self.parts, close]), True)
                self.open_block, self.prefix, self.parts, self.starts = OUTSIDE, b"", [], 0
            elif opening := self.tags.opens(r):
                self.starts += 1
                if self.open_block == OUTSIDE:
                    self.open_block, self.prefix, taken = self.block, opening[1] or b"", i
        n = len(records)
        if self.state != TEXT:
            hidden.append((since, n - 1))
            behind.append(False)
        if self.open_block != OUTSIDE:
            self._taken(records, taken, n, hidden)
        last, blank = n - 1, True
        for (a, b), text in zip(reversed(hidden), reversed(behind), strict=True):
            if b != last:
                break
            last, blank = a - 1, blank and not text
        if last >= skipped:
            self.last, self.rest = records[last], not blank
        else:
            self.rest = self.rest or not blank
        self.first = False

    def _piece(self, text: bytes, ends: bool) -> Piece:
        whole = ends and self.open_block == self.block
        return Piece(self.open_block, text, self.starts, ends, whole)

    def finish(self) -> Iterator[Piece]:
        """The part of an entry that goes on in the next split."""
        if self.open_block != OUTSIDE:
            yield self._piece(b"<".join(self.parts), False)

    def summary(self) -> tuple[str | None, str | None, bool]:
        """Name of the root (first split only); name of the element closed last ('' if another tag came last, None if
        there was no tag); whether the split ends in plain text outside of an entry."""
        root = None
        if self.root and self.root.record is not None:
            root = _TAG_NAME.match(self.root.record)[0].decode("utf-8", "replace")
        closed = None
        if self.last is not None:
            found = _CLOSE.match(self.last)
            closed = found[1].decode("utf-8", "replace") if found else ""
            if not found and self.root and self.last == self.root.record and _EMPTY.match(self.last):
                closed = root
        return root, closed, self.state == TEXT and self.open_block == OUTSIDE and not self.rest
