"""Sorted runs of (pair, document) records, their merge and what comes back to the documents.

A record says that a document holds an id pair, so many times. Records are gathered until there are ``spill_records``;
then they are sorted by pair and cut into radix parts by the pair's first side. Each part is one row: a directory
(pairs, documents a pair) and the postings, both zstd-compressed. Only directories travel: a pair that most documents
hold is one record a run, however many documents there are.

Merging takes one radix part of up to ``fan_in`` runs: a heap holds each run's next pair, and what lies below the smallest
of the runs' block ends is summed. As pairs are in the order of their first side, the highest count of a first-side id is
known when the next id begins; counts and "is highest" then go into each run's own output, in the run's order. With more
runs, groups of them are merged to longer runs first, those merged in turn, and the answers descend the same way.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BLOCK = 1 << 14  # records of a run that are open at a time

_packer, _unpacker = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one value; ascending ones should come as differences."""
    head = np.array([len(arrays[0]), *(a.itemsize for a in arrays)], "<i8").tobytes()
    return _packer.compress(head + b"".join(a.tobytes() for a in arrays))


def unpacked(value: bytes, n_arrays: int) -> list[np.ndarray]:
    plain = _unpacker.decompress(value)
    n, *sizes = np.frombuffer(plain, "<i8", 1 + n_arrays).tolist()
    at, out = 8 * (1 + n_arrays), []
    for size in sizes:
        out.append(np.frombuffer(plain, f"<u{size}", n, at))
        at += n * size
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    return a.astype(f"<u{next(s for s in (1, 2, 4, 8) if not len(a) or int(a.max()) < 1 << 8 * s)}")


def pack_pairs(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    return packed(narrow(np.diff(pairs, prepend=0)), narrow(counts))


def unpack_pairs(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unpacked(value, 2)
    return np.cumsum(steps, dtype=np.int64), counts.astype(np.int64)


def radix_parts(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, sides: int, radixes: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Radix, directory and postings of the records of a run; ``docs`` must be ascending."""
    order = np.argsort(pairs, kind="stable")
    pairs, docs, times = pairs[order], docs[order], times[order]
    radix = pairs // sides % radixes
    order = np.argsort(radix, kind="stable")
    ends = np.searchsorted(radix[order], np.arange(radixes + 1))
    for r in range(radixes):
        part = order[ends[r] : ends[r + 1]]
        if len(part):
            distinct, counts = np.unique(pairs[part], return_counts=True)
            yield r, pack_pairs(distinct, counts), packed(narrow(docs[part]), narrow(times[part]))


def merge(runs: list[tuple[np.ndarray, np.ndarray]], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending pairs with their summed counts, in parts, from runs of ascending pairs."""
    at = [0] * len(runs)
    # The heap's top is the run whose open block ends first: nothing below that pair can come later.
    heap = [(int(pairs[min(block, len(pairs)) - 1]), i) for i, (pairs, _) in enumerate(runs) if len(pairs)]
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        parts = []
        for i, (pairs, counts) in enumerate(runs):
            if at[i] < len(pairs):
                end = at[i] + int(np.searchsorted(pairs[at[i] : at[i] + block], bound, "right"))
                if end > at[i]:
                    parts.append((pairs[at[i] : end], counts[at[i] : end]))
                    at[i] = end
        while heap and heap[0][0] == bound:
            _, i = heapq.heappop(heap)
            if at[i] < len(runs[i][0]):
                heapq.heappush(heap, (int(runs[i][0][min(at[i] + block, len(runs[i][0])) - 1]), i))
        pairs, back = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, back, np.concatenate([c for _, c in parts]))
        yield pairs, total


def with_highest(merged: Iterable[tuple[np.ndarray, np.ndarray]], sides: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``merged`` with a mark on the pairs whose count is the highest of their first side."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def marked(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = pairs // sides
        starts = np.flatnonzero(np.diff(first, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(starts, append=len(pairs)))
        return pairs, counts, counts == highest

    for pairs, counts in merged:
        held.append((pairs, counts))
        if pairs[-1] // sides != held[0][0][0] // sides:
            pairs, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            ready = int(np.searchsorted(pairs // sides, pairs[-1] // sides))  # the last id may go on
            yield marked(pairs[:ready], counts[:ready])
            held = [(pairs[ready:], counts[ready:])]
    if held:
        yield marked(*(np.concatenate(x) for x in zip(*held, strict=True)))


def streamed_back(runs: list[np.ndarray], answers: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Count and mark for every pair of every run; ``answers`` ascend and hold all of them."""
    at = [0] * len(runs)
    out = [(np.zeros(len(p), np.int64), np.zeros(len(p), np.uint8)) for p in runs]
    for pairs, counts, marks in answers:
        for i, own in enumerate(runs):
            end = at[i] + int(np.searchsorted(own[at[i] :], pairs[-1], "right"))
            place = np.searchsorted(pairs, own[at[i] : end])
            out[i][0][at[i] : end], out[i][1][at[i] : end] = counts[place], marks[place]
            at[i] = end
    return out


_BACK = "radix int, run string, answers binary"


def count_pairs(runs: DataFrame, sides: int, fan_in: int, level: int = 0) -> DataFrame:
    """``radix, run, answers`` for ``radix, run, directory``: count and mark per pair, in the directory's order.

    ``runs`` must be a written table. A task holds one radix part of ``fan_in`` runs.
    """
    # A few runs over the mark may fall into a group: runs are dealt by hash.
    n_groups = -(-(runs.select("run").distinct().count() * 2) // fan_in) if runs.select("run").distinct().limit(fan_in + 1).count() > fan_in else 1

    def direct(group: pa.Table) -> pa.Table:
        own = [unpack_pairs(d) for d in group.column("directory").to_pylist()]
        back = streamed_back([p for p, _ in own], with_highest(merge(own), sides))
        values = [packed(narrow(c), m) for c, m in back]
        return pa.table([group.column("radix"), group.column("run"), pa.array(values, pa.binary())], names=["radix", "run", "answers"])

    if n_groups == 1:
        return runs.groupBy("radix").applyInArrow(direct, _BACK)

    def longer(group: pa.Table) -> pa.Table:
        own = [unpack_pairs(d) for d in group.column("directory").to_pylist()]
        pairs, counts = (np.concatenate(x) for x in zip(*merge(own), strict=True))
        head = [group.column(c).slice(0, 1) for c in ("radix", "grp")]
        return pa.table([*head, pa.array([pack_pairs(pairs, counts)], pa.binary())], names=["radix", "run", "directory"])

    def descend(keys, children: pa.Table, parent: pa.Table) -> pa.Table:
        own = [unpack_pairs(d)[0] for d in children.column("directory").to_pylist()]
        pairs, _ = unpack_pairs(parent.column("directory")[0].as_py())
        counts, marks = unpacked(parent.column("answers")[0].as_py(), 2)
        values = [packed(narrow(c), m) for c, m in streamed_back(own, [(pairs, counts, marks)])]
        return pa.table([children.column("radix"), children.column("run"), pa.array(values, pa.binary())], names=["radix", "run", "answers"])

    grouped = runs.withColumn("grp", F.concat(F.lit(f"{level}-"), (F.shiftrightunsigned(F.xxhash64("run"), 20) % n_groups).cast("string")))
    merged = written(grouped.groupBy("radix", "grp").applyInArrow(longer, "radix int, run string, directory binary"), "longer-runs")
    answers = written(count_pairs(merged, sides, fan_in, level + 1), "longer-answers")
    parents = merged.join(answers, ["radix", "run"]).withColumnRenamed("run", "grp")
    return grouped.groupBy("radix", "grp").cogroup(parents.groupBy("radix", "grp")).applyInArrow(descend, _BACK)
