"""A counting quotient filter over 64-bit fingerprints, built and merged with array operations.

A fingerprint is cut into a quotient (its high bits, which name a run) and a remainder. Only remainders
are stored, sorted inside their run; ``occupied`` marks the quotients that have a run and ``run_ends`` the
last slot of each. As the remainder keeps all low bits, no fingerprint is lost: filters merge exactly, by merging
their sorted runs and adding counts.

The number of quotients follows the filter's own slots, about four to a quotient, in the range of fingerprints it is
for. Filters with other cuts are cut anew when they are merged, which loses nothing either.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_HEADER = struct.Struct("<BBQQQ")
SLOTS_PER_RUN_BITS = 2


def _bits_for(slots: int, shard_bits: int) -> int:
    """Bits of the quotient: those all fingerprints share, and about one quotient for four slots."""
    return min(63, shard_bits + max(1, slots.bit_length() - SLOTS_PER_RUN_BITS))


@dataclass(frozen=True)
class CountingQuotientFilter:
    quotient_bits: int
    shard_bits: int  # high bits that all its fingerprints share
    first: int  # smallest quotient this filter may hold
    occupied: np.ndarray  # bool, one per quotient from ``first`` on
    run_ends: np.ndarray  # bool, one per slot
    remainders: np.ndarray  # uint64, one per slot
    counts: np.ndarray  # uint64, one per slot

    @classmethod
    def build(cls, fingerprints: np.ndarray) -> CountingQuotientFilter:
        values, counts = np.unique(fingerprints.astype(np.uint64, copy=False), return_counts=True)
        return cls._from_sorted(values, counts.astype(np.uint64))

    @classmethod
    def _from_sorted(cls, values: np.ndarray, counts: np.ndarray, shard_bits: int = 0) -> CountingQuotientFilter:
        bits = _bits_for(len(values), shard_bits)
        shift = np.uint64(64 - bits)
        quotients = values >> shift
        first = int(quotients[0]) if len(quotients) else 0
        span = int(quotients[-1]) - first + 1 if len(quotients) else 0
        occupied = np.zeros(span, bool)
        occupied[(quotients - np.uint64(first)).astype(np.int64)] = True
        run_ends = np.ones(len(values), bool)
        run_ends[:-1] = quotients[1:] != quotients[:-1]
        return cls(bits, shard_bits, first, occupied, run_ends, values & ((np.uint64(1) << shift) - np.uint64(1)), counts)

    def fingerprints(self) -> np.ndarray:
        """All fingerprints in ascending order."""
        runs = np.flatnonzero(self.occupied).astype(np.uint64) + np.uint64(self.first)
        ends = np.flatnonzero(self.run_ends)
        lengths = np.diff(ends, prepend=-1)
        return (np.repeat(runs, lengths) << np.uint64(64 - self.quotient_bits)) | self.remainders

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """The filter of the union of the multisets, cut for its size."""
        values = np.concatenate([f.fingerprints() for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(values, kind="stable")  # merges the sorted runs
        values, counts = values[order], counts[order]
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))
        total = np.add.reduceat(counts, starts) if len(starts) else counts
        return cls._from_sorted(values[starts], total, min(f.shard_bits for f in filters))

    def split(self, shard_bits: int) -> dict[int, CountingQuotientFilter]:
        """Filters of the fingerprints with the same high ``shard_bits``, by those bits."""
        values = self.fingerprints()
        shards = values >> np.uint64(64 - shard_bits) if shard_bits else np.zeros(len(values), np.uint64)
        present, starts = np.unique(shards, return_index=True)
        ends = [*starts[1:], len(values)][: len(starts)]
        return {
            int(s): self._from_sorted(values[a:b], self.counts[a:b], shard_bits)
            for s, a, b in zip(present, starts, ends, strict=True)
        }

    def repeated(self) -> np.ndarray:
        """Fingerprints with a count above one."""
        return self.fingerprints()[self.counts > 1]

    def to_bytes(self) -> bytes:
        head = _HEADER.pack(self.quotient_bits, self.shard_bits, self.first, len(self.occupied), len(self.remainders))
        bits = np.packbits(self.occupied).tobytes() + np.packbits(self.run_ends).tobytes()
        highest = int(self.counts.max(initial=0))
        width = next(w for w in (1, 2, 4, 8) if highest < 1 << 8 * w)
        return head + bits + self.remainders.astype("<u8").tobytes() + bytes([width]) + self.counts.astype(f"<u{width}").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        quotient_bits, shard_bits, first, span, slots = _HEADER.unpack_from(data)
        at = _HEADER.size
        occupied = np.unpackbits(np.frombuffer(data, np.uint8, (span + 7) // 8, at), count=span).astype(bool)
        at += (span + 7) // 8
        run_ends = np.unpackbits(np.frombuffer(data, np.uint8, (slots + 7) // 8, at), count=slots).astype(bool)
        at += (slots + 7) // 8
        remainders = np.frombuffer(data, "<u8", slots, at)
        at += 8 * slots
        counts = np.frombuffer(data, f"<u{data[at]}", slots, at + 1).astype(np.uint64)
        return cls(quotient_bits, shard_bits, first, occupied, run_ends, remainders, counts)
