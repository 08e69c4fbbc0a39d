"""Packing documents into sequences of bounded length by non-negative least squares over length patterns.

1. Tasks tokenise whole texts and cut documents longer than a sequence; each piece gets a running number among
   the pieces of its length in its task.
2. The histogram of lengths (at most ``max_tokens`` numbers, however many documents there are) is all the
   driver sees. Patterns of one to three lengths that fill a sequence are enumerated, their repeat counts
   fitted to the histogram by non-negative least squares (coordinate descent) and rounded to what is there;
   the residual histogram is packed best-fit decreasing.
3. A piece's rank among all pieces of its length, from its running number and the counts of the tasks
   before, finds its slot in the plan. No group of equal lengths is ever gathered.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, table, written

MAX_TOKENS = 2048
END_ID = 0
CACHED_BYTES = 32 << 20  # of words and ids in each of two generations
ENTRY_BYTES = 160  # what an entry takes beside them
SLICE_BYTES = 1 << 21
_FIT_PASSES = 6



def _byte_letters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class _PlainWords:
    """Merges of a tokenizer file for words of letters only, many at a time.

    The file's tokens that end a word become byte strings with a zero byte at their end, and the order of its
    merges their ranks; a call then encodes words joined by zero bytes.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path) as f:
            model = json.load(f)["model"]
        end, letters = model["end_of_word_suffix"], _byte_letters()
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        alone = [c for c in letters if c in model["vocab"]]
        tokens = [*alone, *(c + end for c in alone), *merged]
        plain = [t.removesuffix(end) for t in tokens]
        raw = [bytes(map(letters.__getitem__, p)) + b"\0" * (p != t) for p, t in zip(plain, tokens, strict=True)]
        # The zero byte is no letter: alone it only marks ends, so it and what it forms by itself come last.
        ranks: dict[bytes, int] = {}
        kept = []
        for r, t in zip(raw, tokens, strict=True):
            if r not in ranks and r not in (b"\0", b"\0\0"):
                ranks[r] = len(ranks)
                kept.append(t)
        ranks[b"\0"] = len(ranks)
        self.ids = np.array([model["vocab"][t] for t in kept] + [-1], np.int64)
        self.ends = np.array([t.endswith(end) for t in kept] + [False])
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})

    def __call__(self, words: list[str]) -> list[bytes]:
        ranks = np.array(self.encoding.encode_ordinary("".join([w + "\0" for w in words])), np.int64)
        data = self.ids[ranks].astype("<u4").tobytes()
        stops = [0, *((np.flatnonzero(self.ends[ranks]) + 1) * 4).tolist()]
        return [data[a:b] for a, b in zip(stops, stops[1:], strict=False)]


class WordTokenizer:
    """Ids of a tokenizer whose tokens never cross white space, remembered by word.

    ASCII capitals are lowered first, as the tokenizer does; not in texts that may hold a special token. Words of
    letters are encoded together by the tokenizer's merges, all others by the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = _PlainWords(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.size = 0

    def _learn(self, words: set[bytes]) -> None:
        """Makes unknown ``words`` known: from the generation before, or else encoded."""
        ends: list[tuple[bytes, bytes]] = []
        letters: dict[bytes, str] = {}
        others: set[bytes] = set()
        for w in words:
            if w in self.older:
                self.known[w] = self.older[w]
                continue
            # Full stops and commas at the end are tokens of their own after a letter.
            stem = w.rstrip(b".,")
            low = stem.decode().lower()
            if low.isalpha() and "\u03c2" not in low and unicodedata.is_normalized("NFC", low):
                letters[stem] = low
                if len(stem) < len(w):
                    ends.append((w, stem))
                    others.add(w[len(stem) :])
            else:
                others.add(w)
        others = {w for w in others if w not in self.known}
        if letters:
            self.known.update(zip(letters, self.plain(list(letters.values())), strict=True))
        if others:
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False)
            self.known.update((w, struct.pack(f"<{len(ids)}I", *ids)) for w, ids in zip(others, (e.ids for e in encoded), strict=True))
        for w, stem in ends:
            self.known[w] = self.known[stem] + self.known[w[len(stem) :]]

    def encode_all(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers; words are looked up for many texts at once."""
        open_: list[bytes] = []  # finished parts of a text longer than a slice
        group: list[tuple[list[bytes], bool]] = []  # words, and whether they end their text
        size = 0

        def settle() -> Iterator[bytes]:
            if self.size > CACHED_BYTES:
                self.known, self.older, self.size = {}, self.known, 0
            new = set().union(*(words for words, _ in group)).difference(self.known)
            self._learn(new)
            # Ids take about as much as their word.
            self.size += sum(map(len, new)) * 2 + ENTRY_BYTES * len(new)
            get = self.known.__getitem__
            for words, ends in group:
                open_.append(b"".join(map(get, words)))
                if ends:
                    yield open_[0] if len(open_) == 1 else b"".join(open_)
                    open_.clear()
            group.clear()

        for text in texts:
            if b"<|" not in text:
                text = text.lower()
            at = 0
            while at < len(text) or not at:
                end = min(len(text), at + SLICE_BYTES)
                while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
                    end += 1
                group.append((text[at:end].split(), end == len(text)))
                size += end - at
                at = max(end, 1)
                if size >= SLICE_BYTES:
                    yield from settle()
                    size = 0
        yield from settle()

    def encode(self, text: bytes) -> bytes:
        return next(self.encode_all([text]))


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, task, nth`` and, if asked for, ``ids`` (binary) of each piece.

    ``nth`` numbers the pieces of one length in one task. A null text is the empty one: one end id.
    """
    end = np.array([END_ID], "<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = WordTokenizer(tokenizer_path).encode_all  # goes with the task: nothing is left in a reused worker
        seen = [0] * (max_tokens + 1)
        for batch in batches:
            source, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            texts = (t.as_py() or b"" for t in batch.column(1).cast(pa.binary()))
            for row, tokens in enumerate(encode_all(texts)):
                data = tokens + end
                for k, at in enumerate(range(0, len(data), 4 * max_tokens)):
                    part = data[at : at + 4 * max_tokens]
                    n = len(part) // 4
                    source.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    nth.append(seen[n])
                    seen[n] += 1
                    if keep_ids:
                        ids.append(part)
            take = pa.array(source, pa.int64())
            columns = [
                batch.column(0).take(take),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                batch.column(2).take(take),
                pa.array(nth, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * keep_ids, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids binary" * keep_ids
    return docs.select("doc_id", "text", F.spark_partition_id().alias("task")).mapInArrow(cut, schema)


def fit_patterns(counts: list[int], size: int) -> dict[tuple[int, ...], float]:
    """Repeat counts (not yet whole) of patterns of one to three lengths that sum to ``size``.

    Minimises the squared difference between the pieces the patterns use and ``counts`` (by length), with no
    count below zero: coordinate descent from zero, one pattern after the other, until steps are below half
    a sequence. Patterns of long pieces come first.
    """
    left = [float(c) for c in counts]
    present = [k for k in range(1, size + 1) if counts[k]]
    there = set(present)
    patterns: list[tuple[int, ...]] = [(size,)] if size in there else []
    patterns += [(a, size - a) for a in reversed(present) if 2 * a >= size and size - a in there]
    for a in reversed(present):
        if 3 * a < size:
            break
        rest = size - a
        patterns += [(a, b, rest - b) for b in range(min(a, rest - 1), (rest - 1) // 2, -1) if b in there and rest - b in there]
    times = [0.0] * len(patterns)
    squares = [sum(p.count(x) ** 2 for x in set(p)) for p in patterns]
    for _ in range(_FIT_PASSES):
        moved = 0.0
        for i, pattern in enumerate(patterns):
            step = 0.0
            for x in pattern:
                step += left[x]
            step /= squares[i]
            if step < 0.5 and (times[i] == 0.0 or step > -0.5):
                continue
            step = max(step, -times[i])
            times[i] += step
            for x in pattern:
                left[x] -= step
            moved = max(moved, abs(step))
        if moved < 0.5:
            break
    return {p: t for p, t in zip(patterns, times, strict=True) if t > 0}


def _best_fit(counts: list[int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: equal sequences are held once, with their number."""
    by_free: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    free_sizes = [0] * (size + 1)  # sequences by free space
    for length in range(size, 0, -1):
        n = counts[length]
        free = length
        while n:
            while free <= size and not free_sizes[free]:
                free += 1
            if free > size:
                fresh = -(-n // (size // length)) if n else 0
                each = size // length
                full, rest = divmod(n, each)
                for pattern, k in (((length,) * each, full), ((length,) * rest, 1 if rest else 0)):
                    if k:
                        space = size - length * len(pattern)
                        by_free.setdefault(space, []).append((pattern, k))
                        free_sizes[space] += k
                assert fresh == full + bool(rest)
                break
            pattern, k = by_free[free].pop()
            used = min(k, n)
            free_sizes[free] -= k
            if k > used:
                by_free[free].append((pattern, k - used))
                free_sizes[free] += k - used
            by_free.setdefault(free - length, []).append(((*pattern, length), used))
            free_sizes[free - length] += used
            n -= used
            free = length
    return [x for group in by_free.values() for x in group]


def plan_sequences(histogram: dict[int, int], size: int = MAX_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how many sequences have each; every piece of ``histogram`` (length: number) has a place."""
    counts = [0] * (size + 1)
    for length, n in histogram.items():
        counts[length] = n
    plan = []
    fitted = fit_patterns(counts, size)
    for pattern in sorted(fitted, key=lambda p: (-fitted[p], p)):
        times = min(round(fitted[pattern]), *(counts[x] // pattern.count(x) for x in pattern))
        if times:
            plan.append((pattern, times))
            for x in pattern:
                counts[x] -= times
    return plan + _best_fit(counts, size)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """By (length, first rank): the first sequence and the place of the pieces from that rank on."""
    used: dict[int, int] = {}
    rows = []
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    table_ = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return (table_[:, 0] << 48) + table_[:, 1], table_[:, 2], table_[:, 3]


def place_pieces(pieces: DataFrame, size: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` (with ``length, task, nth``) with ``sequence_id, offset`` in place of ``task, nth``."""
    by_task = written(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(not 0 < k <= size for k in histogram):
        raise ValueError(f"lengths must be from 1 to {size}")
    keys, sequences, offsets = _slots(plan_sequences(histogram, size))
    shared = pieces.sparkSession.sparkContext.broadcast((keys, sequences, offsets))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_task.select(F.col("task").alias("_task"), F.col("length").alias("_length"), F.coalesce(before, F.lit(0)).alias("_base"))
    kept = [c for c in pieces.columns if c not in ("task", "nth")]
    ranked = pieces.join(bases, (pieces.task == bases._task) & (pieces.length == bases._length)).select(
        *kept, (F.col("_base") + F.col("nth")).alias("_rank")
    )
    at = kept.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = shared.value
        for batch in batches:
            length, rank = batch.column(at).to_numpy(), batch.column(len(kept)).to_numpy()
            slot = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            sequence = sequences[slot] + rank - (keys[slot] & ((1 << 48) - 1))
            columns = [*batch.columns[: len(kept)], pa.array(sequence), pa.array(offsets[slot])]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    schema = ranked.drop("_rank").withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return ranked.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset``.

    * A null text is the empty one: a piece of one end id. Documents longer than ``max_tokens`` are cut.
    * Repeated rows and null ids are packed like any other row. An empty table gives no rows.
    * Further columns are ignored.
    """
    pieces = written(token_pieces(pick(docs, doc_id=id_col, text=text_col), tokenizer_path, max_tokens, keep_ids), "pieces")
    return place_pieces(pieces, max_tokens)


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_tokenizer_path(), keep_ids=False)
