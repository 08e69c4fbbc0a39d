"""SimHash near-duplicates: pivot distance tables discard pairs, Hamming distances decide.

Fingerprints are computed once and equal ones merged, so copies cost one row each before any pair is looked
at. The distances of a fingerprint to fixed reference fingerprints (its coordinates) bound its distance to
any other from below: a pair whose coordinates differ by more than the limit anywhere is discarded, and only
survivors have their bits compared.

A table of coordinates alone doesn't say which pairs to look at without looking at all of them, so meeting
places come first: with at most ``d`` differing bits, two fingerprints cut into ``d + k`` blocks agree on
``k`` whole blocks. Every fingerprint is sent to one place for each choice of ``k`` blocks; ``k`` grows with
the number of fingerprints so that chance meetings stay few. No pair within the limit is lost. Links found
are the edges of a spanning forest in each place, so a dense group never yields all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, pick, table, written
from .components import component_roots

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
PIVOTS = 32
MEETINGS = 8  # chance meetings allowed for a fingerprint in one place
SMALL_PLACE = 16  # up to here all pairs of a place are looked at together
LARGE_PLACE = 1 << 17  # above, a place is cut into cells of pairs of parts

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_BASE = np.arange(8, dtype=np.int64) * 256


def pivots(count: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: hashes of their numbers, the same on every machine."""
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}", SEED) for i in range(count)], np.uint64)


def simhash(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one UTF-8 text as a signed long: bit by bit the majority of its shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle_words + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    stops = ends[min(shingle_words, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros((8, 256), np.int64)
    for at in range(0, n, 65536):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + 65536], stops[at : at + 65536], strict=True)])
        values = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
        counts += np.bincount((values + _BYTE_BASE).ravel(), minlength=2048).reshape(8, 256)
    majority = (counts @ _BITS) * 2 > n  # digests are big-endian: row 0 is the highest byte
    return int.from_bytes(np.packbits(majority, axis=1, bitorder="little").tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, fp`` of each row of ``doc_id, text``; a null text has no words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            values = [simhash(t.as_py() or b"", shingle_words) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values, pa.int64())], ["doc_id", "text_key", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    return docs.select("doc_id", "text", key).mapInArrow(hashed, f"doc_id {kind}, text_key long, fp long")


def _blocks(n: int, distance: int) -> tuple[int, int]:
    """How many blocks a fingerprint is cut into and on how many a pair must agree."""
    for k in range(1, 6):
        blocks = distance + k
        if n <= MEETINGS << int(64 * k / blocks):
            break
    return blocks, k


def block_masks(n: int, distance: int) -> list[int]:
    """For each choice of blocks, the mask of their bits."""
    blocks, k = _blocks(n, distance)
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    own = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(own, k)]


def _coordinates(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def _near(fa: np.ndarray, fb: np.ndarray, ta: np.ndarray, tb: np.ndarray, distance: int) -> np.ndarray:
    """Positions of the pairs within ``distance``: pivot coordinates discard, the bits of the rest are compared."""
    left = np.arange(max(len(fa), len(fb)))
    fa, ta = np.broadcast_to(fa, left.shape), np.broadcast_to(ta, (len(left), ta.shape[-1]))
    fb, tb = np.broadcast_to(fb, left.shape), np.broadcast_to(tb, (len(left), tb.shape[-1]))
    for at in range(0, ta.shape[1], 8):
        apart = np.abs(ta[left, at : at + 8] - tb[left, at : at + 8]).max(axis=1, initial=0)
        left = left[apart <= distance]
    return left[np.bitwise_count(fa[left] ^ fb[left]) <= distance]


def _forest(fps: np.ndarray, coords: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges of a spanning forest of one large place, grown from one member after the other."""
    rest = np.arange(1, len(fps))
    queue, a, b = [0], [], []
    while len(rest):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
            continue
        i = queue.pop()
        hit = _near(fps[i : i + 1], fps[rest], coords[i : i + 1], coords[rest], distance)
        if len(hit):
            found = rest[hit]
            a.append(np.full(len(found), fps[i]))
            b.append(fps[found])
            queue.extend(found.tolist())
            rest = np.delete(rest, hit)
    return a, b


def _links_of(keys: np.ndarray, fps: np.ndarray, refs: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links inside runs of equal keys."""
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(edges, len(keys)))
    coords = _coordinates(fps, refs)
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    of_row = np.repeat(sizes, sizes)
    small = np.flatnonzero((of_row <= SMALL_PLACE) & (of_row > 1))
    step = 1
    while len(small):
        small = small[small + step < len(keys)]
        small = small[keys[small] == keys[small + step]]
        hit = small[_near(fps[small], fps[small + step], coords[small], coords[small + step], distance)]
        a.append(fps[hit])
        b.append(fps[hit + step])
        step += 1
    for start, size in zip(edges[sizes > SMALL_PLACE], sizes[sizes > SMALL_PLACE], strict=True):
        more = _forest(fps[start : start + size], coords[start : start + size], distance)
        a += more[0]
        b += more[1]
    none = [np.empty(0, np.uint64)]
    left, right = np.concatenate(a or none), np.concatenate(b or none)
    return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])


def _places(refs: np.ndarray, distance: int):
    """Reads rows sorted by key; a run that goes on in the next batch is carried over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            waiting.append((k, f))
            if k[0] == k[-1] and waiting[0][0][0] == k[-1]:
                continue  # one run so far
            keys, fps = (np.concatenate(x) for x in zip(*waiting, strict=True))
            cut = int(np.searchsorted(keys, keys[-1])) if np.all(keys[:-1] <= keys[1:]) else 0
            if cut:
                yield _links_of(keys[:cut], fps[:cut], refs, distance)
            waiting = [(keys[cut:], fps[cut:])]
        if waiting:
            keys, fps = (np.concatenate(x) for x in zip(*waiting, strict=True))
            yield _links_of(keys, fps, refs, distance)

    return run


def near_links(distinct: DataFrame, distance: int = MAX_DISTANCE, large: int = LARGE_PLACE) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints (column ``fp``, distinct) within ``distance`` bits.

    A place with more than ``large`` fingerprints is cut into parts, and every pair of parts becomes a place
    of its own; so no task holds more than about twice ``large`` of one place.
    """
    if not 0 <= distance < 60:
        raise ValueError("distance must be from 0 to 59")
    masks = block_masks(distinct.count(), distance)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    key = F.explode(F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)))).alias("key")
    rows = distinct.select(key, "fp")
    crowded = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large), "crowded")
    if crowded.limit(1).count():
        parts = F.ceil(F.col("n") / F.lit(large)).cast("int")
        own = F.pmod(F.xxhash64(F.lit("part"), "fp"), parts).cast("int")
        cell = F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")
        spread = (
            rows.join(crowded, "key")
            .select("key", "fp", own.alias("own"), cell)
            .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")
        )
        rows = rows.join(crowded, "key", "left_anti").unionByName(spread)
    refs = pivots()
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_places(refs, distance), "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, distance: int) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` of each row; ``root`` is the least fingerprint of the group."""
    if shingle_words < 1:
        raise ValueError("shingle_words must be positive")
    rows = written(fingerprints(pick(docs, doc_id=id_col, text=text_col), shingle_words), "simhash")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    roots = written(component_roots(near_links(distinct.select("fp"), distance)), "simhash-roots")
    linked = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    of_root = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("size"))
    named = linked.join(of_root.where("size > 1"), "root").select(F.col("fp").alias("named"), "root", "component_id")
    joined = rows.join(named, rows.fp == named.named, "left")
    component = F.when(F.col("named").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "text_key", "fp", F.coalesce("root", "fp").alias("root"), component.alias("component_id"))


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    The fingerprint is in 16 lowercase hex digits; ``component_id`` is the smallest id that can be reached
    over pairs of fingerprints at most ``distance`` bits apart.

    * A null text, and one without words, has fingerprint zero and is linked like any other.
    * Fewer words than a shingle: the whole sequence is the one shingle. Texts are read whole.
    * Repeated rows and ties give the same values; each row is returned. Null ids are never a component's
      id unless all its ids are null. An empty table gives no rows. Further columns are ignored.
    """
    rows = _grouped(docs, id_col, text_col, shingle_words, distance)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_near(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Among different texts with that id the one with the smallest hash stays, among repeated rows any one.
    """
    rows = written(_grouped(docs, id_col, text_col, shingle_words, distance), "simhash-groups")
    first = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    each = first.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    least = each.groupBy("root").agg(F.min("text_key").alias("text_key"))
    return keep_rows(docs, each.join(least, ["root", "text_key"]), id_col, text_col, F.xxhash64)


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
