"""Exact and near duplicates, quotient filters, components: against brute force, and the edge cases."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from kbetl.llm import simhash as sh
from kbetl.llm.common import pick
from kbetl.llm.components import component_roots
from kbetl.llm.exact_dedup import FINGERPRINTS_PER_SHARD, _build, exact_dedup, keep_one
from kbetl.llm.quotient_filter import CountingQuotientFilter

SCHEMA = "doc_id long, text string, DOC_ID string, fp string"


def table(spark, *rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


def test_quotient_filters_merge_without_loss():
    random.seed(5)
    values = np.array([random.getrandbits(64) >> random.choice([0, 30]) for _ in range(3000)] * 2 + [0, 2**64 - 1], np.uint64)
    parts = np.array_split(values, 7)
    built = [CountingQuotientFilter.build(p) for p in [*parts, np.empty(0, np.uint64)]]
    merged = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(f.to_bytes()) for f in built])
    want, counts = np.unique(values, return_counts=True)
    assert (merged.fingerprints() == want).all() and (merged.counts == counts).all()
    assert (merged.repeated() == want[counts > 1]).all()
    assert CountingQuotientFilter.merge(built[-1:]).split(3) == {}
    shards = merged.split(3)
    assert np.array_equal(np.concatenate([shards[k].fingerprints() for k in sorted(shards)]), want)
    # Filters of other sizes and of parts of the range are cut anew.
    again = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(f.to_bytes()) for f in shards.values()])
    assert np.array_equal(again.fingerprints(), want) and np.array_equal(again.counts, counts)


def test_filters_are_as_large_as_their_rows():
    """A task's filter and its pieces when the whole table has 2**34 rows."""
    rows, shard_bits = 400_000, ((1 << 34) // FINGERPRINTS_PER_SHARD).bit_length()
    values = np.random.default_rng(1).integers(0, 1 << 63, rows, dtype=np.uint64) * 2
    batches = (pa.RecordBatch.from_arrays([pa.array(x.view(np.int64))], ["fp"]) for x in np.array_split(values, 40))
    tracemalloc.start()
    pieces = [(b.column(0)[0].as_py(), b.column(1)[0].as_py()) for b in _build(shard_bits)(batches)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and len(pieces) > 30_000
    assert sum(len(data) for _, data in pieces) < 2 * 8 * rows
    found = [CountingQuotientFilter.from_bytes(data) for _, data in pieces]
    assert all(int(f.fingerprints()[0]) >> (64 - shard_bits) == k and len(f.occupied) <= 2 * len(f.counts) + 2 for (k, _), f in zip(pieces, found))
    assert np.array_equal(np.concatenate([f.fingerprints() for f in found]), np.unique(values))


def test_exact_dedup_edge_cases(spark):
    rows = [(1, "a"), (3, "a"), (2, "a"), (4, None), (5, ""), (6, "b"), (7, "c"), (7, "c"), (None, "d"), (None, "d"), (None, "a"), (8, "x" * 300_000)]
    order = lambda r: (r.doc_id is None, r.doc_id or 0, not r.kept, r.keep_id or 0)
    got = sorted(exact_dedup(table(spark, *rows)).collect(), key=order)
    seen = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got]
    assert seen == [
        (1, 3, 4, False), (2, 3, 4, False), (3, 3, 4, True), (4, 5, 2, False), (5, 5, 2, True), (6, 6, 1, True), (7, 7, 2, True), (7, 7, 2, False),
        (8, 8, 1, True), (None, None, 2, True), (None, None, 2, False), (None, 3, 4, False),
    ]
    assert got[0].text_sha256 == hashlib.sha256(b"a").hexdigest()
    kept = keep_one(table(spark, *rows))
    assert kept.columns == ["doc_id", "text", "DOC_ID", "fp"]
    assert sorted((r[0], len(r[1] or "")) for r in kept.collect() if r[0] is not None) == [(3, 1), (5, 0), (6, 1), (7, 1), (8, 300_000)]
    assert exact_dedup(table(spark)).count() == 0 and keep_one(table(spark)).count() == 0


def brute_simhash(text, words=4):
    tokens = (text or "").lower().split()
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(fps, distance):
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {f: find(f) for f in fps}


def test_simhash_groups(spark):
    random.seed(7)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(random.choices(words, k=200)) for _ in range(30)]
    texts = base + [t + " end" for t in base[:10]] + [t.upper() for t in base[10:15]] + [None, "", " \t\n", "one", "one two", "One  two"]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "nobody"), (None, texts[1])]
    got = sh.simhash_groups(table(spark, *rows)).collect()
    assert len(got) == len(rows)
    fps = {t: brute_simhash(t) for _, t in rows}
    roots = brute_components(sorted(set(fps.values())), 4)
    least = {}
    for i, t in rows:
        if i is not None:
            least[roots[fps[t]]] = min(i, least.get(roots[fps[t]], i))
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t in rows:
        if i is not None:
            assert by_id[i].fingerprint == f"{fps[t]:016x}" and by_id[i].component_id == least[roots[fps[t]]]
    kept = sh.keep_one_of_near(table(spark, *rows)).collect()
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted(set(least.values()))
    assert sum(r[0] is None for r in kept) == 1
    assert sh.simhash_groups(table(spark)).count() == 0


@pytest.mark.parametrize("large", [1 << 17, 25])
def test_near_links_connect_everything(spark, large):
    """Random fingerprints, chains of close ones, and one dense place that has to be cut."""
    random.seed(11)
    fps = {random.getrandbits(64) for _ in range(300)}
    for start in list(fps)[:40]:
        for _ in range(4):
            for bit in random.sample(range(64), random.randint(1, 4)):
                start ^= 1 << bit
            fps.add(start)
    dense = random.getrandbits(64)
    fps |= {dense ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)}
    rows = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = sh.near_links(spark.createDataFrame(rows, "fp long"), 4, large).collect()
    unsigned = lambda x: x % (1 << 64)
    assert all((unsigned(r.a) ^ unsigned(r.b)).bit_count() <= 4 for r in links)
    assert len(links) < 20 * len(fps)
    found = {r.node: r.root for r in component_roots(spark.createDataFrame([(r.a, r.b) for r in links], "a long, b long")).collect()}
    want = brute_components(sorted(fps), 4)
    groups, seen = {}, {}
    for f in fps:
        signed = f - (1 << 64) if f >> 63 else f
        groups.setdefault(want[f], set()).add(f)
        seen.setdefault(found.get(signed, signed), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, seen.values()))


def test_components_of_a_chain_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 7), (101, 102), (102, 101)]
    got = {r.node: r.root for r in component_roots(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {102: 101}
    assert component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pick_takes_columns_by_exact_name(spark):
    assert [tuple(r) for r in pick(table(spark, (1, "t")), doc_id="doc_id", other="DOC_ID").collect()] == [(1, "x")]
