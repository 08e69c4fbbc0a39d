"""Source divergence audit: term distributions of every source of a language against each other and the language.

1. **Exact frequency filter.** Every task counts the documents that hold a term, per language; the sums decide which
   terms are kept. No sketch, no estimate.
2. **Sharded minimal perfect hashes.** The kept terms of a language are dealt to shards by hash; each shard gets a
   minimal perfect hash (displacements per bucket) with its keys stored in slot order. The hashes of the terms with the
   highest document counts are broadcast, as many as ``broadcast_bytes`` hold.
3. **Recount.** A second pass over the texts finds each term's slot, verifies it against the stored key and adds to
   dense slots per group. A term that is not in a broadcast hash is either not kept or one of the rarer rest; if there
   is a rest, its counts, summed per task, are joined to their slots. The result does not depend on the bound.
4. **Comparison per shard.** A task holds the counts of one shard for all sources of its language (``block_slots`` at
   most, apart from hash variance) and adds up the differences of all pairs; the shards' parts are summed.

All arithmetic is in integers, exact for up to 9e13 occurrences in a group.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_words import byte_table, words_of
from .common import pick, table, written

MIN_DOCUMENTS = 10
TOP = 10
BROADCAST_BYTES = 64 << 20  # bound of the keys and displacements that are broadcast
BLOCK_SLOTS = 1 << 21  # counts that a comparing task holds
SHARD_TERMS = 1 << 14
WAITING_TERMS = 300_000  # distinct terms counted before they are looked up
DENSE_BYTES = 64 << 20  # dense slots of a task before they are passed on
TERM_COST = 16  # bytes a key takes beside its own

LETTERS = byte_table(b"abcdefghijklmnopqrstuvwxyz")
_STEP = 64  # displacements tried at once


def _place(h: np.ndarray, pilot: np.ndarray, m: np.ndarray) -> np.ndarray:
    x = h ^ (pilot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) % m


def _buckets(m):
    return (m + 2) // 3


def perfect_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements and slots of distinct 64-bit hashes; the slots are a permutation.

    Large buckets first: each takes the first displacement that sends its keys to free slots. A bucket with one key
    names its slot outright (as a negative number).
    """
    m, n = len(h), _buckets(len(h))
    if not m:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    bucket = (h % np.uint64(n)).astype(np.int64)
    sizes = np.bincount(bucket, minlength=n)
    members, starts = np.argsort(bucket, kind="stable"), np.cumsum(sizes) - sizes
    taken, pilots, slots = np.zeros(m, bool), np.zeros(n, np.int32), np.full(m, -1)
    by_size = np.argsort(-sizes, kind="stable")
    for b in by_size[: np.count_nonzero(sizes > 1)]:
        keys = members[starts[b] : starts[b] + sizes[b]]
        first = 0
        while True:
            tried = _place(h[keys][:, None], np.arange(first, first + _STEP)[None, :], np.uint64(m)).astype(np.int64)
            tried_sorted = np.sort(tried, axis=0)
            good = np.flatnonzero(~taken[tried].any(0) & (np.diff(tried_sorted, axis=0) > 0).all(0))
            if len(good):
                break
            first += _STEP
        pilots[b], slots[keys] = first + good[0], tried[:, good[0]]
        taken[slots[keys]] = True
    single = np.flatnonzero(sizes == 1)
    slots[members[starts[single]]] = free = np.flatnonzero(~taken)
    pilots[single] = -free - 1
    return pilots, slots


class PerfectHashes:
    """The broadcast shards of one language: slots of terms, -1 for terms that are not in them."""

    def __init__(self, n_shards: int, shards: list[tuple[int, bytes, bytes, bytes]]):
        sizes = np.zeros(n_shards, np.int64)
        parts = {k: (np.frombuffer(p, "<i4"), np.frombuffer(n, "<i4"), keys) for k, p, n, keys in shards}
        for k, (_, lengths, _) in parts.items():
            sizes[k] = len(lengths)
        order = sorted(parts)
        buckets = np.where(sizes > 0, _buckets(sizes), 0)
        self.sizes, self.starts, self.bucket_starts = sizes, np.cumsum(sizes) - sizes, np.cumsum(buckets) - buckets
        self.pilots = np.concatenate([np.zeros(0, "<i4"), *(parts[k][0] for k in order)])
        ends = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, "<i4"), *(parts[k][1] for k in order)]), dtype=np.int64)])
        stored = b"".join(parts[k][2] for k in order)
        self.keys = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype("<i8")), pa.py_buffer(stored)])
        self.n = int(sizes.sum())
        self.shard_of = np.repeat(np.arange(n_shards), sizes).astype(np.int32)

    def find(self, terms: list[bytes]) -> np.ndarray:
        found = np.full(len(terms), -1, np.int64)
        if not self.n or not terms:
            return found
        h = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))
        shard = ((h >> np.uint64(33)) % np.uint64(len(self.sizes))).astype(np.int64)
        at = np.flatnonzero(self.sizes[shard] > 0)
        h, shard = h[at], shard[at]
        m = self.sizes[shard]
        pilot = self.pilots[self.bucket_starts[shard] + (h % _buckets(m).astype(np.uint64)).astype(np.int64)]
        slot = np.where(pilot < 0, -pilot - 1, _place(h, np.maximum(pilot, 0), m.astype(np.uint64)).astype(np.int64)) + self.starts[shard]
        asked = pa.array([terms[i] for i in at.tolist()], pa.large_binary())
        same = pc.equal(self.keys.take(pa.array(slot)), asked).to_numpy(zero_copy_only=False)
        found[at[same]] = slot[same]
        return found


def _document_counts(rows: DataFrame) -> DataFrame:
    """``lang, term, n_docs``: how many documents of a task hold a term, in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def parts() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                terms = list(counts)
                for at in range(0, len(terms), 1 << 16):
                    part = terms[at : at + (1 << 16)]
                    arrays = [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()), pa.array([counts[t] for t in part], pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["lang", "term", "n_docs"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
                terms: set[bytes] = set()
                for words in words_of(text.as_py(), LETTERS):
                    terms.update(words)
                held.setdefault(lang, Counter()).update(terms)
                if sum(map(len, held.values())) > WAITING_TERMS:
                    yield from parts()
        yield from parts()

    return rows.mapInArrow(run, "lang string, term binary, n_docs long").groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"))


def _slots(kept: DataFrame, cutoff: int) -> DataFrame:
    """Slots of all kept terms, and per shard one row with its perfect hash (``slot`` -1).

    Terms in fewer documents than ``cutoff``, and any whose 64-bit hash another term of the shard has, are in no hash;
    their slots follow the others'.
    """

    def build(group: pa.Table) -> pa.Table:
        terms = group.column("term").to_pylist()
        h = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))
        hashed = group.column("n_docs").to_numpy() >= cutoff
        first = np.zeros(len(terms), bool)
        chosen = np.flatnonzero(hashed)
        first[chosen[np.unique(h[chosen], return_index=True)[1]]] = True
        inside, rest = np.flatnonzero(first), np.flatnonzero(~first)
        pilots, places = perfect_hash(h[inside])
        slot = np.empty(len(terms), np.int64)
        slot[inside], slot[rest] = places, len(inside) + np.arange(len(rest))
        keys = [terms[i] for i in inside[np.argsort(places)]]
        lengths = np.fromiter(map(len, keys), "<i4", len(keys)).tobytes()
        n = len(terms) + 1
        return pa.table(
            {
                "lang": group.column("lang").to_pylist() + [group.column("lang")[0].as_py()],
                "shard": pa.array([group.column("shard")[0].as_py()] * n, pa.int32()),
                "n_shards": pa.array([group.column("n_shards")[0].as_py()] * n, pa.int32()),
                "slot": pa.array([*slot.tolist(), -1], pa.int32()),
                "term": pa.array([*terms, b"".join(keys)], pa.binary()),
                "hashed": pa.array([*first.tolist(), True]),
                "pilots": pa.array([None] * len(terms) + [pilots.tobytes()], pa.binary()),
                "lengths": pa.array([None] * len(terms) + [lengths], pa.binary()),
            }
        )

    made = "lang string, shard int, n_shards int, slot int, term binary, hashed boolean, pilots binary, lengths binary"
    return kept.groupBy("lang", "shard").applyInArrow(build, made)


def _recount(rows: DataFrame, hashes, whole: bool) -> DataFrame:
    """Occurrences in dense slots per group: ``lang, source, shards, slots, counts``, and the unknown ``terms`` unless ``whole``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {lang: PerfectHashes(n, shards) for lang, (n, shards) in hashes.value.items()}
        waiting: dict[tuple[str, str], Counter] = {}
        dense: dict[tuple[str, str], np.ndarray] = {}

        def row(group, terms, shards, slots, counts) -> pa.RecordBatch:
            lists = [([terms], pa.binary()), ([shards], pa.int32()), ([slots], pa.int32()), ([counts], pa.int64())]
            arrays = [pa.array([group[0]]), pa.array([group[1]]), *(pa.array(x, pa.list_(t)) for x, t in lists)]
            return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "terms", "shards", "slots", "counts"])

        def looked_up() -> Iterator[pa.RecordBatch]:
            for group, counter in waiting.items():
                terms, n = list(counter), np.fromiter(counter.values(), np.int64, len(counter))
                own = known.get(group[0])
                found = own.find(terms) if own else np.full(len(terms), -1)
                if own and own.n:
                    slots = dense.setdefault(group, np.zeros(own.n, np.int64))
                    slots[found[found >= 0]] += n[found >= 0]
                unknown = np.flatnonzero(found < 0)
                for at in range(0, 0 if whole else len(unknown), 1 << 16):
                    part = unknown[at : at + (1 << 16)]
                    yield row(group, [terms[i] for i in part], None, None, n[part])
                if sum(x.nbytes for x in dense.values()) > DENSE_BYTES:
                    yield from passed_on()
            waiting.clear()

        def passed_on() -> Iterator[pa.RecordBatch]:
            for group, counts in dense.items():
                own, used = known[group[0]], np.flatnonzero(counts)
                shards = own.shard_of[used]
                for at in range(0, len(used), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield row(group, None, shards[part], (used - own.starts[shards])[part], counts[used[part]])
            dense.clear()

        for batch in batches:
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for group, text in zip(names, batch.column(2).cast(pa.binary()), strict=True):
                counter = waiting.setdefault(group, Counter())
                for words in words_of(text.as_py(), LETTERS):
                    counter.update(words)
                if sum(map(len, waiting.values())) > WAITING_TERMS:
                    yield from looked_up()
        yield from looked_up()
        yield from passed_on()

    return rows.mapInArrow(run, "lang string, source string, terms array<binary>, shards array<int>, slots array<int>, counts array<long>")


def _scaled(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(1e9 * count / total) without leaving 64 bits."""
    whole, rest = np.divmod(count * 10**4, total)
    return 1 + whole * 10**5 + rest * 10**5 // total


def _difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _compared(group: pa.Table, top: int) -> pa.Table:
    """One shard of a language: sums of differences for all pairs of sources, and each source's best terms."""
    lang, kind = group.column("lang")[0].as_py(), group.column("slot").to_numpy()
    names, amounts, v = group.column("source").to_pylist(), pc.fill_null(group.column("n"), 0).to_numpy(), group.column("v")[0].as_py()
    words = group.column("term").to_pylist()
    heads = np.flatnonzero(kind < 0).tolist()
    sources, totals = [names[i] for i in heads], np.array([amounts[i] for i in heads], np.int64)
    number = {s: i for i, s in enumerate(sources)}
    is_term = np.array([w is not None for w in words], bool)
    term_rows = np.flatnonzero(is_term)
    m = len(term_rows)
    terms: list[bytes] = [b""] * m
    for i in term_rows.tolist():
        terms[kind[i]] = words[i]
    counts = np.zeros((len(sources), m), np.int64)
    used = np.flatnonzero((kind >= 0) & ~is_term)
    counts[[number[names[i]] for i in used.tolist()], kind[used]] = amounts[used]
    p = _scaled(counts + 2, (totals + 2 * v)[:, None]) if m else np.zeros((len(sources), 0), np.int64)
    q = _scaled(counts.sum(0) + 2, totals.sum() + 2 * v) if m else np.zeros(0, np.int64)
    out: list[tuple] = []
    for a in range(len(sources) - 1):
        for b, value in enumerate(_difference(p[a + 1 :], p[a]).sum(1).tolist(), a + 1):
            out += [(sources[a], sources[b], None, value), (sources[b], sources[a], None, value)]
    place = np.empty(m, np.int64)
    place[sorted(range(m), key=terms.__getitem__)] = np.arange(m)
    for a, source in enumerate(sources):
        better = np.flatnonzero((counts[a] > 0) & (p[a] > q))
        value = _difference(p[a][better], q[better])
        for i in np.lexsort((place[better], -value))[:top].tolist():
            out.append((source, None, terms[better[i]], int(value[i])))
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    kinds = (pa.string(), pa.string(), pa.binary(), pa.int64())
    arrays = [pa.array([lang] * len(out), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
    return pa.table(arrays, names=["lang", "source", "other", "term", "value"])


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_slots: int = BLOCK_SLOTS,
    shard_terms: int = SHARD_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for all (lang, source) groups.

    Part ``pair``: every other source of the language with the summed difference of all kept terms, all ranks. Part
    ``term``: the ``top`` terms that the source uses more than its language. Equal values are ranked by item in UTF-8.

    * Null texts, languages and sources are empty ones; groups without a term still have their pairs.
    * Every row counts as a document, repeated rows and null ids too. A language with one source has no pairs, one
      without kept terms has pairs of value 0. An empty table gives no rows. Further columns are ignored.
    """
    rows = pick(docs, lang=lang_col, source=source_col, text=text_col).select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    )
    kept = written(_document_counts(rows).where(F.col("n_docs") >= min_documents), "kept-terms")
    groups = written(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs")), "groups")
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s")).join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left")
    v = F.coalesce("v", F.lit(0)).cast("long")
    shards = F.greatest(F.lit(1), F.ceil(v * F.col("s") / block_slots), F.ceil(v / shard_terms)).cast("int")
    sizes = written(sizes.select("lang", v.alias("v"), shards.alias("n_shards")), "languages")

    # At most 64 rows: the bytes of the terms by the power of two of their document count.
    power = F.floor(F.log2("n_docs")).cast("int").alias("power")
    bytes_of = {r.power: r.bytes for r in kept.groupBy(power).agg(F.sum(F.length("term") + TERM_COST).alias("bytes")).collect()}
    lowest, room = 64, broadcast_bytes
    for p in sorted(bytes_of, reverse=True):
        if bytes_of[p] > room:
            break
        room, lowest = room - bytes_of[p], p
    whole = not bytes_of or lowest == min(bytes_of)

    shard = (F.shiftrightunsigned(F.xxhash64("term"), 33) % F.col("n_shards")).cast("int")
    dealt = kept.join(sizes.select("lang", "n_shards"), "lang").withColumn("shard", shard)
    slots = written(_slots(dealt, 2**lowest), "slots")
    hashes: dict[str, tuple[int, list]] = {}
    for r in slots.where("slot < 0 and length(term) > 0").select("lang", "n_shards", "shard", "pilots", "lengths", "term").collect():
        hashes.setdefault(r.lang, (r.n_shards, []))[1].append((r.shard, bytes(r.pilots), bytes(r.lengths), bytes(r.term)))
    collided = slots.where("slot >= 0 and not hashed")
    whole = whole and not collided.limit(1).count()
    held = docs.sparkSession.sparkContext.broadcast(hashes)

    found = _recount(rows, held, whole)
    if not whole:
        found = written(found, "recount")
    counted = found.where("slots is not null").select("lang", "source", F.inline(F.arrays_zip("shards", "slots", "counts")).alias("shard", "slot", "n"))
    if not whole:
        others = found.where("terms is not null").select("lang", "source", F.inline(F.arrays_zip("terms", "counts")).alias("term", "n"))
        others = others.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
        counted = counted.unionByName(others.join(collided.select("lang", "term", "shard", "slot"), ["lang", "term"]).select("lang", "source", "shard", "slot", "n"))
    counts = written(counted.groupBy("lang", "shard", "source", "slot").agg(F.sum("n").alias("n")), "counts")

    null = F.lit(None)
    totals = groups.select("lang", "source").join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    heads = totals.join(sizes, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("shard"), "source", F.lit(-1).alias("slot"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"), null.cast("binary").alias("term"), "v",
    )
    sized = sizes.select("lang", "v")
    body = counts.select("lang", "shard", "source", "slot", "n", null.cast("binary").alias("term"))
    keys = slots.where("slot >= 0").select("lang", "shard", null.cast("string").alias("source"), "slot", null.cast("long").alias("n"), "term")
    parts = heads.unionByName(body.unionByName(keys).join(sized, "lang"))

    def compare(group: pa.Table) -> pa.Table:
        return _compared(group, top)

    compared = parts.groupBy("lang", "shard").applyInArrow(compare, "lang string, source string, other string, term binary, value long")
    compared = written(compared, "compared")
    pairs = compared.where("other is not null").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    terms = compared.where("term is not null").select("lang", "source", F.col("term").cast("string").alias("item"), "value")
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = both.withColumn("rank", F.row_number().over(best)).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with docs as (
  select row_number() over () as rn, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
words as (select rn, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term from words group by 1, 2 having count(distinct rn) >= 10),
sizes as (select l.lang, count(k.term)::hugeint as v from (select distinct lang from docs) l left join kept k using (lang) group by 1),
groups as (select distinct lang, source from docs),
counted as (select lang, source, term, count(*)::hugeint as n from words semi join kept using (lang, term) group by 1, 2, 3),
cells as (
  select g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint as n, v
  from groups g join kept k using (lang) join sizes using (lang) left join counted c using (lang, source, term)),
shares as (
  select lang, source, term, n,
         1 + (1000000000 * (n + 2)) // ((sum(n) over (partition by lang, source))::hugeint + 2 * v) as p,
         1 + (1000000000 * ((sum(n) over (partition by lang, term))::hugeint + 2)) // ((sum(n) over (partition by lang))::hugeint + 2 * v) as q
  from cells),
pairs as (
  select g.lang, g.source, h.source as item, coalesce(s.value, 0) as value
  from groups g join groups h on g.lang = h.lang and g.source <> h.source
  left join (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3) s
  on s.lang = g.lang and s.source = g.source and s.item = h.source),
parts as (
  select lang, source, 'pair' as part, item, value from pairs
  union all
  select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from shares where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from parts)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= 10
"""
