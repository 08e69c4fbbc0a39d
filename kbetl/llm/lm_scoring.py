"""Log-likelihood of whole documents under a gated recurrent language model learned from the corpus.

1. Tokens of the documents to learn from are counted; the counts are a written table, however many there are.
2. The ``MODELLED`` most frequent tokens are symbols of the network, in classes of about equal root frequency.
   All others, unknown ones included, stand for one of ``TAIL_SYMBOLS`` symbols by a hash of their ending, which
   form a class of their own; inside such a symbol a token has its share of the counts, plus one.
3. Every text becomes its symbols once, in a written table with a folder for each round of learning. Frequent tokens
   are looked up in a table of at most ``DICTIONARY`` entries; the others meet their counts in one join of token lists
   with the table of counts and come back as sums by document.
4. The network learns from every text once, in rounds of growing size. In a round each task trains on its own
   texts from the common weights; the weights are averaged in a tree of grouped sums, and only the average, of a
   size that doesn't depend on the corpus, comes to the driver.
5. Every text is scored whole, with the state carried from its first token to its end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import crc32_bucket, pick, table, written
from .gated_lm import GatedLM

DICTIONARY = 1 << 16
MODELLED = 2048
WORD_CLASSES = 32
TAIL_SYMBOLS = 64
ENDING_BYTES = 3
END = ""  # no word is empty: stands for the end of a text
GROUP_TOKENS = 2_000_000  # tokens dealt to lanes at once
SYMBOL = "<u2"  # how a symbol is written; there are fewer than 65,536
COUNTED_WORDS = 500_000
# Sixteenths of the texts in each round: the later ones start from better weights.
ROUNDS = ((0,), (1,), (2, 3), (4, 5, 6, 7), (8, 9, 10, 11, 12, 13, 14, 15))
VECTOR_PARTS = 16


def _tail(word: bytes) -> int:
    return crc32(word[-ENDING_BYTES:]) % TAIL_SYMBOLS


def _tail_column(token: Column) -> Column:
    return (F.crc32(F.substring(token.cast("binary"), -ENDING_BYTES, ENDING_BYTES)) % TAIL_SYMBOLS).cast("int")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and ends in one task's texts, in parts of bounded size."""
    counts: Counter[bytes] = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["token", "n"])
        counts.clear()

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            counts.update((text.as_py() or b"").lower().split())
            counts[END.encode()] += 1
            if len(counts) > COUNTED_WORDS:
                yield from flush()
    yield from flush()


def token_counts(texts: DataFrame) -> DataFrame:
    """``token, n`` over the one column of ``texts``; the empty token counts the texts' ends."""
    return texts.mapInArrow(_count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """Frequent tokens with their counts (``END`` first, then by falling count), and sums over all tokens."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int  # all tokens learned from
    kinds: int  # distinct ones
    tail_counts: np.ndarray  # tokens that stand for each tail symbol
    tail_sums: np.ndarray  # their counts plus one each, and one for what is unknown

    @property
    def modelled(self) -> int:
        return min(MODELLED, len(self.words))

    def symbols(self) -> np.ndarray:
        """The network's symbol of each dictionary word."""
        tails = self.modelled + np.array([_tail(w) for w in self.words], np.int32)
        return np.where(np.arange(len(self.words)) < self.modelled, np.arange(len(self.words), dtype=np.int32), tails)

    @cached_property
    def index(self) -> tuple[_Index, np.ndarray]:
        """Places of words, and the symbol of each place; made once in a worker."""
        places = _Index(zip(self.words, range(len(self.words)), strict=True))
        places.size = len(self.words)
        return places, np.concatenate([self.symbols(), self.modelled + np.arange(TAIL_SYMBOLS)]).astype(np.int32)

    def bounds(self) -> np.ndarray:
        """Classes of about equal sums of root counts; the tail symbols are the last one."""
        mass = np.cumsum(np.sqrt(self.counts[: self.modelled] + 1.0))
        cuts = np.searchsorted(mass, mass[-1] * np.arange(1, WORD_CLASSES) / WORD_CLASSES) if self.modelled else []
        inner = sorted({int(c) for c in cuts if 0 < c < self.modelled})
        return np.array([*([0] if self.modelled else []), *inner, self.modelled, self.modelled + TAIL_SYMBOLS])


def collect_vocabulary(counts: DataFrame) -> Vocabulary:
    """The bounded part of the written table ``token, n`` that tasks need."""
    sums = counts.groupBy(_tail_column(F.col("token")).alias("tail")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    # Counts in steps of an eighth of a power of two, a few hundred at most: the dictionary is made of the highest
    # steps that fit it together, so no task sends more than its part of them.
    step = F.floor(F.log2("n") * 8).cast("int")
    words_only = counts.where(F.col("token") != END)
    sizes = {r.step: r.kinds for r in words_only.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("kinds")).collect()}
    lowest, room = max(sizes, default=0) + 1, DICTIONARY - 1
    for k in sorted(sizes, reverse=True):
        if (room := room - sizes[k]) < 0:
            break
        lowest = k
    top = sorted(words_only.where(step >= lowest).collect(), key=lambda r: (-r.n, r.token))
    ends = counts.where(F.col("token") == END).first()
    rows = ([ends] if ends else []) + top
    words, n = [r.token.encode() for r in rows], np.array([r.n for r in rows], np.int64)
    tail_counts, tail_kinds = np.zeros(TAIL_SYMBOLS, np.int64), np.zeros(TAIL_SYMBOLS, np.int64)
    for r in sums:
        tail_counts[r.tail], tail_kinds[r.tail] = r.n, r.kinds
    tokens, kinds = int(tail_counts.sum()), int(tail_kinds.sum())
    for word, c in zip(words[:MODELLED], n, strict=False):
        tail_counts[_tail(word)] -= c
        tail_kinds[_tail(word)] -= 1
    return Vocabulary(words, n, tokens, kinds, tail_counts, tail_counts + tail_kinds + 1)


class _Index(dict):
    """Places of dictionary words; of others, the place after the dictionary of their tail symbol."""

    def __missing__(self, word: bytes) -> int:
        return self.size + _tail(word)


def _places(text: bytes | None, index: _Index) -> tuple[np.ndarray, list[bytes]]:
    words = (text or b"").lower().split()
    words.append(END.encode())
    return np.fromiter(map(index.__getitem__, words), np.int32, len(words)), words


def _tokenised(vocabulary_shared):
    """Symbols of each text, and what its tokens have besides the network's part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_shared.value
        index, symbols = vocabulary.index
        written_symbols, size_of_index, everything = symbols.astype(SYMBOL), len(vocabulary.words), vocabulary.tokens + vocabulary.kinds + 1
        base = np.log10((vocabulary.counts + 1) / everything)
        # What a dictionary word that isn't a symbol of its own has inside its tail symbol.
        inside = np.log10((vocabulary.counts + 1) / vocabulary.tail_sums[[_tail(w) for w in vocabulary.words]]) if vocabulary.words else base
        inside[: vocabulary.modelled] = 0.0
        base, inside = (np.concatenate([x, np.zeros(TAIL_SYMBOLS)]) for x in (base, inside))
        seen = 0
        for batch in batches:
            uids, lengths, known, bases, insides, tails, coded = [], [], [], [], [], [], []
            for text, task in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
                places, words = _places(text.as_py(), index)
                rare = np.flatnonzero(places >= size_of_index).tolist()
                uids.append((task << 33) + seen)
                seen += 1
                lengths.append(len(places))
                known.append(len(places) - len(rare))
                bases.append(base[places].sum())
                insides.append(inside[places].sum())
                tails.append([words[i] for i in rare])
                coded.append(written_symbols[places].tobytes())
            numbers = [pa.array(x, pa.int64()) for x in (uids, lengths, known)]
            sums = [pa.array(x, pa.float64()) for x in (bases, insides)]
            tail = pa.array(tails, pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            columns = [batch.column(0), batch.column(3), *numbers, *sums, tail, pa.array(coded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "round", "uid", "n_tokens", "known", "base", "inside", "tail", "symbols"])

    return run


def tokenise(rows: DataFrame, learn: Column, vocabulary_shared) -> DataFrame:
    """Every text of ``doc_id, text`` once as symbols: a written table with a folder for each round (-1: not learned)."""
    turn = F.pmod(F.xxhash64("doc_id", F.lit("turn")), F.lit(16))
    number = F.lit(-1)
    for k, turns in enumerate(ROUNDS):
        number = F.when(learn & turn.isin(*turns), k).otherwise(number)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, round int, uid long, n_tokens long, known long, base double, inside double, tail array<string>, symbols binary"
    marked = rows.select("doc_id", "text", F.spark_partition_id().cast("long").alias("task"), number.alias("round"))
    coded = marked.mapInArrow(_tokenised(vocabulary_shared), schema)
    path = scratch_dir(rows.sparkSession, "lm-symbols")
    coded.write.partitionBy("round").parquet(path)
    return rows.sparkSession.read.schema(coded.schema).parquet(path)


def _symbols(values: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(v.as_buffer(), SYMBOL).astype(np.int32) for v in values)


def _train(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: GatedLM = shared.value
        model = model.with_vector(model.vector())  # the broadcast object stays as it is
        waiting: list[np.ndarray] = []
        size = learned = 0
        for batch in batches:
            for text in _symbols(batch.column(0)):
                waiting.append(text)
                size += len(text)
                if size >= GROUP_TOKENS:
                    learned += model.train(waiting)
                    waiting, size = [], 0
        if waiting:
            learned += model.train(waiting)
        if learned:
            parts = np.array_split(model.vector().astype(np.float64) * learned, VECTOR_PARTS)
            numbers = pa.array(range(VECTOR_PARTS), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [numbers, pa.array([learned] * VECTOR_PARTS, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "weight", "vector"]
            )

    return run


def _sum_vectors(group: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(v.as_buffer(), np.float64) for v in group.column("vector")], axis=0)
    weight = sum(group.column("weight").to_pylist())
    return pa.table([group.column("part").slice(0, 1), pa.array([weight], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["part", "weight", "vector"])


def train_model(texts: DataFrame, vocabulary: Vocabulary) -> GatedLM:
    """The network after one pass over the texts of ``symbols, round``."""
    sc = texts.sparkSession.sparkContext
    counts = np.concatenate([vocabulary.counts[: vocabulary.modelled], vocabulary.tail_counts])
    model = GatedLM.start(counts, vocabulary.bounds())
    schema = "part int, weight long, vector binary"
    for k in range(len(ROUNDS)):
        shared = sc.broadcast(model)
        trained = texts.where(F.col("round") == k).select("symbols").mapInArrow(_train(shared), schema)
        trained = written(trained.withColumn("salt", F.spark_partition_id()), "lm-weights")
        salts = max(1, math.isqrt(trained.select("salt").distinct().count()))
        some = trained.withColumn("salt", F.col("salt") % salts).groupBy("part", "salt").applyInArrow(_sum_vectors, schema)
        sums = sorted(some.groupBy("part").applyInArrow(_sum_vectors, schema).collect(), key=lambda r: r.part)
        if sums:
            model = model.with_vector(np.concatenate([np.frombuffer(r.vector, np.float64) / r.weight for r in sums]))
        shared.unpersist()
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: GatedLM = shared.value
        held: list[pa.RecordBatch] = []
        texts: list[np.ndarray] = []
        waiting = 0

        def settle() -> Iterator[pa.RecordBatch]:
            scores = model.score(texts) / math.log(10)
            at = 0
            for b in held:
                own = scores[at : at + b.num_rows] + b.column("inside").to_numpy()
                at += b.num_rows
                columns = [*(b.column(c) for c in ("doc_id", "uid", "n_tokens", "known", "base")), pa.array(own)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "uid", "n_tokens", "known", "base", "own"])
            held.clear()
            texts.clear()

        for batch in batches:
            # Parts of a batch, so that no more than about a group of tokens waits.
            ends = np.cumsum(batch.column("n_tokens").to_numpy())
            start = 0
            while start < batch.num_rows:
                done = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + GROUP_TOKENS - waiting, "right")))
                part = batch.slice(start, stop - start)
                texts.extend(_symbols(part.column("symbols")))
                held.append(part)
                waiting += int(ends[stop - 1]) - done
                start = stop
                if waiting >= GROUP_TOKENS or stop < batch.num_rows:
                    yield from settle()
                    waiting = 0
        if held:
            yield from settle()

    return run


def lm_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words, ASCII capitals in lower case, and one end. ``learn`` is a condition on ``doc_id``: only
    texts where it holds are learned from. Scores are log10 probabilities of the whole text with its end:
    ``base_score`` by token counts plus one, ``score`` by the network.

    * A null or blank text is its end only. Texts of any length are scored whole, in one piece.
    * Repeated rows are learned from and returned one by one; equal texts have equal scores up to rounding.
    * Nothing to learn from: all tokens are unknown, the base score is 0, the network's that of its first weights.
    * An empty table gives no rows. Null ids are returned as they are. Further columns are ignored.
    """
    sc = docs.sparkSession.sparkContext
    rows = pick(docs, doc_id=id_col, text=text_col)
    learned = rows.where(F.coalesce(learn, F.lit(False)))
    counts = written(token_counts(learned.select("text")), "lm-counts")
    vocabulary = collect_vocabulary(counts)
    vocabulary_shared = sc.broadcast(vocabulary)
    coded = tokenise(rows, F.coalesce(learn, F.lit(False)), vocabulary_shared)
    shared = sc.broadcast(train_model(coded.select("symbols", "round"), vocabulary))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, uid long, n_tokens long, known long, base double, own double"
    scored = written(coded.drop("round", "tail").mapInArrow(_score(shared), schema), "lm-scored")
    everything = float(vocabulary.tokens + vocabulary.kinds + 1)
    sums = F.element_at(F.array(*(F.lit(float(z)) for z in vocabulary.tail_sums)), _tail_column(F.col("token")) + 1)
    more = F.coalesce("n", F.lit(0)) + 1.0
    rare = (
        coded.select("uid", F.explode("tail").alias("token"))
        .join(counts, "token", "left")
        .groupBy("uid")
        .agg(F.count("n").alias("rare_known"), F.sum(F.log10(more / everything)).alias("rare_base"), F.sum(F.log10(more / sums)).alias("rare_own"))
    )
    none = F.lit(0.0)
    return scored.join(rare, "uid", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", none)).alias("base_score"),
        (F.col("own") + F.coalesce("rare_own", none)).alias("score"),
    )


def op1_lm_scores(spark, sf_dir: str) -> DataFrame:
    bucket = crc32_bucket(F.col("doc_id"), 7)
    scores = lm_scores(table(spark, sf_dir, "documents"), bucket != 2)
    return scores.select("doc_id", (bucket == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
