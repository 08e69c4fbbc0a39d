"""Language identification with one interpolated Kneser-Ney character model per language.

1. Every task counts the 4-grams of its labelled texts by language; the counts are summed by one shuffle of
   distinct grams. All lower orders follow from the distinct 4-grams (continuation counts).
2. The models are sorted arrays of hashed grams with discounted probabilities and back-off weights. They hold
   every counted gram, whatever their number: the broadcast grows with the distinct 4-grams of all languages.
3. Every text is scored whole under every model. The language of the lowest cross-entropy a character wins;
   its share of the likelihood is the score.
4. Rejection is calibrated on the labelled texts, leaving out one language at a time: for each language and length
   class, the limit lies ``TOWARDS`` of the way from the cross-entropy that all but ``alpha`` of its own texts stay below
   to the one that all but ``BETA`` of the texts of other languages exceed that come nearest to it.

Characters are UTF-16 units, letters in lower case, everything else one space; so a 4-gram is exactly one
64-bit word and looking a text up is array work without a Python loop over its characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_bucket, pick, table, written

ORDER = 4
UNIT = 16
PIECE_CHARS = 1 << 18  # longer texts are read in pieces of this many characters, each with the units before it
ALPHA = 0.0005
BETA = 0.01
TOWARDS = 0.15  # languages that aren't learned may be nearer than those that are, so most of the way is theirs
LONE_MARGIN = 0.3  # nats a character above the own limit where there is no other language to calibrate by
LEVELS = 41  # length classes: log2 of the length
UNKNOWN = "und"
_UNIFORM = 1.0 / (1 << UNIT)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LETTER = re.compile(r"[^\W\d_]")


@lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """For each UTF-16 unit its lower-case letter, or a space. Surrogates stand for folded astral letters."""
    fold = np.full(1 << UNIT, ord(" "), np.uint16)
    for unit in range(1 << UNIT):
        if 0xD800 <= unit < 0xE000:
            fold[unit] = unit
        elif (c := chr(unit)).isalpha():
            low = c.lower()
            fold[unit] = ord(low) if len(low) == 1 else unit
    return fold


def _one_unit(text: str) -> str:
    """Astral letters as one lone surrogate each, other astral characters as spaces."""
    return "".join(c if c <= "\uffff" else chr(0xD800 + ord(c) % 2048) if c.isalpha() else " " for c in text)


_SPACES = np.full(ORDER - 1, ord(" "), np.uint16)


def _units(text: str) -> np.ndarray:
    """The folded UTF-16 units of a text."""
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    if len(units) != len(text):
        units = np.frombuffer(_one_unit(text).encode("utf-16-le", "surrogatepass"), np.uint16)
    return _fold_table()[units]


@dataclass(frozen=True)
class _Piece:
    """A text, or a part of one: the three units before it, and whether it ends its text."""

    text: str
    before: np.ndarray = field(default_factory=lambda: _SPACES)
    last: bool = True

    @property
    def whole(self) -> bool:
        return self.before is _SPACES and self.last

    def after(self) -> np.ndarray:
        """The three units before the next part."""
        folded = _units(self.text)
        blank = folded == ord(" ")
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        if len(keep):
            keep[0] |= self.before[-1] != ord(" ")
        return np.concatenate([self.before, folded[keep]])[-(ORDER - 1) :]


def _windows(pieces: list[_Piece]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All 4-grams of the pieces in a row, where each piece's grams start and end."""
    texts = [p.text for p in pieces]
    joined = "".join(texts)
    units = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), np.uint16)
    if len(units) != len(joined):
        texts = [_one_unit(t) for t in texts]
        units = np.frombuffer("".join(texts).encode("utf-16-le", "surrogatepass"), np.uint16)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    before, last = np.array([p.before for p in pieces]), np.array([p.last for p in pieces], np.int64)
    folded = _fold_table()[units]
    blank = folded == ord(" ")
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    begins = np.cumsum(lengths) - lengths
    filled = begins[lengths > 0]
    # One blank stands for all that follow one another, also over the start of a part.
    keep[filled] = ~blank[filled] | (before[lengths > 0, -1] != ord(" "))
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    kept = kept_before[begins + lengths] - kept_before[begins]
    # Each piece: three units before it (spaces before a text), its letters, one space behind a text.
    sizes = kept + ORDER - 1 + last
    first = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), ord(" "), np.uint16)
    for k in range(ORDER - 1):
        out[first + k] = before[:, k]
    at = np.arange(int(kept.sum())) + np.repeat(first + ORDER - 1 - (np.cumsum(kept) - kept), kept)
    out[at] = folded[keep]
    grams = np.lib.stride_tricks.as_strided(out.view(np.uint8), (max(0, len(out) - 3), 8), (2, 1))
    return np.ascontiguousarray(grams).view("<u8").ravel(), first, first + kept + last


def _mixed(keys: np.ndarray) -> np.ndarray:
    h = keys * _MIX
    return h ^ (h >> np.uint64(32))


def _groups(texts: pa.Array) -> Iterator[tuple[list[int], list[_Piece]]]:
    """Row numbers and pieces of text, about ``PIECE_CHARS`` characters at a time."""
    rows: list[int] = []
    pieces: list[_Piece] = []
    size = 0
    for row, value in enumerate(texts):
        text = value.as_py() or ""
        if len(text) <= PIECE_CHARS:
            parts = [_Piece(text)]
        else:
            parts = _parts(text)
        for piece in parts:
            rows.append(row)
            pieces.append(piece)
            size += len(piece.text)
            if size >= PIECE_CHARS:
                yield rows, pieces
                rows, pieces, size = [], [], 0
    if rows:
        yield rows, pieces


def _parts(text: str) -> Iterator[_Piece]:
    if not _LETTER.search(text):
        yield _Piece("")
        return
    before = _SPACES
    for at in range(0, len(text), PIECE_CHARS):
        piece = _Piece(text[at : at + PIECE_CHARS], before, at + PIECE_CHARS >= len(text))
        yield piece
        before = before if piece.last else piece.after()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """4-gram counts by language of one task's texts (columns lang, text)."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    pending: dict[str, list[np.ndarray]] = {}

    def settle(lang: str) -> None:
        keys, counts = np.unique(np.concatenate(pending.pop(lang)), return_counts=True)
        if lang in totals:
            keys = np.concatenate([totals[lang][0], keys])
            counts = np.concatenate([totals[lang][1], counts])
            keys, where = np.unique(keys, return_inverse=True)
            counts = np.bincount(where, counts).astype(np.int64)
        totals[lang] = keys, counts

    waiting: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for rows, pieces in _groups(batch.column(1)):
            grams, starts, ends = _windows(pieces)
            for lang in {langs[r] for r in rows}:
                # A whole text of one gram has no letter.
                own = [grams[a:b] for r, p, a, b in zip(rows, pieces, starts, ends, strict=True) if langs[r] == lang and b > a + p.whole]
                if not own:
                    continue
                pending.setdefault(lang, []).extend(x.copy() for x in own)
                waiting[lang] = waiting.get(lang, 0) + sum(map(len, own))
                if waiting[lang] > 1 << 21:
                    settle(lang)
                    waiting[lang] = 0
    for lang in list(pending):
        settle(lang)
    for lang, (keys, counts) in totals.items():
        for at in range(0, len(keys), 1 << 16):
            part = keys[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part), pa.string()), pa.array(part.view(np.int64)), pa.array(counts[at : at + (1 << 16)], pa.int64())],
                ["lang", "gram", "n"],
            )


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all texts of the columns ``lang, text``."""
    parts = labelled.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class KneserNey:
    """One language: for each order, sorted hashes of grams and of contexts with their values."""

    grams: list[tuple[np.ndarray, np.ndarray]]  # order 1 to 4: hash, discounted probability
    weights: list[tuple[np.ndarray, np.ndarray]]  # order 1 to 4: hash of the context, weight of the lower order

    @classmethod
    def fit(cls, keys: np.ndarray, counts: np.ndarray) -> KneserNey:
        grams, weights = [], []
        keys, counts = np.unique(keys), counts[np.argsort(keys)].astype(np.float64)
        for order in range(ORDER, 0, -1):
            once, twice = float((counts == 1).sum()), float((counts == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context = keys & ((np.uint64(1) << np.uint64(UNIT * (order - 1))) - np.uint64(1))
            contexts, where = np.unique(context, return_inverse=True)
            total = np.bincount(where, counts)
            kinds = np.bincount(where)
            grams.append(_sorted_hashes(keys, np.maximum(counts - discount, 0) / total[where]))
            lost = np.bincount(where, np.minimum(counts, discount))
            weights.append(_sorted_hashes(contexts, np.where(kinds > 0, lost / total, 1.0)))
            # A lower-order gram counts once for each unit seen before it.
            keys, counts = np.unique(keys >> np.uint64(UNIT), return_counts=True)
            counts = counts.astype(np.float64)
        return cls(grams[::-1], weights[::-1])

    def log_prob(self, keys: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each 4-gram's last unit after its first three."""
        p = np.full(len(keys), _UNIFORM)
        for order in range(1, ORDER + 1):
            gram = keys >> np.uint64(UNIT * (ORDER - order))
            context = gram & ((np.uint64(1) << np.uint64(UNIT * (order - 1))) - np.uint64(1))
            p = _find(*self.grams[order - 1], gram, 0.0) + _find(*self.weights[order - 1], context, 1.0) * p
        return np.log(p)


def _sorted_hashes(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = _mixed(keys)
    order = np.argsort(hashes)
    return hashes[order], values[order]


def _find(hashes: np.ndarray, values: np.ndarray, keys: np.ndarray, otherwise: float) -> np.ndarray:
    wanted = _mixed(keys)
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return np.where(hashes[at] == wanted, values[at], otherwise)


class _Scorer:
    """Scores batches under all models; remembers the values of grams met before."""

    def __init__(self, models: list[KneserNey]):
        self.models = models
        self.bits = max(12, 20 - max(0, (len(models) - 1).bit_length() - 2))
        self.keys = np.zeros(1 << self.bits, np.uint64)  # key 0 is no gram of a text
        self.values = np.zeros((1 << self.bits, len(models)), np.float32)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        slot = ((grams * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != grams)
        out = self.values[slot]
        if len(miss):
            new, where = np.unique(grams[miss], return_inverse=True)
            values = np.stack([m.log_prob(new) for m in self.models], axis=1).astype(np.float32)
            out[miss] = values[where]
            place = ((new * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)
            place, last = np.unique(place, return_index=True)
            self.keys[place], self.values[place] = new[last], values[last]
        return out


def _predict(langs: list[str], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value) if langs else None
        for batch in batches:
            rows_in = batch.num_rows
            total = np.zeros((rows_in, len(langs)))
            units = np.zeros(rows_in, np.int64)
            for rows, pieces in _groups(batch.column(1)) if langs else ():
                grams, starts, ends = _windows(pieces)
                values = scorer(grams)
                bounds = np.minimum(np.stack([starts, ends], 1).ravel(), max(0, len(values) - 1))
                sums = np.add.reduceat(values, bounds, axis=0, dtype=np.float64)[::2]
                # The last text's end is one past the last gram.
                if ends[-1] > len(values) - 1:
                    sums[-1] = values[starts[-1] :].sum(axis=0, dtype=np.float64)
                sums[ends == starts] = 0.0
                np.add.at(total, rows, sums)
                np.add.at(units, rows, ends - starts)
            known = (units > 1) if langs else np.zeros(rows_in, bool)
            n = np.maximum(units, 1)
            if langs:
                best = total.argmax(axis=1)
                top = total[np.arange(rows_in), best]
                share = 1.0 / np.exp(total - top[:, None]).sum(axis=1)
                names = np.array(langs, object)[best]
                # What a labelled text would be taken for if its language weren't learned.
                place = {lang: i for i, lang in enumerate(langs)}
                label = np.array([place.get(x, -1) for x in batch.column(2).to_pylist()], np.int64)
                labelled = np.flatnonzero(label >= 0) if len(langs) > 1 else np.empty(0, np.int64)
                total[labelled, label[labelled]] = -np.inf
                other = total.argmax(axis=1)
                other_names, other_entropy = [None] * rows_in, np.full(rows_in, np.nan)
                for i in labelled[known[labelled]].tolist():
                    other_names[i] = langs[other[i]]
                other_entropy[labelled] = -total[labelled, other[labelled]] / n[labelled]
            else:
                top, share, names = np.zeros(rows_in), np.zeros(rows_in), np.full(rows_in, UNKNOWN, object)
                other_names, other_entropy = [None] * rows_in, np.full(rows_in, np.nan)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x if k else UNKNOWN for x, k in zip(names, known, strict=True)], pa.string()),
                    pa.array(np.where(known, share, 0.0)),
                    pa.array(np.where(known, -top / n, 0.0)),
                    pa.array(np.where(known, units, 0)),
                    pa.array(other_names, pa.string()),
                    pa.array(other_entropy),
                    *batch.columns[2:],
                ],
                ["doc_id", "lang_pred", "score", "cross_entropy", "units", "other", "other_entropy", *batch.schema.names[2:]],
            )

    return run


def fit_models(labelled: DataFrame) -> dict[str, KneserNey]:
    """A model for each ``lang`` of the rows with text and label, in ascending order of the name."""
    counts = written(gram_counts(labelled.where("lang is not null and text is not null")), "lang-grams")
    grams = counts.toArrow().combine_chunks()
    langs = grams.column("lang").to_numpy(zero_copy_only=False) if grams.num_rows else np.empty(0, object)
    keys = grams.column("gram").to_numpy().view(np.uint64)
    n = grams.column("n").to_numpy()
    return {lang: KneserNey.fit(keys[langs == lang], n[langs == lang]) for lang in sorted(set(langs))}


def _quantiles(scored: DataFrame, lang: str, entropy: str, share: float) -> dict[str, dict[int, float]]:
    """By language and length class; as many rows as there are of both."""
    level = F.least(F.floor(F.log2("units")).cast("int"), F.lit(LEVELS - 1)).alias("level")
    found: dict[str, dict[int, float]] = {}
    for r in scored.groupBy(F.col(lang).alias("lang"), level).agg(F.percentile_approx(entropy, share, 10000).alias("limit")).collect():
        found.setdefault(r.lang, {})[r.level] = r.limit
    return found


def thresholds(scored: DataFrame, alpha: float = ALPHA, beta: float = BETA) -> dict[str, list[float]]:
    """For each language the limit of the cross-entropy by length class.

    ``scored`` holds labelled rows: ``lang, lang_pred, cross_entropy, units, other, other_entropy``. The limit is
    ``TOWARDS`` of the way from the quantile of the language's own texts to the low one of texts of other languages that
    come nearest to it when their own is left out; where the two overlap it is the first. Longer texts vary less, so the
    first is never below that of a longer class and the second never below that of a shorter one; classes without texts
    take those. A language that no other text comes nearest to has a margin of ``LONE_MARGIN``.
    """
    some = scored.where("units > 0")
    own = _quantiles(some.where("lang = lang_pred"), "lang", "cross_entropy", 1 - alpha)
    others = _quantiles(some.where("other is not null"), "other", "other_entropy", beta)
    out = {}
    for lang, limits in own.items():
        running, row = 0.0, [0.0] * LEVELS
        for k in range(LEVELS - 1, -1, -1):
            running = row[k] = max(running, limits.get(k, 0.0))
        longest = max(limits)
        row = [limits[longest] if k > longest else x for k, x in enumerate(row)]
        if lang in others:
            near = 0.0
            for k in range(LEVELS):
                near = max(near, others[lang].get(k, 0.0))
                row[k] += max(0.0, near - row[k]) * TOWARDS
        else:
            row = [x + LONE_MARGIN for x in row]
        out[lang] = row
    return out


def identify(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    alpha: float = ALPHA,
    beta: float = BETA,
) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, cross_entropy, units, rejected, learned, text_key``.

    ``learn`` is a condition on ``doc_id``: only texts and labels of rows where it holds are learned from.

    * A null text, and one without a letter, is ``und`` with score 0 and is rejected.
    * Rows without a label aren't learned from but are predicted. If nothing was learned, all are ``und``.
    * Ties go to the first language by name. Repeated rows are counted and returned one by one.
    * Texts of any length are scored whole. An empty table gives no rows. Further columns are ignored.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    models = fit_models(rows.where(learn))
    langs = sorted(models)
    shared = docs.sparkSession.sparkContext.broadcast([models[x] for x in langs])
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")
    marked = rows.select("doc_id", "text", "lang", F.coalesce(learn, F.lit(False)).alias("learned"), key)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, cross_entropy double, units long, other string, other_entropy double, lang string, learned boolean, text_key long"
    scored = written(marked.mapInArrow(_predict(langs, shared), schema), "lang-scores")
    shared.unpersist()
    limits = thresholds(scored.where("learned"), alpha, beta)
    too_far = F.lit(False)
    if limits:
        level = F.least(F.floor(F.log2(F.greatest("units", F.lit(1)))).cast("int"), F.lit(LEVELS - 1))
        rows_of = F.create_map(*(x for k, v in sorted(limits.items()) for x in (F.lit(k), F.array(*map(F.lit, v)))))
        limit = F.element_at(F.try_element_at(rows_of, F.col("lang_pred")), level + 1)
        too_far = F.coalesce(F.col("cross_entropy") > limit, F.lit(False))
    rejected = ((F.col("lang_pred") == UNKNOWN) | too_far).alias("rejected")
    return scored.select("doc_id", "lang_pred", "score", "cross_entropy", "units", rejected, "learned", "text_key")


def keep_identified(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rejected ones; a null language becomes the one found. All columns stay.

    Repeated rows share their fate. Only rejected rows, and rows without a language, are joined.
    """
    found = written(identify(docs, learn, id_col, text_col, lang_col), "lang-found")
    names = docs.columns
    plain = docs.toDF(*(f"_{i}" for i in range(len(names))))
    ids, texts, lang = (f"_{names.index(c)}" for c in (id_col, text_col, lang_col))
    plain = plain.withColumn("_own", F.xxhash64(F.coalesce(texts, F.lit(""))))
    result = found.groupBy("doc_id", "text_key").agg(F.first("lang_pred").alias("_found"), F.first("rejected").alias("rejected"))
    same = (F.col("_own") == F.col("text_key")) & F.col(ids).eqNullSafe(F.col("doc_id"))
    named = plain.where(F.col(lang).isNotNull()).join(result.where("rejected"), same, "left_anti").drop("_own")
    open_ = plain.where(F.col(lang).isNull()).join(result.where("not rejected"), same)
    own = [F.col(f"_{i}") if f"_{i}" != lang else F.col("_found").alias(lang) for i in range(len(names))]
    return named.unionByName(open_.select(*own)).toDF(*names)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bucket = crc32_bucket(F.col("doc_id"), 4)
    found = identify(docs, bucket != 2)
    return found.select("doc_id", (bucket == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
