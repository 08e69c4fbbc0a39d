"""License scan: an exact set-similarity join of text blocks with license templates.

A template of up to 2^k words is looked for in blocks of 2^(k+1) words that start at every multiple of 2^k words, so
every run as long as the template lies whole in one block. A block holds a template if it has at least ``threshold`` of
the template's distinct words. All such pairs are found, by the filters of a prefix join:

* **Global order.** The template words are ordered by the number of documents that hold them, rarest first, counted
  over the whole corpus (words of no template can't be shared and need no place in the order).
* **Prefix.** With n words of which o must be shared, a block without any of the template's first n - o + 1 words holds
  too few. Only blocks with such a word are looked at.
* **Length.** A block with fewer than o distinct template words is passed over.
* **Position.** With the first shared word at place i of the template and j of the block, at most 1 + min(n - i - 1,
  block - j - 1) words are shared; below o the pair is dropped. What is left is counted exactly.

Where blocks with different shares overlap, the highest share gives the label, so that the notice of one version isn't
taken for that of another. Fixed phrases are found besides, as consecutive words. Only the templates and their words,
whose number is fixed, go to the tasks; no text leaves its task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_words import byte_table, words_of
from .common import pick, table

THRESHOLD = 0.8
MIN_BLOCK = 8  # words; also what block starts are multiples of
MAX_TEMPLATE_WORDS = 100_000  # of all templates: what is sent to the tasks
ALPHANUMERIC = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz")

# Phrase words and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Public license notices.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, "
     "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
     "the Free Software Foundation"),
    ("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all rights"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def _words(text: str) -> list[bytes]:
    return [w for part in words_of(text.encode(), ALPHANUMERIC) for w in part]


@dataclass(frozen=True)
class _Template:
    label: str
    tokens: np.ndarray  # ids of the distinct words, rarest first
    needed: int
    block: int  # words from one block's start to the next


def _needed(n: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n - 1e-9))


def _block(n_words: int) -> int:
    return max(MIN_BLOCK, 1 << (n_words - 1).bit_length())


class Scanner:
    """Templates under a global word order; words get their place in it as id."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]], threshold: float, counts: dict[bytes, int]):
        texts = [(label, _words(text)) for label, text in templates]
        vocabulary = {w for _, ws in texts for w in ws}
        ordered = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
        self.ids = {w: i for i, w in enumerate(ordered)}
        self.n_shared = len(ordered)  # ids from here on are of phrases alone
        for text, _ in phrases:
            for w in _words(text):
                self.ids.setdefault(w, len(self.ids))
        self.phrases = [(label, np.array([self.ids[w] for w in _words(text)])) for text, label in phrases]
        self.templates = [
            _Template(label, t := np.array(sorted({self.ids[w] for w in ws})), _needed(len(t), threshold), _block(len(ws))) for label, ws in texts
        ]
        self.index: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, t in enumerate(self.templates):
            by_token = self.index.setdefault(t.block, {})
            for i, token in enumerate(t.tokens[: len(t.tokens) - t.needed + 1].tolist()):
                by_token.setdefault(token, []).append((k, i))
        self.prefixes = {}
        for block, by_token in self.index.items():
            self.prefixes[block] = mask = np.zeros(len(self.ids) + 1, bool)
            mask[list(by_token)] = True

    def encode(self, text: bytes | None) -> np.ndarray:
        """Ids of all words of a text, -1 for words of no template and no phrase."""
        parts = [np.fromiter(map(self.ids.get, words, repeat(-1)), np.int32, len(words)) for words in words_of(text, ALPHANUMERIC)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def phrase_places(self, ids: np.ndarray) -> list[tuple[str, np.ndarray]]:
        found = []
        for label, phrase in self.phrases:
            at = np.flatnonzero(ids[: max(0, len(ids) - len(phrase) + 1)] == phrase[0])
            for k in range(1, len(phrase)):
                at = at[ids[at + k] == phrase[k]]
            if len(at):
                found.append((label, at))
        return found

    def blocks(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """All pairs of a block and a template that it holds: template, first word, end, shared words."""
        found = []
        for block, mask in self.prefixes.items():
            starts = np.flatnonzero(mask[ids]) // block
            for at in np.union1d(starts, starts[starts > 0] - 1).tolist():
                first, end = at * block, min((at + 2) * block, len(ids))
                held = np.unique(ids[first:end])
                held = held[(held >= 0) & (held < self.n_shared)]
                tried: set[int] = set()
                for j, token in enumerate(held.tolist()):
                    for k, i in self.index[block].get(token, ()):
                        if k in tried:
                            continue
                        tried.add(k)
                        t = self.templates[k]
                        if len(held) < t.needed or 1 + min(len(t.tokens) - i - 1, len(held) - j - 1) < t.needed:
                            continue
                        shared = int(np.isin(t.tokens, held, assume_unique=True).sum())
                        if shared >= t.needed:
                            found.append((k, first, end, shared))
        return found

    def best(self, found: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Label, first word, end and share of the matches that no overlapping one exceeds."""
        if not found:
            return []
        share = [shared / len(self.templates[k].tokens) for k, _, _, shared in found]
        spans = [(first // MIN_BLOCK, first // MIN_BLOCK + 2 * self.templates[k].block // MIN_BLOCK) for k, first, _, _ in found]
        highest: dict[int, float] = {}
        for s, (a, b) in zip(share, spans, strict=True):
            for g in range(a, b):
                highest[g] = max(s, highest.get(g, 0.0))
        return [
            (self.templates[k].label, first, end, s)
            for (k, first, end, _), s, (a, b) in zip(found, share, spans, strict=True)
            if max(highest[g] for g in range(a, b)) <= s
        ]


def document_counts(texts: DataFrame, words: frozenset[bytes]) -> dict[bytes, int]:
    """In how many texts each of the given words stands; at most one row a word comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                seen: set[bytes] = set()
                for part in words_of(text.as_py(), ALPHANUMERIC):
                    seen.update(words.intersection(part))
                counts.update(seen)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counted = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counted.collect()}


_MATCH = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("share", pa.float64())])


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, places, matches``.

    ``places`` are the phrases' places (label, first_word, n_words, share 1), all of them, in the text's order per
    phrase. ``matches`` are the blocks that hold a template, with their share of its words, but for those that overlap
    a block of a higher share.

    * A null text is the empty one: no words, no places. Texts of any length are read whole, in slices.
    * Repeated rows and null ids come back row by row; equal shares of overlapping blocks all stay. An empty table
      gives no rows. Further columns are ignored.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    vocabulary = frozenset(w for _, text in templates for w in _words(text))
    if sum(len(_words(text)) for _, text in templates) > MAX_TEMPLATE_WORDS or not all(_words(t) for t in [*(t for _, t in templates), *(p for p, _ in phrases)]):
        raise ValueError(f"templates and phrases need words, the templates together at most {MAX_TEMPLATE_WORDS}")
    rows = pick(docs, doc_id=id_col, text=text_col)
    scanner = Scanner(templates, phrases, threshold, document_counts(rows.select("text"), vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, places, matches = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                ids = scanner.encode(text.as_py())
                n_words.append(len(ids))
                lengths = {label: len(phrase) for label, phrase in scanner.phrases}
                places.append([(label, p, lengths[label], 1.0) for label, at in scanner.phrase_places(ids) for p in at.tolist()])
                matches.append([(label, first, end - first, s) for label, first, end, s in scanner.best(scanner.blocks(ids))])
            lists = [pa.array([[dict(zip(_MATCH.names, m, strict=True)) for m in row] for row in column], pa.list_(_MATCH)) for column in (places, matches)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), *lists], ["doc_id", "n_words", "places", "matches"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    match = "array<struct<label: string, first_word: bigint, n_words: bigint, share: double>>"
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, places {match}, matches {match}")


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))

    def labels(*columns: str):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*(F.col(f"{c}.label") for c in columns)))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.first_word").alias("first_word"),
        F.array_max("places.first_word").alias("last_word"),
        labels("places").alias("base_labels"),
        labels("places", "matches").alias("labels"),
        F.coalesce(F.greatest(F.array_max("places.share"), F.array_max("matches.share")), F.lit(0.0)).alias("score"),
    )


def _values() -> str:
    rows = []
    for k, (label, text) in enumerate(TEMPLATES):
        words = [w.decode() for w in _words(text)]
        n = len(set(words))
        rows += [f"({k}, '{label}', '{w}', {n}, {_needed(n, THRESHOLD)}, {_block(len(words))})" for w in sorted(set(words))]
    return ", ".join(rows)


def _places() -> str:
    parts = []
    for text, label in PHRASES:
        tests = " and ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(text.split(), 1))
        parts.append(f"list_transform(list_filter(range(len(w)), lambda i: {tests}), lambda i: {{'label': '{label}', 'place': i}})")
    return " || ".join(parts)


OP12_SQL = rf"""
with template(t, label, word, n, needed, block) as (values {_values()}),
docs as (
  select row_number() over () as rn, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
based as (select rn, doc_id, len(w) as n_words, {_places()} as places from docs),
words as (select rn, unnest(w) as word, unnest(range(len(w))) as place from docs),
spots as (
  select rn, t, label, word, n, needed, block, unnest([place // block, place // block - 1]) as b
  from words join template using (word)),
held as (
  select rn, t, label, b * block as first, (b + 2) * block as past, count(distinct word) / n as share
  from spots where b >= 0 group by rn, t, label, n, needed, block, b having count(distinct word) >= needed),
best as (
  select * from held h where not exists (
    select 1 from held o where o.rn = h.rn and o.first < h.past and h.first < o.past and o.share > h.share)),
found as (select rn, list(distinct label) as labels, max(share) as share from best group by rn)
select doc_id, n_words, len(places) as n_base,
       list_min(list_transform(places, lambda p: p.place)) as first_word, list_max(list_transform(places, lambda p: p.place)) as last_word,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label))), ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label) || coalesce(labels, []))), ',') as labels,
       greatest(case when len(places) > 0 then 1.0 else 0.0 end, coalesce(share, 0.0))::double as score
from based left join found using (rn)
"""
