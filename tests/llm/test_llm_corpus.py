"""Tokenizer alignment, license scan and source divergence against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kbetl.llm import alignment, divergence, license_scan, pair_runs
from kbetl.llm.queries import ORACLES, REGISTRY

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    r = random.Random(5)
    signs = ["the", "of", "Wörter", "語", "\U0001f600", "é́", "don't", "  ", "   ", "\n", "\r\n", "\t", "▁", " ", "<s>", "<0x41>", "<|endoftext|>", "x,", ".y", "123", "́a", "\x00", "\x1c", "​", "﻿"]
    made = [" ".join(r.choices(signs, k=r.randint(1, 30))) for _ in range(150)]
    made += ["".join(r.choices(signs, k=r.randint(1, 20))) for _ in range(60)]
    return [None, "", " ", "  a", "a  ", "the the the", "the the the", "w" * 5000, "many plain words here " * 400, *made]


def aligned_by_force(texts):
    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet, vocabulary = alignment.byte_level_alphabet(), {i: t for t, i in a_tok.get_vocab().items()}
    docs, holders = [], collections.Counter()
    for text in texts:
        a = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_tok.encode(text or "")
        a_parts = [bytes(alphabet[c] for c in vocabulary[i]) if i != 50256 else b"?" for i in a]
        pieces = [b_tok.id_to_piece(i) for i in b]
        b_parts = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = b" " + (text or "").encode()
        if not text or b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            docs.append(None)
            continue
        spans = [list(itertools.pairwise([0, *itertools.accumulate(map(len, parts))])) for parts in (a_parts, b_parts)]
        links = [(x, y) for x, (s, e) in zip(a, spans[0]) for y, (u, v) in zip(b, spans[1]) if s < v and u < e] if len(a) < 3000 else []
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, last = [], 0
        for end in shared:
            sides = [",".join(str(i) for i, (s, e) in zip(ids, own) if last <= s and e <= end) for ids, own in zip((a, b), spans)]
            groups.append("|".join(sides))
            last = end
        docs.append((len(a), len(b), groups, links))
        holders.update(set(links))
    highest = collections.defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    for d in docs:
        if d is None:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            counts = [(holders[k], highest[k[0]]) for k in d[3]]
            yield d[0], d[1], len(d[2]), len(d[3]), sum(n == h for n, h in counts), sum(n for n, _ in counts), hashlib.sha256(";".join(d[2]).encode()).hexdigest()


@pytest.mark.parametrize("options", [{}, {"radixes": 3, "spill_records": 40, "fan_in": 4}])
def test_alignment_is_brute_force(spark, options):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, Run string, pairs string").repartition(3)
    want = {i: row for i, row in enumerate(aligned_by_force(texts))}
    got = alignment.align_tokenizers(docs, A, B, **options).select(*NAMES).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert sum(r.n_a > 0 for r in got) > 100 and sum(r.n_a == 0 for r in got) > 20


def test_alignment_of_parts_empty_tables_and_null_ids(spark, monkeypatch):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")
    got = alignment.align_tokenizers(docs, A, B).collect()
    assert sorted((str(r.doc_id), r.n_links, r.count_sum) for r in got) == [("3", 0, 0), ("None", 2, 4), ("None", 2, 4)]
    assert alignment.align_tokenizers(docs.limit(0), A, B).count() == 0
    tokenizers = alignment.Tokenizers(A, B)
    text = "some words, and more\n  of them (so many) " * 50
    whole = alignment.align_text(text, tokenizers)
    in_slices = list(alignment.slices(text, 64))
    assert len(in_slices) > 10
    monkeypatch.setattr(alignment, "slices", lambda t: in_slices)
    cut = alignment.align_text(text, tokenizers)
    assert (cut.n_a, cut.n_b, cut.groups, cut.pairs.tolist(), cut.times.tolist()) == (whole.n_a, whole.n_b, whole.groups, whole.pairs.tolist(), whole.times.tolist())
    for bad in ({"fan_in": 1}, {"radixes": 0}):
        with pytest.raises(ValueError):
            alignment.align_tokenizers(docs, A, B, **bad)


def test_ranks_give_the_ids_of_the_file(spark):
    own, theirs = alignment.Tokenizers(A, B).a, Tokenizer.from_file(A)
    theirs.encode_special_tokens = True
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 64):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)}5{chr(c)}! {chr(c)}" for c in points[at : at + 64])
        assert own.encode_ordinary(text) == theirs.encode(text, add_special_tokens=False).ids


def test_runs_merge_like_a_counter():
    r = np.random.default_rng(1)
    runs = []
    for n in (0, 1, 50, 400, 401):
        pairs = np.unique(r.integers(0, 900, n))
        runs.append((pairs, r.integers(1, 9, len(pairs))))
    want = collections.Counter()
    for pairs, counts in runs:
        want.update(dict(zip(pairs.tolist(), counts.tolist())))
    merged = list(pair_runs.merge(runs, block=16))
    flat = [(p, c) for pairs, counts in merged for p, c in zip(pairs.tolist(), counts.tolist())]
    assert flat == sorted(want.items()) and len(merged) > 10
    highest = collections.defaultdict(int)
    for p, c in flat:
        highest[p // 30] = max(highest[p // 30], c)
    marked = list(pair_runs.with_highest(iter(merged), 30))
    assert [(p, c, bool(m)) for x in marked for p, c, m in zip(*(a.tolist() for a in x))] == [(p, c, c == highest[p // 30]) for p, c in flat]
    back = pair_runs.streamed_back([p for p, _ in runs], marked)
    for (pairs, _), (counts, marks) in zip(runs, back):
        assert counts.tolist() == [want[p] for p in pairs.tolist()] and marks.tolist() == [want[p] == highest[p // 30] for p in pairs.tolist()]
    assert pair_runs.unpack_pairs(pair_runs.pack_pairs(*runs[3]))[0].tolist() == runs[3][0].tolist()


# ---------------------------------------------------------------- licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def licenses_by_force(text, templates, threshold):
    own = words(text)
    found = []
    for label, template in templates:
        ws = words(template)
        size = max(8, 1 << (len(ws) - 1).bit_length())
        for first in range(0, len(own), size):
            share = len(set(ws) & set(own[first : first + 2 * size])) / len(set(ws))
            if share >= threshold - 1e-12:
                found.append((label, first, first + 2 * size, share))
    return [m for m in found if not any(o[1] < m[2] and m[1] < o[2] and o[3] > m[3] for o in found)]


def license_texts():
    r = random.Random(3)
    mit, gpl = license_scan.TEMPLATES[0][1], dict(license_scan.TEMPLATES)["gpl-3"]
    filler = "some words of no license at all that is in the way of free software".split()
    texts = [None, "", "...", "Under the MIT License", "under the mit license under the mit license, apache license version 2 or CC BY-NC 4.0", mit, gpl, gpl.replace("3", "2")]
    for _ in range(60):
        notice = words(r.choice(license_scan.TEMPLATES)[1])
        for _ in range(r.randint(0, 4)):
            notice[r.randrange(len(notice))] = r.choice(filler)
        texts.append(" ".join(r.choices(filler, k=r.randint(0, 60)) + notice + r.choices(filler, k=r.randint(0, 60))))
    return [*texts, " ".join(texts[8:])]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_license_blocks_are_all_found(spark, threshold):
    texts = license_texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[5], "x")], "doc_id long, text string, Matches string")
    got = license_scan.scan_licenses(docs, threshold=threshold).collect()
    assert len(got) == len(texts) + 1
    n_found = 0
    for row in got:
        text = texts[5] if row.doc_id is None else texts[row.doc_id]
        want = licenses_by_force(text, license_scan.TEMPLATES, threshold)
        n_found += len(want)
        assert row.n_words == len(words(text))
        assert sorted((m.label, m.first_word, round(m.share, 9)) for m in row.matches) == sorted((m[0], m[1], round(m[3], 9)) for m in want)
        flat = " " + " ".join(words(text)) + " "
        assert len(row.places) == sum(len(re.findall(f"(?= {p} )", flat)) for p, _ in license_scan.PHRASES)
    assert n_found > 30
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan_licenses(docs, threshold=0)
    with pytest.raises(ValueError):
        license_scan.scan_licenses(docs, templates=[("none", "...")])


def test_word_slices_lose_nothing():
    text = ("Straße 12, don't! " * 500).encode()
    whole = license_scan._words(text.decode())
    for size in (1, 7, 100):
        assert [w for part in license_scan.words_of(text, license_scan.ALPHANUMERIC, size) for w in part] == whole
    assert [w.decode() for w in whole] == words(text.decode())


# ---------------------------------------------------------------- divergence


def divergence_by_force(rows, least, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    held, counts = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        found = term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        held[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = []
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= least]
        own = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in own.items()}
        q = shares(sum(own.values(), collections.Counter()))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in own:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, k) for k, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 400, "shard_terms": 5}, {"broadcast_bytes": 0, "block_slots": 16}])
def test_divergence_is_brute_force(spark, options):
    r = random.Random(7)
    vocabulary = [*"abcdefghij", "Straße", "ÉTÉ", "été", "語", "don't", "x1y", "\U0001f600"]
    rows = []
    for i in range(200):
        lang, source = r.choice(["en", "en", "de", None]), r.choice(["s1", "s2", "s3", None, "é"])
        bias = vocabulary[(len(source or "") + i) % 4 :]
        rows.append((lang, source, " ".join(r.choices(bias, k=r.randint(0, 12))) if r.random() > 0.1 else None))
    rows += [("xx", "only", "one two"), ("yy", "a", None), ("yy", "b", "..")]
    docs = spark.createDataFrame([(*row, "z") for row in rows], "lang string, source string, text string, Term string").repartition(3)
    got = divergence.source_divergence(docs, min_documents=4, top=3, **options).collect()
    assert sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in got) == divergence_by_force(rows, 4, 3)
    assert divergence.source_divergence(docs.limit(0)).count() == 0


def test_default_options(spark):
    rows = [(lang, f"s{i % 3}", f"term{chr(97 + i % 20)} shared words {'x' * (i % 9)}") for i in range(120) for lang in ("a", "b")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    want = divergence_by_force(rows, 10, 10)
    got = divergence.source_divergence(docs).collect()
    assert sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in got) == want


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 5000])
def test_perfect_hash_is_a_permutation(n):
    h = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
    pilots, slots = divergence.perfect_hash(h)
    assert sorted(slots.tolist()) == list(range(len(h)))
    terms = [f"t{i}".encode() for i in range(n)]
    hashes = np.array([divergence.xxhash.xxh64_intdigest(t, 42) for t in terms], np.uint64)
    pilots, slots = divergence.perfect_hash(hashes)
    keys = [terms[i] for i in np.argsort(slots)]
    one = divergence.PerfectHashes(1, [(0, pilots.tobytes(), np.array([len(k) for k in keys], "<i4").tobytes(), b"".join(keys))] if n else [])
    assert one.find(terms).tolist() == slots.tolist() and one.find([b"none", b"", b"t99999"]).tolist() == [-1] * 3


@pytest.mark.parametrize("name", ["op12_license_scan", "op13_divergence"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(map(str, cursor.fetchall()))
    got = REGISTRY[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == want and math.isfinite(len(want)) and want
