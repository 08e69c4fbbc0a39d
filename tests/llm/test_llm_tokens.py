"""Byte-level encoding, packing, archives, the recurrent model and the pipeline: against brute force and round trips."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

import corpus_pipeline
from kbetl.llm import byte_bpe, gated_lm, packing, warc
from kbetl.llm.common import crc32_bucket
from kbetl.llm.lm_scoring import lm_scores

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "Hello  world's 12345 \n\n x", "語のテキスト \U0001f600\U0001f600 é́", "ab" * 700, "word and  more " * 900, "   " * 500 + "x", "\r\n" * 300, "don't" * 200]


@pytest.mark.parametrize("chunk,overlap", [(64, 32), (1 << 16, 1 << 10)])
def test_byte_bpe_is_the_library_s(spark, chunk, overlap):
    want = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(RANKS), special_tokens={})
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, TEXTS[6], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    got = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, chunk_chars=chunk, overlap_chars=overlap, decode=True).collect()
    assert len(got) == len(rows)
    for r in got:
        text = (TEXTS[6] if r.doc_id is None else TEXTS[r.doc_id]) or ""
        ids = want.encode_ordinary(text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids) and bytes(r.decoded).decode() == text
    assert byte_bpe.encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, overlap_chars=2)


def test_packing(spark):
    r = random.Random(2)
    texts = [*TEXTS, "the quick brown fox " * 3000] + [" ".join(r.choices("alpha beta gamma delta Épée 42 x-y".split(), k=r.randint(0, 900))) for _ in range(120)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Length string")
    got = packing.pack_documents(docs, packing.word_tokenizer_path()).collect()
    tokenizer = Tokenizer.from_file(packing.word_tokenizer_path())
    want = collections.Counter()
    for i, t, _ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4").tobytes()
            want[i, k, at, len(part) // 4, zlib.crc32(part)] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= math.ceil(sum(r.length for r in got) / 2048) * 1.03 + 1
    assert packing.pack_documents(docs.limit(0), packing.word_tokenizer_path()).count() == 0


def test_plan_places_everything():
    r = random.Random(5)
    for histogram in ({}, {2048: 3}, {1: 5000}, {1024: 7, 1025: 3}, {r.randint(1, 2048): r.randint(1, 400) for _ in range(300)}):
        placed = collections.Counter()
        for pattern, times in packing.plan_sequences(histogram):
            assert sum(pattern) <= 2048
            for length in pattern:
                placed[length] += times
        assert placed == histogram


def test_archive_round_trip(spark):
    long = "é" * 80
    pages = [
        (5, "http://a.Example.com/x y?q=1#f", long), (3, "https://b.example.org", long), (9, "http://a.example.com/", long + "\r\n\r\nWARC/1.0\r\n"), (10, None, None),
        (11, "http://a.example.com/", ""), (12, "http://a.example.com/", "short"), (13, "http://c.example.com/z", "short"), (None, "http://n.example.com/", long),
        (3, "https://b.example.org", long), (14, "http://big.example.com/", "x" * 300_000),
    ]
    docs = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, Page string")
    archive, index = warc.archive_pages(docs, segment_bytes=2000)
    places = warc.locate(index, docs.select(warc.surt(F.col("url"))))
    assert places.count() == len(pages)
    back = warc.read_records(spark, archive, places).collect()
    seen = collections.Counter((r.page, r.payload_bytes, r.payload_digest, r.record_type) for r in back)
    want = collections.Counter()
    for i, _, html in pages:
        data = (html or "").encode()
        kind = "revisit" if html == long and i == 5 else "response"
        want["" if i is None else str(i), len(data), hashlib.sha256(data).hexdigest(), kind] += 1
    assert seen == want
    assert {(r.page, r.refers_to) for r in back if r.refers_to} == {("5", "3")}
    texts = {str(i): (h or "") for i, _, h in pages if i is not None}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in back)
    assert all(bytes(r.payload).decode() == texts[r.page] for r in back if r.payload is not None and r.page)
    described = warc.describe_records(spark, archive, places).collect()
    assert collections.Counter((r.page, r.payload_bytes, r.payload_digest, r.record_type) for r in described) == seen
    one = warc.locate(index, spark.createDataFrame([("http://c.example.com/z",), ("http://nowhere.example/",)], "url string").select(warc.surt(F.col("url"))))
    assert [r.page for r in warc.read_records(spark, archive, one).collect()] == ["13"]
    archive, index = warc.archive_pages(docs.limit(0))
    assert warc.describe_records(spark, archive, warc.locate(index, docs.select(warc.surt(F.col("url"))))).count() == 0


def test_model_s_scores_are_probabilities_and_do_not_depend_on_lanes():
    r = np.random.default_rng(0)
    model = gated_lm.GatedLM.start(r.integers(1, 50, 9), np.array([0, 3, 4, 9]))
    texts = [r.integers(0, 9, n).astype(np.int32) for n in (1, 5, 40, 0, 5000, 17, 3)]
    assert model.train(texts) == 5066
    assert np.allclose(model.score(texts), [model.score([t])[0] for t in texts], rtol=1e-5)
    pairs = [np.array([a, b], np.int32) for a in range(9) for b in range(9)]
    assert abs(np.exp(model.score(pairs)).sum() - 1) < 1e-4
    before = model.score([np.tile(np.array([1, 7, 3], np.int32), 200)])[0]
    for _ in range(20):
        model.train([np.tile(np.array([1, 7, 3], np.int32), 200)] * 8)
    assert model.score([np.tile(np.array([1, 7, 3], np.int32), 200)])[0] > before / 3


def test_lm_scores(spark):
    r = random.Random(6)
    texts = [" ".join(r.choices("one Two three four five".split(), k=r.randint(0, 40))) for _ in range(200)] + [None, "", "unseen Words\xa0here", "one " * 50_000]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, "one", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, SCORE string")
    learn = F.coalesce(crc32_bucket(F.col("doc_id"), 7) != 2, F.lit(True)) & F.coalesce(F.col("doc_id") < 200, F.lit(False))
    got = lm_scores(docs, learn).collect()
    assert len(got) == len(rows)
    tokens = lambda t: [*"".join(c.lower() if c.isascii() else c for c in t or "").split(" "), ""]
    words = lambda t: [w for w in tokens(t) if w] + [""]
    learned = [t for i, t, _ in rows if i is not None and i < 200 and zlib.crc32(str(i).encode()) % 7 != 2]
    counts = collections.Counter(w for t in learned for w in words(t))
    total = sum(counts.values())
    for x in got:
        own = words("one" if x.doc_id is None else texts[x.doc_id])
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert math.isclose(x.base_score, sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own), rel_tol=1e-9)
        assert x.score < 0 and math.isfinite(x.score)
    assert lm_scores(docs.limit(0), learn).count() == 0
    assert {x.base_score for x in lm_scores(docs, F.lit(False)).collect()} == {0.0}


def test_pipeline(spark, tmp_path):
    """Each stage's decisions against plain ones; the columns of documents until the last."""
    r = random.Random(8)
    english = "the of and to in that was his with for had you not be her on at by which have".split()
    german = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split()
    texts = [" ".join(r.choices(w, k=60)) for w in (english, german) for _ in range(40)]
    rows = [(i, t, "en" if i < 40 else "de") for i, t in enumerate(texts)]
    rows += [(100, texts[3], "en"), (101, texts[4] + " Write a.b@c.example.com", "en"), (102, None, "en"), (103, "12 34", "de"), (104, "", None)]
    docs = spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen, at = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns
        seen[name] = {x.doc_id: x for x in at.collect()}
    ids = {i for i, *_ in rows}
    assert set(seen["language_id"]) == ids - {102, 103, 104}
    assert set(seen["exact_dedup"]) == ids - {102, 103, 104, 3}
    assert 100 in seen["simhash_dedup"] and len({4, 101} & set(seen["simhash_dedup"])) >= 1
    assert set(seen["surrogates"]) == set(seen["simhash_dedup"])
    assert all("a.b@c" not in x.text and x.n_chars == len(x.text) for x in seen["surrogates"].values())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(packing.word_tokenizer_path())
    want = {(i, len(tokenizer.encode(x.text, add_special_tokens=False).ids) + 1) for i, x in seen["surrogates"].items()}
    assert {(x.doc_id, x.length) for x in packed} == want


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Null ids and texts, repeated rows, a very long text, further columns of other names, and an empty table."""
    r = random.Random(9)
    words = "the of and to in that was his with for had you not be her on at by which have".split()
    text = lambda k: " ".join(r.choices(words, k=k))
    rows = [(i, text(60), "en") for i in range(30)] + [(None, text(60), "en"), (None, None, None), (7, text(50), None), (40, text(120_000), "en")]
    rows += [rows[2], rows[2], (None, rows[3][1], "en")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_entities int, kinds string, piece string"
    docs = spark.createDataFrame([(i, t, g, "s", len(t or ""), 1, "k", "p") for i, t, g in rows], schema)
    for name, table_ in (("some", docs), ("none", docs.limit(0))):
        table_.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns and {(x.n_entities, x.kinds, x.piece) for x in at.collect()} == {(1, "k", "p")}
    kept = [x.doc_id for x in at.collect()]
    assert sorted(i for i in kept if i is not None) == sorted([*range(30), 7, 40]) and kept.count(None) == 1  # two texts have id 7
    packed = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert {x.doc_id for x in packed} == set(kept) and max(x.piece for x in packed if x.doc_id == 40) > 50
    # No piece overlaps another in its sequence, and none is left out.
    used = collections.defaultdict(list)
    for x in packed:
        used[x.sequence_id].append((x.offset, x.length))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_near_ranges_are_read_at_once():
    near, far = warc.NEAR_BYTES, warc.READ_BYTES
    places = [(0, 10), (14, 10), (24 + near, 5), (30 + 2 * near, 5), (40 + 2 * near, far)]
    assert list(warc._stretches(places)) == [places[:3], places[3:4], places[4:]]
    assert list(warc._stretches([])) == []


def test_warc_finds_addresses_with_blanks_in_the_host(spark, tmp_path):
    urls = [" http://a.com/x", "http://a.com ", "http://a.com\n", "\thttp://a.com", "http://a b.com/y z", "\r\nhttp://a.com:80/#f g", " ", None, "http://a.com/x"]
    spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(r.page_id for r in warc.op7_warc(spark, str(tmp_path)).collect()) == list(range(len(urls)))
