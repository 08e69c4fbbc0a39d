"""Byte-level BPE encoding in overlapping chunks, and decoding.

Most texts are one chunk and are encoded where they are read. A longer text is cut into chunks of
``chunk_chars`` characters that overlap by ``overlap_chars``; the chunks are spread over the cluster and:

1. pre-tokenised in parallel, each from its own start. A boundary is only trusted if the match before it ends
   well inside the chunk, so that no longer match was cut off;
2. stitched: matches depend on what stands to their right only, so once two neighbours share a boundary in
   their overlap they agree from there on. The first shared boundary is where the text is cut;
3. encoded piece by piece, and the pieces' ids concatenated in order.

A text with neighbours that never agree (one word longer than the overlap) is encoded as one piece. Equal long
texts are encoded once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, table, written

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
TAIL_CHARS = 4  # a match this close to the end of a chunk might have gone on
CACHED_PIECES = 300_000
BATCH_BYTES = 1 << 23

_codecs: dict[tuple[str, str], ByteBpe] = {}


class ByteBpe:
    """Ids of whole pre-tokens, remembered; bytes of ids."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        out = []
        known = self.known
        for at in range(0, len(pieces := self.pattern.findall(text)), 1 << 18):
            part = pieces[at : at + (1 << 18)]
            try:
                out.append(b"".join(map(known.get, part)))
            except TypeError:  # a piece isn't known yet
                if len(known) > CACHED_PIECES:
                    known.clear()
                for p in {p for p in part if p not in known}:
                    known[p] = np.array(self.encoding.encode_ordinary(p), "<u4").tobytes()
                out.append(b"".join(map(known.get, part)))
        return b"".join(out)

    def boundaries(self, chunk: str, last: bool) -> np.ndarray:
        """Trusted ends of matches, from the start of the chunk."""
        ends = np.fromiter((m.end() for m in self.pattern.finditer(chunk)), np.int64)
        return ends if last else ends[ends <= len(chunk) - TAIL_CHARS]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec(ranks_path: str, pattern: str) -> ByteBpe:
    if (ranks_path, pattern) not in _codecs:
        _codecs[ranks_path, pattern] = ByteBpe(ranks_path, pattern)
    return _codecs[ranks_path, pattern]


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``BATCH_BYTES``; a row's binary values are its size."""
    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, bytes))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema=schema)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema=schema)


def _encode_rows(rows: DataFrame, ranks_path: str, pattern: str, decode: bool = False) -> DataFrame:
    """The ids of the last column, ``text``, in its place, and if asked for the bytes they decode to."""
    names = rows.columns[:-1]
    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            values = [pa.field(n, pa.binary()) for n in ("ids", "decoded")[: 1 + decode]]
            schema = pa.schema([*(batch.schema.field(i) for i in range(len(names))), *values])
            keys = [c.to_pylist() for c in batch.columns[:-1]]
            made = ((*k, codec.encode(t.as_py() or "")) for *k, t in zip(*keys, batch.columns[-1], strict=True))
            yield from _in_batches(((*row, codec.decode(row[-1])) for row in made) if decode else made, schema)

    return rows.mapInArrow(run, f"{kinds}, ids binary" + ", decoded binary" * decode)


def _stitched(long: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``key, ids`` of the distinct long texts ``key, text``."""
    last = F.floor((F.length("text") - 1) / chunk).cast("int")
    numbered = long.select("key", "text", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("k"))
    chunks = numbered.select("key", "k", "last", F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("chunk"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            keys, ks, lasts, texts = (c.to_pylist() for c in batch.columns)
            heads, tails = [], []
            for k, n, text in zip(ks, lasts, texts, strict=True):
                found = codec.boundaries(text, k == n) + k * chunk
                heads.append(found[found < k * chunk + overlap])
                tails.append(found[found >= (k + 1) * chunk])
            arrays = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], ["key", "k", "last", "head", "tail"])

    spread = chunks.repartition("key", "k")
    found = written(spread.mapInArrow(ends, "key string, k int, last int, head array<long>, tail array<long>"), "chunk-ends")
    after = found.select("key", (F.col("k") - 1).alias("k"), "head")
    shared = found.drop("head").join(after, ["key", "k"]).select("key", "k", "last", F.array_min(F.array_intersect("tail", "head")).alias("cut"))
    cuts = shared.groupBy("key").agg(F.sort_array(F.collect_list("cut")).alias("cuts"), F.max("last").alias("last"))
    # A missing cut leaves fewer cuts than neighbours: then the text is one piece.
    bounds = F.when(F.size("cuts") == F.col("last"), F.concat(F.array(F.lit(0).cast("long")), "cuts")).otherwise(F.array(F.lit(0).cast("long")))
    cut = long.join(cuts, "key").select("key", "text", bounds.alias("starts"))
    pieces = cut.select("key", "text", "starts", F.posexplode("starts").alias("k", "start")).select(
        "key",
        "k",
        F.substring(
            "text", (F.col("start") + 1).cast("int"), (F.coalesce(F.get("starts", F.col("k") + 1), F.length("text").cast("long")) - F.col("start")).cast("int")
        ).alias("text"),
    )
    encoded = _encode_rows(pieces.repartition("key", "k"), ranks_path, pattern)
    whole = encoded.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("k", F.hex("ids").alias("ids")))).alias("parts"))
    return whole.select("key", F.unhex(F.array_join("parts.ids", "")).alias("ids"))


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
    decode: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids`` (little-endian 32-bit integers in one binary value).

    With ``decode`` the bytes that the ids decode to follow as ``decoded``, made in the same pass.

    * A null text is the empty one and has no ids. Texts of any length are encoded whole.
    * Repeated rows and null ids come back row by row. An empty table gives no rows. Further columns are ignored.
    """
    if not TAIL_CHARS < overlap_chars <= chunk_chars:
        raise ValueError("the overlap must be over 4 characters and no longer than a chunk")
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    short = _encode_rows(rows.where(F.length("text") <= chunk_chars), ranks_path, pattern, decode)
    keyed = rows.where(F.length("text") > chunk_chars).withColumn("key", F.sha2("text", 256))
    distinct = written(keyed.groupBy("key").agg(F.first("text").alias("text")), "long-texts")
    result = short
    if distinct.limit(1).count():
        long = written(_stitched(distinct, ranks_path, pattern, chunk_chars, overlap_chars), "long-ids")
        if decode:
            long = written(decode_documents(long.withColumnRenamed("key", "doc_id"), ranks_path, pattern), "long-decoded").withColumnRenamed("doc_id", "key")
        result = short.unionByName(keyed.select("doc_id", "key").join(long, "key").select("doc_id", *long.columns[1:]))
    return result.select("doc_id", F.expr("length(ids) div 4").alias("n_tokens"), *result.columns[1:])


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` (with ``doc_id, ids``) and ``decoded``: the bytes of the ids in a row."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), batch.schema.field(1), pa.field("decoded", pa.binary())])
            made = ((d, x.as_py(), codec.decode(x.as_py())) for d, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True))
            yield from _in_batches(made, schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    own = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    back = encode_documents(table(spark, sf_dir, "documents"), *own, decode=True)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
