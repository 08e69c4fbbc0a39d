"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes, and how common each pair is.

Every token has an end in bytes. Between two neighbouring ends of either side there is one token of each, so the ends of
both sides together are the links, and the ends they share cut the groups: all of it is sorting and searching in arrays.

Long texts are encoded in slices. They are cut at a blank between two characters that are letters, digits, punctuation
or symbols: it starts a token in both tokenizers (neither has tokens that go on over it), so the slices' ids are those of
the whole text. A text with a slice that doesn't come back byte by byte is encoded at once, so that nothing rests on the
cut.

Pair counts come from sorted runs that are merged over the corpus (see ``pair_runs``); the answers are added up at the
postings of each run, which never leave it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, table, written
from .pair_runs import count_pairs, narrow, packed, radix_parts, unpack_pairs, unpacked

RADIXES = 64
SPILL_RECORDS = 1 << 21
SPILL_DOCUMENTS = 1 << 16
FAN_IN = 64
SLICE_CHARS = 1 << 18
PIECE_SPACE = "▁"

_SAFE = r"[\p{L}\p{N}\p{P}\p{S}]"
_CUT = regex.compile(rf"(?<={_SAFE}) (?={_SAFE})")
# Fixed value: how a byte-level vocabulary splits text before it merges.
_PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Ids and bytes of the two tokenizers.

    The byte-level file is run as ranks, several times faster than by its own library; that needs ids in the order of
    the merges. Tests hold it against that library.
    """

    def __init__(self, byte_level_path: str, pieces_path: str):
        import sentencepiece
        import tiktoken

        with open(byte_level_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_level_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()}
        merged = ("".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"])
        if any(model["vocab"][token] != 256 + i for i, token in enumerate(merged)):
            raise ValueError(f"the ids of {byte_level_path} are not in the order of its merges")
        self.a = tiktoken.Encoding("own", pat_str=_PRETOKENS, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(PIECE_SPACE, " ").encode())
        self.sides = len(self.b_bytes)
        self.a_lengths, self.b_lengths = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        # An id as it is written in a group, by whether it is the last of its side there.
        self.written = [f"{i}{sign}" for i in range(len(self.a_bytes)) for sign in ",|"]
        self.b_written = len(self.written)
        self.written += [f"{i}{sign}" for i in range(self.sides) for sign in ",;"]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a blank and the text; None if the bytes of either side's tokens differ from them."""
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        whole = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


def slices(text: str, length: int = SLICE_CHARS) -> Iterator[str]:
    """A text in parts that end where a token ends; the blanks between them belong to the next part's first token."""
    at = 0
    while len(text) - at > length and (place := _CUT.search(text, at + length)):
        yield text[at : place.start()]
        at = place.end()
    yield text[at:]


@dataclass
class Document:
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    groups: str = ""  # their hash
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _aligned(a: np.ndarray, b: np.ndarray, tokenizers: Tokenizers) -> tuple[str, int, np.ndarray]:
    """The groups as text, their number, and the pairs of all links."""
    a_ends, b_ends = np.cumsum(tokenizers.a_lengths[a]), np.cumsum(tokenizers.b_lengths[b])
    ends = np.union1d(a_ends, b_ends)
    pairs = a[np.searchsorted(a_ends, ends)] * tokenizers.sides + b[np.searchsorted(b_ends, ends)]
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_group, b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
    signs = np.concatenate([2 * a + (shared[a_group] == a_ends), tokenizers.b_written + 2 * b + (shared[b_group] == b_ends)])
    order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    text = "".join(map(tokenizers.written.__getitem__, signs[order].tolist()))
    return text[:-1], len(shared), pairs


def align_text(text: str, tokenizers: Tokenizers) -> Document:
    if not text:
        return Document()
    parts = [tokenizers.encode(part) for part in slices(text)]
    if any(p is None for p in parts):
        parts = [tokenizers.encode(text)] if len(parts) > 1 else parts
        if parts[0] is None:
            return Document()
    out, digest, pairs, times = Document(), hashlib.sha256(), [], []
    for k, (a, b) in enumerate(parts):
        groups, n_groups, links = _aligned(a, b, tokenizers)
        digest.update(f"{';' * (k > 0)}{groups}".encode())
        out.n_a, out.n_b, out.n_groups, out.n_links = out.n_a + len(a), out.n_b + len(b), out.n_groups + n_groups, out.n_links + len(links)
        distinct, n = np.unique(links, return_counts=True)
        pairs.append(distinct)
        times.append(n)
    out.pairs, out.times, out.groups = pairs[0], times[0], digest.hexdigest()
    if len(pairs) > 1:
        out.pairs, back = np.unique(np.concatenate(pairs), return_inverse=True)
        out.times = np.zeros(len(out.pairs), np.int64)
        np.add.at(out.times, back, np.concatenate(times))
    return out


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _encoded(rows: DataFrame, byte_level_path: str, pieces_path: str, radixes: int, spill_records: int) -> DataFrame:
    """Runs: one row with the run's documents (``radix`` -1), one per radix with a directory and postings."""
    id_kind = rows.schema["doc_id"].dataType.simpleString()
    struct = f"struct<doc_id: {id_kind}, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(byte_level_path, pieces_path)
        ids: list = []
        docs: list[Document] = []
        n_records = 0
        id_type: pa.DataType | None = None

        def spilled() -> Iterator[pa.RecordBatch]:
            name = uuid.uuid4().hex

            def row(radix: int, documents, directory, postings) -> pa.RecordBatch:
                arrays = [pa.array([name]), pa.array([radix], pa.int32()), documents, pa.array([directory], pa.binary()), pa.array([postings], pa.binary())]
                return pa.RecordBatch.from_arrays(arrays, ["run", "radix", "documents", "directory", "postings"])

            fields = [pa.array(ids, id_type), *(pa.array([getattr(d, c) for d in docs], pa.int64()) for c in _COUNTS), pa.array([d.groups for d in docs])]
            structs = pa.StructArray.from_arrays(fields, ["doc_id", *_COUNTS, "groups_sha256"])
            yield row(-1, pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), structs), None, None)
            pairs, times = np.concatenate([d.pairs for d in docs]), np.concatenate([d.times for d in docs])
            numbers = np.repeat(np.arange(len(docs)), [len(d.pairs) for d in docs])
            nothing = pa.nulls(1, pa.list_(structs.type))
            for radix, directory, postings in radix_parts(pairs, numbers, times, tokenizers.sides, radixes):
                yield row(radix, nothing, directory, postings)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                docs.append(align_text(text.as_py() or "", tokenizers))
                n_records += len(docs[-1].pairs)
                if n_records >= spill_records or len(docs) >= SPILL_DOCUMENTS:
                    yield from spilled()
                    ids, docs, n_records = [], [], 0
        if docs:
            yield from spilled()

    return rows.mapInArrow(run, f"run string, radix int, documents array<{struct}>, directory binary, postings binary")


def _contributions(postings: DataFrame, answers: DataFrame) -> DataFrame:
    """Per run and radix the sums of its documents: ``run, doc, n_best, count_sum``, for documents with a link there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, directory, posting, answer in zip(batch.column(0), *batch.columns[1:], strict=True):
                _, per_pair = unpack_pairs(directory.as_py())
                docs, times = unpacked(posting.as_py(), 2)
                counts, marks = unpacked(answer.as_py(), 2)
                times = times.astype(np.int64)
                sums, best = (np.zeros(int(docs.max()) + 1, np.int64) for _ in range(2))
                np.add.at(sums, docs, np.repeat(counts.astype(np.int64), per_pair) * times)
                np.add.at(best, docs, np.repeat(marks.astype(np.int64), per_pair) * times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()]), pa.array([packed(narrow(sums), narrow(best))], pa.binary())], ["run", "sums"]
                )

    both = postings.join(answers, ["run", "radix"]).select("run", "directory", "postings", "answers")
    return both.mapInArrow(run, "run string, sums binary")


def align_tokenizers(
    docs: DataFrame,
    byte_level_path: str,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    radixes: int = RADIXES,
    spill_records: int = SPILL_RECORDS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    * A null or empty text, and one whose tokens' bytes differ from a blank and the text under either tokenizer, has no
      tokens: all numbers are 0 and the hash is ''.
    * Texts of any length are aligned whole. Repeated rows and null ids come back row by row, and each row counts as a
      document. Ties for the highest count all count as best. An empty table gives no rows. Further columns are ignored.
    """
    import sentencepiece

    if radixes < 1 or spill_records < 1 or fan_in < 2:
        raise ValueError("radixes and spill_records must be positive, fan_in at least 2")
    sides = sentencepiece.SentencePieceProcessor(model_file=pieces_path).get_piece_size()
    rows = pick(docs, doc_id=id_col, text=text_col)
    runs = written(_encoded(rows, byte_level_path, pieces_path, radixes, spill_records), "runs")
    parts = runs.where("radix >= 0")
    answers = written(count_pairs(parts.select("radix", "run", "directory"), sides, fan_in), "pair-counts")
    sums = _contributions(parts.select("run", "radix", "directory", "postings"), answers)
    both = runs.where("radix < 0").select("run", "documents", F.lit(None).cast("binary").alias("sums")).unionByName(
        sums.select("run", F.lit(None).cast(runs.schema["documents"].dataType).alias("documents"), "sums")
    )

    def added_up(group: pa.Table) -> pa.Table:
        (documents,) = (x for x in group.column("documents") if x.is_valid)
        n = len(documents.values)
        total, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for value in group.column("sums").to_pylist():
            if value is not None:
                sums, marks = unpacked(value, 2)
                total[: len(sums)] += sums.astype(np.int64)
                best[: len(marks)] += marks.astype(np.int64)
        made = pa.Table.from_struct_array(pa.chunked_array([documents.values]))
        return made.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total))

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    done = both.groupBy("run").applyInArrow(added_up, made)
    return done.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(table(spark, sf_dir, "documents"), *paths)
