"""WARC archives of pages and a two-level capture index over them.

Writing: one record per page, ``response`` or, for a payload met before under a smaller id, ``revisit``. A record
and the empty line after it are one line of Spark's text writer, whose line separator is that empty line; so the
segments are ordinary uncompressed WARC files, written and committed like any Spark output, on any file system.

Index: a task reads a segment and lists its records with place and length. All entries are sorted by the
reversed-host form of their address (range partitioning; the id is part of the key, so a hot address is spread),
packed into compressed blocks of ``BLOCK_ENTRIES`` and written. The block directory holds each block's first key.

Lookup: a key is searched by bisection in a top level of at most ``TOP_ENTRIES`` keys (the only thing sent to all
tasks), then in the part of the directory below it, then in the blocks found. Then only the ranges found are read:
tasks get them by stretches of a segment and read each by its place, near ones at once; no segment is read as a whole.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import pick, table, written

MIN_REVISIT_BYTES = 100
SEGMENT_BYTES = 32 << 20
BLOCK_ENTRIES = 1000
TOP_ENTRIES = 1 << 16
NEAR_BYTES = 1 << 16  # ranges that are no farther apart are read at once,
READ_BYTES = 8 << 20  # up to so much
# Schemes of the Hadoop client and the names the range reader has for them.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss"}
_CRLF = "\r\n"
_GAP = "\r\n\r\n"


def surt(url: Column) -> Column:
    """The sort-friendly form of an address: reversed host, port, path and query; no scheme, user or fragment."""
    # Encoded before it is split, as the archive holds it: both sides of a lookup then make the same key.
    bare = F.regexp_replace(F.regexp_replace(_one_line(F.coalesce(url, F.lit(""))), r"(?s)#.*", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?]*@)?", "")
    authority = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    host, port = F.regexp_extract(authority, r"^(.*?)(?::(\d*))?$", 1), F.regexp_extract(authority, r"^(.*?)(?::(\d*))?$", 2)
    turned = F.array_join(F.reverse(F.split(F.regexp_replace(host, r"^www\.", ""), r"\.")), ",")
    rest = F.substring(bare, F.length(authority) + 1, F.length(bare))
    return F.concat(turned, F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)), F.lit(")"), rest)


def _one_line(value: Column) -> Column:
    """Line ends, tabs and spaces as in a percent-encoded address."""
    for plain, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        value = F.replace(value, F.lit(plain), F.lit(code))
    return value


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, payload_bytes, digest, refers_to``; ``refers_to`` is null for responses."""
    texts = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = texts.select("*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha2("html", 256).alias("digest"))
    # Narrow and reduced to one row per payload and task before the shuffle; payloads met once are left out.
    first = (
        keyed.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("of"), "first")
    )
    first = written(first, "first-pages")
    joined = keyed.join(first, F.col("digest") == F.col("of"), "left")
    refers = F.when(F.col("first") < F.col("page_id"), F.col("first"))
    return joined.select("page_id", "url", "html", "payload_bytes", "digest", refers.alias("refers_to"))


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", segment_bytes: int = SEGMENT_BYTES) -> None:
    """One WARC record per row of :func:`mark_revisits` into segments below ``path``.

    Each task writes its rows as they come, to a new segment after as many records as ``segment_bytes`` hold on average.
    """
    revisit = F.col("refers_to").isNotNull()
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), F.col("payload_bytes"), F.lit(_GAP))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    fields = [
        F.concat(F.lit(f"WARC/1.1{_CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(F.coalesce("url", F.lit("")))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    ]
    record = F.concat(F.concat_ws(_CRLF, *fields), F.lit(_GAP), F.col("block"))
    average = pages.agg(F.avg(F.when(revisit, 0).otherwise(F.col("payload_bytes")) + 700)).first()[0] or 1
    rows = pages.withColumn("block", block).select(record.alias("value"))
    rows.write.option("lineSep", _GAP).option("maxRecordsPerFile", max(1, int(segment_bytes / average))).text(path)


def _header(content: memoryview, at: int) -> tuple[dict[str, str], int]:
    """Fields of the record at ``at``, and where its block starts."""
    end = at
    while True:  # headers are short: look for their end in growing steps
        end = min(len(content), end + 2048)
        head = bytes(content[at:end])
        if (stop := head.find(b"\r\n\r\n")) >= 0:
            break
        if end == len(content):
            raise ValueError("a record without an end of its header")
    lines = head[:stop].decode().split(_CRLF)
    if not lines[0].startswith("WARC/"):
        raise ValueError("not at the start of a record")
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:]), at + stop + 4


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Address, id, segment, place and length of every record of the segments (columns path, content)."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = memoryview(content.as_buffer())
            rows, at = [], 0
            while at < len(data):
                fields, start = _header(data, at)
                end = start + int(fields["Content-Length"])
                rows.append((fields["WARC-Target-URI"], fields["WARC-Record-ID"][10:-1], path.rsplit("/", 1)[-1], at, end - at))
                at = end + len(_GAP)
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["url", "page", "segment", "at", "length"])


def _pack(entries: int):
    """Sorted entries of one range partition (key, segment, at, length, part) as compressed, numbered blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[str, str, int]] = []
        made = 0

        def block(part: list[tuple[str, str, int]]) -> pa.RecordBatch:
            data = zlib.compress("\n".join(line for _, line, _ in part).encode())
            values = ([part[0][0]], [(part[0][2] << 32) + made], [data])
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, (pa.string(), pa.int64(), pa.binary()), strict=True)], ["first", "number", "block"])

        for batch in batches:
            for key, segment, at, length, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append((key, f"{key}\t{segment}\t{at}\t{length}", part))
            while len(waiting) >= entries:
                yield block(waiting[:entries])
                waiting = waiting[entries:]
                made += 1
        if waiting:
            yield block(waiting)

    return run


@dataclass(frozen=True)
class CaptureIndex:
    """The index of an archive. Block numbers rise with the keys; ``top`` names the first block of each group of the directory."""

    archive: str
    blocks: DataFrame  # number, block
    directory: DataFrame  # top, number, first
    top: list[tuple[bytes, int]]  # first key and number of the groups' first blocks


def segments(spark: SparkSession, archive: str) -> DataFrame:
    """``path, content`` of all segments."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(archive).select("path", "content")


def build_index(spark: SparkSession, archive: str, block_entries: int = BLOCK_ENTRIES) -> CaptureIndex:
    """Reads all segments of ``archive`` and writes its index below the shared scratch folder."""
    found = segments(spark, archive).mapInArrow(_entries, "url string, page string, segment string, at long, length long")
    keyed = written(found.select(F.concat(surt(F.col("url")), F.lit(" "), F.col("page")).alias("key"), "segment", "at", "length"), "captures")
    ordered = keyed.repartitionByRange("key").sortWithinPartitions("key", "segment", "at").withColumn("part", F.spark_partition_id())
    blocks = written(ordered.mapInArrow(_pack(block_entries), "first string, number long, block binary"), "index-blocks")
    fan = max(1, -(-blocks.count() // TOP_ENTRIES))
    # Groups of ``fan`` blocks of one range partition: at most TOP_ENTRIES of them, and one for each partition.
    top = (F.col("number") - F.expr(f"number % {1 << 32} % {fan}")).alias("top")
    directory = written(blocks.select(top, "number", "first"), "index-directory")
    heads = directory.where("top = number").select("first", "number").orderBy("number").collect()
    return CaptureIndex(archive, blocks.select("number", "block"), directory, [(r.first.encode(), r.number) for r in heads])


def _between(firsts: list[bytes], low: bytes, high: bytes) -> range:
    """Places whose stretch, from their first key to the next, may hold keys from ``low`` to below ``high``."""
    return range(max(0, bisect_left(firsts, low) - 1), bisect_left(firsts, high))


def locate(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """``segment, at, length`` of all captures of the addresses ``surt`` in the one column of ``keys``."""
    shared = keys.sparkSession.sparkContext.broadcast(index.top)

    def in_top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, numbers = [k for k, _ in shared.value], [n for _, n in shared.value]
        for batch in batches:
            out = [(key, numbers[i]) for key in batch.column(0).to_pylist() for i in _between(firsts, *_bounds(key))]
            columns = list(zip(*out, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], ["key", "top"])

    def in_directory(wanted: pa.Table, group: pa.Table) -> pa.Table:
        rows = sorted(zip(group.column("number").to_pylist(), (f.encode() for f in group.column("first").to_pylist()), strict=True))
        firsts = [f for _, f in rows]
        out = [(key, rows[i][0]) for key in wanted.column("key").to_pylist() for i in _between(firsts, *_bounds(key))]
        columns = list(zip(*out, strict=True)) or [(), ()]
        return pa.table({"key": pa.array(columns[0], pa.string()), "number": pa.array(columns[1], pa.int64())})

    def in_block(wanted: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        for data in block.column("block").to_pylist():
            lines = zlib.decompress(data).split(b"\n")
            for key in wanted.column("key").to_pylist():
                low, high = _bounds(key)
                for line in lines[bisect_left(lines, low) : bisect_left(lines, high)]:
                    _, segment, at, length = line.rsplit(b"\t", 3)
                    out.append((segment.decode(), int(at), int(length)))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["segment", "at", "length"])

    named = keys.toDF("key").distinct().mapInArrow(in_top, "key string, top long")
    by_top = named.groupBy("top").cogroup(index.directory.groupBy("top")).applyInArrow(in_directory, "key string, number long")
    by_block = by_top.groupBy("number").cogroup(index.blocks.groupBy("number")).applyInArrow(in_block, "segment string, at long, length long")
    return written(by_block, "located")


def _bounds(key: str) -> tuple[bytes, bytes]:
    """All captures of an address: from it with a space (the id follows) to below it with the next character."""
    return f"{key} ".encode(), f"{key}!".encode()


_RECORD = "page string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string"


def _record(data: memoryview, at: int, length: int) -> tuple:
    """What the record at ``at`` says of itself, and its payload; a payload without the header's digest is an error."""
    fields, start = _header(data, at)
    http = bytes(data[start : at + length])
    head = http.index(_GAP.encode())
    size = int(http[:head].rsplit(b": ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = http[head + 4 :] if fields["WARC-Type"] == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't have its digest")
    refers = fields.get("WARC-Refers-To", "")[10:-1] or None
    return fields["WARC-Record-ID"][10:-1], fields["WARC-Target-URI"], fields["WARC-Type"], refers, size, digest, payload


_RECORD_KINDS = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
_RECORD_NAMES = ["page", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]


def _stretches(places: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Ranges in order, together where they are near one another: what is read at once."""
    part: list[tuple[int, int]] = []
    for at, length in places:
        if part and (at - sum(part[-1]) > NEAR_BYTES or at + length - part[0][0] > READ_BYTES):
            yield part
            part = []
        part.append((at, length))
    if part:
        yield part


def _open_archive(archive: str):
    """The file system client of an archive's scheme and the archive's place in it."""
    from pyarrow import fs

    scheme, colon, rest = archive.partition(":")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}" if colon else archive)


def _read(spark: SparkSession, archive: str, located: DataFrame, payload: bool) -> DataFrame:
    names = [*_RECORD_NAMES, "payload"][: len(_RECORD_NAMES) + payload]
    kinds = (*_RECORD_KINDS, pa.binary())[: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_archive(archive)
        name = file = None
        try:
            for batch in batches:
                by_segment: dict[str, list[tuple[int, int]]] = {}
                for segment, at, length in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                    by_segment.setdefault(segment, []).append((at, length))
                for segment, places in by_segment.items():
                    if segment != name:
                        if file is not None:
                            file.close()
                        name, file = segment, system.open_input_file(f"{base}/{segment}")
                    for part in _stretches(sorted(places)):
                        first = part[0][0]
                        data = memoryview(file.read_at(sum(part[-1]) - first, first))
                        rows = [_record(data, at - first, length)[: len(names)] for at, length in part]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        finally:
            if file is not None:
                file.close()

    # A segment's wanted ranges go to tasks by stretches of it, in order; a hot segment is many tasks' work.
    dealt = located.select("segment", "at", "length", F.floor(F.col("at") / SEGMENT_BYTES).alias("stretch"))
    ordered = dealt.repartition("segment", "stretch").sortWithinPartitions("segment", "at")
    return ordered.mapInArrow(run, _RECORD + ", payload binary" * payload)


def describe_records(spark: SparkSession, archive: str, located: DataFrame) -> DataFrame:
    """``page, url, record_type, refers_to, payload_bytes, payload_digest`` of the records at the given places.

    Only the located ranges of the segments are read. Payloads are read and their digests checked in the task that
    reads them, and never shuffled. A revisit's size and digest are those its header gives.
    """
    return _read(spark, archive, located, False)


def read_records(spark: SparkSession, archive: str, located: DataFrame) -> DataFrame:
    """As :func:`describe_records`, with the ``payload`` (null for a revisit)."""
    return _read(spark, archive, located, True)


def archive_pages(
    pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", segment_bytes: int = SEGMENT_BYTES
) -> tuple[str, CaptureIndex]:
    """Writes the archive of ``pages`` and its index; returns the archive's folder and the index.

    * A null html is the empty payload, a null url the empty address. Line ends and blanks in addresses are
      percent-encoded.
    * Of equal payloads of at least ``MIN_REVISIT_BYTES`` bytes the smallest id is a response, larger ids revisit it.
      Rows with a null id, and repeated rows of the smallest id, are responses.
    * An empty table gives an archive without records. Further columns are ignored.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    rows = pick(pages, page_id=page_col, url=url_col, html=html_col)
    write_archive(mark_revisits(rows), path, segment_bytes=segment_bytes)
    return path, build_index(spark, path)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive, index = archive_pages(pages)
    located = locate(index, pages.select(surt(F.col("url"))))
    if (n := located.count()) != (wanted := pages.count()):
        raise ValueError(f"{n} records located of {wanted} pages")
    back = describe_records(spark, archive, located)
    kind = pages.schema["page_id"].dataType
    return back.select(
        F.expr("nullif(page, '')").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


OP7_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
k as (select page_id, strlen(html) as payload_bytes, sha256(html) as payload_digest from p),
f as (select payload_digest, min(page_id) as first from k where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, payload_digest, case when first < page_id then 'revisit' else 'response' end as record_type,
  case when first < page_id then first end as refers_to
from k left join f using (payload_digest)
"""
