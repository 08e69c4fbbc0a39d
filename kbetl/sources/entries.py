"""Splittable scan of entry documents.

Most documents are cut at the literal close tag of an entry, which Spark's text reader does at any byte a split starts.
Where that could be wrong (a comment, section or attribute holds a tag, tags are written otherwise) the fragment says so,
and since fragments that don't leave the next one in the same state, a file without such a fragment is cut right.
The other files are read again by a lexer (see ``markup``): each split becomes a map over lexer states, the maps are
composed over the splits of a file, and a second pass cuts every split with its true start. Entries that lie in several
splits are put together by the split they start in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import UNSPLITTABLE, materialize, scratch_dir, spread
from . import markup

Paths = str | Sequence[str]

# Columns that put entries of a union of datasets into file order.
FILE_ORDER = ("dataset_ord", "file", "block", "ord")

# What can hold markup that isn't markup.
_HIDDEN = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!DOCTYPE[^\[>]*\[.*?\]\s*>"
_LEFT_OPEN = r"<!--|<!\[CDATA\[|<\?|<!DOCTYPE[^>]*\["
# A colon behind what may be a tag's prefix (a name of 33 characters may be one of any length), or before what may be the
# rest of an attribute's name.
_PREFIX_COLON = r":(?:(?<=</?[A-Za-z_][\w.\-]{0,31}:)|(?<=[\w.\-]{33}:)|[\w.\-]+\s*=\s*[\"'])"
_COLUMNS = ("dataset", "dataset_ord", "file", "block", "ord", "raw_xml", "starts", "tail", "suspect", "namespaces")


def _listed(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def input_files(spark: SparkSession, paths: Paths) -> DataFrame:
    """``path, length`` of the input, from its listing; nothing is read."""
    return spark.read.format("binaryFile").load(_listed(paths)).select("path", "length")


def readable_paths(spark: SparkSession, paths: Paths) -> dict[str, str]:
    """Paths to read the input files by, by their name in a scan's ``file`` column."""
    files = spark.read.format("binaryFile").load(_listed(paths)).select("_metadata.file_path", "path")
    return {r.file_path: r.path for r in files.collect()}  # two names a file, by one job


def cut_fragments(
    spark: SparkSession,
    paths: Paths,
    dataset: str = "entries",
    dataset_ord: int = 0,
    row_tag: str = "entry",
    min_partitions: int | None = None,
) -> DataFrame:
    """Cut documents at the literal entry close tag; one row per entry plus one row per document tail.

    Plain files are split by Spark like any text file. A compressed file is read by one task, so if there is
    any the entries are spread over the cluster before they are parsed, over as many partitions as their bytes
    need (at least ``min_partitions``). File position is taken before that shuffle.

    Start tags are searched outside of comments, sections and instructions that begin and end in the fragment; an empty
    ``<entry/>`` is no entry. ``suspect`` marks every fragment whose cut needs the lexer: something hidden is open at
    its end, it hasn't exactly one start tag, tags of the row element have a prefix or blanks before their ``>``, or
    the entry uses prefixes that the document's root declares. See :func:`suspect_files`.

    Columns: dataset, dataset_ord, file, block, ord, raw_xml (NULL on a tail row), starts (entry start tags in
    the fragment), tail (NULL on an entry row), suspect, namespaces (prefix declarations of the root; here NULL).
    """
    close = f"</{row_tag}>"
    start = rf"<{row_tag}[\s>]"
    text = spark.read.option("lineSep", close).text(_listed(paths))
    value = F.col("value")
    hides = value.contains("<!") | value.contains("<?")
    bare = F.when(
        F.col("hides") | value.rlike(rf"<{row_tag}(?:\s[^<>]*)?/>"),
        # Hidden parts keep their length, so that places in the text stay true.
        F.regexp_replace(_blanked(value, _HIDDEN), rf"<{row_tag}(?=(?:\s[^<>]*)?/>)", "<" + "-" * len(row_tag)),
    ).otherwise(value)
    rows = text.select(
        F.lit(dataset).alias("dataset"),
        F.lit(dataset_ord).alias("dataset_ord"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("ord"),
        "value",
    )
    # The listing of the scan names the files; another one, for their lengths, is made only if some can't be split.
    if any(re.search(UNSPLITTABLE, f) for f in text.inputFiles()):
        rows = spread(rows, "ord", files=input_files(spark, paths), partitions=min_partitions)
    # Behind that shuffle: only the text itself is sent.
    rows = rows.withColumn("hides", hides).withColumn("bare", bare).withColumn("at", F.regexp_instr("bare", F.lit(start)))
    is_entry = F.col("at") > 0
    starts = F.regexp_count("bare", F.lit(start))
    # Each pattern stands behind literals, or a pattern that starts with one, without which it can't match: most entries
    # are searched for those alone.
    bare = F.col("bare")
    entry = F.expr("substr(bare, at)")
    # Prefixes in the entry itself; the document's head may declare some. Only the colons are looked at in most entries.
    prefixed = bare.contains(":") & bare.rlike(_PREFIX_COLON) & (
        entry.rlike(r"</?[A-Za-z_][\w.\-]*+:") | entry.rlike(r"\s[A-Za-z_][\w.\-]*:[\w.\-]+\s*=\s*[\"']")
    )
    other_tags = (bare.contains(f":{row_tag}") & bare.rlike(rf"</?[^\s<>/:=\"'!?&;]+:{row_tag}[\s/>]")) | (
        bare.contains(f"</{row_tag}") & bare.rlike(rf"</{row_tag}\s+>")
    )
    left_open = F.col("hides") & (bare.contains("<!") | bare.contains("<?")) & bare.rlike(_LEFT_OPEN)
    return rows.select(
        "dataset",
        "dataset_ord",
        "file",
        "block",
        "ord",
        F.when(is_entry, F.concat(F.expr("substr(value, at)"), F.lit(close))).alias("raw_xml"),
        starts.alias("starts"),
        F.when(~is_entry, value).alias("tail"),
        (left_open | (starts > 1) | other_tags | (is_entry & prefixed)).alias("suspect"),
        F.lit(None).cast("string").alias("namespaces"),
    )


def _blanked(value: Column, pattern: str) -> Column:
    """``value`` with every character of the matches of ``pattern`` replaced by a blank."""
    pieces = F.split(value, pattern, -1)
    hidden = F.transform(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)), lambda m: F.repeat(F.lit(" "), F.length(m)))
    return F.array_join(F.zip_with(pieces, hidden, lambda p, h: F.concat(p, F.coalesce(h, F.lit("")))), "")


def suspect_files(fragments: DataFrame) -> DataFrame:
    """Files that :func:`cut_fragments` may have cut wrong: dataset, file.

    A file without a suspect fragment starts every fragment in plain text, so its cuts are right. It must also have one
    tail, behind the last entry, that closes the root; a file without any entry is looked at by the lexer too.
    """
    return (
        fragments.groupBy("dataset", "file")
        .agg(
            F.bool_or("suspect").alias("suspect"),
            F.count("tail").alias("tails"),
            F.count_if(_closing(F.col("tail"))).alias("closed"),
            F.count("starts").alias("fragments"),
        )
        .where(F.col("suspect") | (F.col("tails") != 1) | (F.col("closed") != 1) | (F.col("fragments") == 1))
        .select("dataset", "file")
    )


def _closing(tail: Column) -> Column:
    return tail.rlike(r"(?s)(</[^<>]+>|/>)\s*(<!--(?:(?!-->).)*-->\s*)*$")


# ---------------------------------------------------------------- the lexer over splits


def _records(spark: SparkSession, files: Sequence[str], sent: Column) -> DataFrame:
    """Records of the files in order: file key, block, path (where a record may be the first of an entry or file), value."""
    path = F.col("_metadata.file_path")
    return spark.read.option("lineSep", "<").text(list(files)).select(
        F.xxhash64(path).alias("key"),
        F.col("_metadata.file_block_start").alias("block"),
        F.when((F.length("value") <= 1) | sent, path).alias("path"),
        F.col("value"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """Key, block, start and length of the parts of a batch that come from one split."""
    keys, blocks = batch.column(0), batch.column(1)
    n, start = batch.num_rows, 0
    if not n:
        return
    changed = pc.or_(pc.not_equal(keys.slice(1), keys.slice(0, n - 1)), pc.not_equal(blocks.slice(1), blocks.slice(0, n - 1)))
    for end in [*(i + 1 for i in pc.indices_nonzero(changed).to_pylist()), n]:
        yield keys[start].as_py(), blocks[start].as_py(), start, end - start
        start = end


def split_contexts(spark: SparkSession, files: Sequence[str], row_tag: str = "entry") -> DataFrame:
    """What is true at the start of every split of the files: key, block, state, open_block, prefix, declared.

    First pass of the lexer. A split becomes one row with its map; the maps of a file are composed in order, one row a
    split, so a file of 100 TB has some 200,000 of them.
    """
    tags = markup.Tags(row_tag)
    marked = F.col("value").rlike(tags.marked)
    # Only records that can matter are sent: marked ones and, for the root's declarations, those with some.
    records = _records(spark, files, F.lit(False)).select("key", "block", F.when(marked | F.col("value").contains("xmlns"), F.col("value")).alias("value"))

    def surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_split: tuple[int, int] | None = None
        survey = root = None

        def row() -> pa.RecordBatch:
            found = root.record if root and root.record else b""
            columns = {
                "key": [open_split[0]], "block": [open_split[1]], "ends": [survey.ends], "open_block": [survey.open_block],
                "prefix": [survey.prefix], "declared": [markup.declarations(found)],
            }
            return pa.RecordBatch.from_pydict(columns, schema=schema)

        schema = pa.schema(
            [("key", pa.int64()), ("block", pa.int64()), ("ends", pa.list_(pa.int32())), ("open_block", pa.list_(pa.int64())),
             ("prefix", pa.list_(pa.binary())), ("declared", pa.string())]
        )
        for batch in batches:
            for key, block, start, n in _runs(batch):
                if (key, block) != open_split:
                    if open_split is not None:
                        yield row()
                    open_split, survey = (key, block), markup.Survey(tags, block)
                    root = markup.Root() if block == 0 else None
                values = batch.column(2).slice(start, n)
                if root and root.record is None:
                    # A tag that wasn't sent has no declarations, but it may be the root.
                    for value in values:
                        root.feed(value.as_py().encode() if value.is_valid else b"-")
                        if root.record is not None:
                            break
                for value in values.drop_null():
                    survey.feed(value.as_py().encode())
        if open_split is not None:
            yield row()

    maps = records.mapInArrow(
        surveyed, "key long, block long, ends array<int>, open_block array<long>, prefix array<binary>, declared string"
    )

    def composed(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["block"])
        here = markup.Context(declared=rows[0]["declared"])
        out = []
        for r in rows:
            out.append({"key": r["key"], "block": r["block"], "state": here.state, "open_block": here.open_block, "prefix": here.prefix, "declared": here.declared})
            here = here.after(r["block"], r["ends"], r["open_block"], r["prefix"])
        kinds = [("key", pa.int64()), ("block", pa.int64()), ("state", pa.int32()), ("open_block", pa.int64()), ("prefix", pa.binary()), ("declared", pa.string())]
        return pa.Table.from_pylist(out, schema=pa.schema(kinds))

    return maps.groupBy("key").applyInArrow(composed, "key long, block long, state int, open_block long, prefix binary, declared string")


def lexed_fragments(
    spark: SparkSession,
    files: Sequence[str],
    dataset: str = "entries",
    dataset_ord: int = 0,
    row_tag: str = "entry",
) -> DataFrame:
    """The fragments of :func:`cut_fragments`, cut by the lexer: right for any well-formed document and any splits.

    The result is a written table below the scratch folder. Contexts are sent to the tasks for splits in the middle of
    a file; that is one small row for each split that the driver plans anyway. Tags with the entry's own prefix lose
    it. The tail row of a file is its root's close tag, or empty if the root isn't closed.

    The splits must be the same in both passes; a task that meets another one fails the job (it can only happen when
    executors come or go in between; a fixed ``spark.sql.leafNodeDefaultParallelism`` rules it out).
    """
    if row_tag in "!DOCTYPE[![CDATA[" or not row_tag:
        raise ValueError(f"{row_tag!r} can't be told from other markup")
    tags = markup.Tags(row_tag)
    contexts: dict[tuple[int, int], tuple] = {}
    if not all(re.search(UNSPLITTABLE, f) for f in files):
        found = split_contexts(spark, files, row_tag).where("block > 0")
        contexts = {(r.key, r.block): (r.state, r.open_block, bytes(r.prefix), r.declared) for r in found.toLocalIterator()}
    sent = spark.sparkContext.broadcast(contexts)
    pattern = tags.marked
    records = _records(spark, files, F.col("value").rlike(rf"^(?:[^\s<>/:]+:)?{row_tag}[\s/>]"))
    schema = pa.schema(
        [("key", pa.int64()), ("file", pa.string()), ("block", pa.int64()), ("start_block", pa.int64()), ("ord", pa.int64()), ("xml", pa.string()),
         ("starts", pa.int32()), ("ends", pa.bool_()), ("kind", pa.string()), ("namespaces", pa.string()),
         ("root", pa.string()), ("closed", pa.string()), ("clean", pa.bool_())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_split: tuple[int, int] | None = None
        cutter = path = None
        n_pieces = 0

        def rows(pieces) -> Iterator[dict]:
            nonlocal n_pieces
            for p in pieces:
                n_pieces += 1
                yield {
                    "key": open_split[0], "file": path, "block": open_split[1], "start_block": p.start_block, "ord": n_pieces,
                    "xml": (b"<" * p.whole + p.text).decode("utf-8", "replace"), "starts": p.starts, "ends": p.ends,
                    "kind": "entry" if p.whole else "part", "namespaces": cutter.declared or None,
                }

        def finished() -> Iterator[dict]:
            yield from rows(cutter.finish())
            root, closed, clean = cutter.summary()
            yield {"key": open_split[0], "file": path, "block": open_split[1], "kind": "split", "root": root, "closed": closed, "clean": clean}

        for batch in batches:
            out: list[dict] = []
            for key, block, start, n in _runs(batch):
                if (key, block) != open_split:
                    if open_split is not None:
                        out.extend(finished())
                    if block and (key, block) not in sent.value:
                        raise RuntimeError("the splits changed between the two passes of the scan; run it again")
                    context = markup.Context(*sent.value[key, block]) if block else markup.Context()
                    open_split, cutter, path, n_pieces = (key, block), markup.Cutter(tags, block, context), None, 0
                named = batch.column(2).slice(start, n).drop_null()
                path = path or (named[0].as_py() if len(named) else None)
                values = batch.column(3).slice(start, n)
                marked = pc.indices_nonzero(pc.match_substring_regex(values, pattern)).to_pylist()
                out.extend(rows(cutter.feed(values.cast(pa.binary()).to_pylist(), marked)))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if open_split is not None:
            yield pa.RecordBatch.from_pylist(list(finished()), schema=schema)

    kinds = "key long, file string, block long, start_block long, ord long, xml string, starts int, ends boolean, kind string, namespaces string, root string, closed string, clean boolean"
    lexed = materialize(records.mapInArrow(cut, kinds), scratch_dir(spark, "lexed"))
    splits = lexed.where("kind = 'split'")
    path_of = lexed.where("file is not null").groupBy("key").agg(F.min("file").alias("file"))
    # Splits of one entry: one or two small rows for each split.
    parts = lexed.where("kind = 'part'").groupBy("key", "start_block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "xml"))), lambda p: p["xml"]), "<").alias("xml"),
        F.sum("starts").cast("int").alias("starts"),
        F.bool_or("ends").alias("ends"),
        F.max("namespaces").alias("namespaces"),
    )
    last = F.lit(1 << 62)
    files_ = splits.groupBy("key").agg(
        F.min_by("root", F.when(F.col("root").isNotNull(), F.col("block"))).alias("root"),
        F.max_by("closed", F.when(F.col("closed").isNotNull(), F.col("block"))).alias("closed"),
        F.max_by("clean", "block").alias("clean"),
        F.max("block").alias("block"),
    )
    is_closed = F.coalesce(F.col("clean") & (F.col("root") == F.col("closed")), F.lit(False))
    null = F.lit(None)

    def shaped(df: DataFrame, file: Column | str, block: str, ord_: Column | str, raw: Column, starts: Column | str, tail: Column, namespaces: Column | str) -> DataFrame:
        named = {"file": file, "block": block, "ord": ord_, "raw_xml": raw, "starts": starts, "tail": tail}
        columns = {"dataset": F.lit(dataset), "dataset_ord": F.lit(dataset_ord)} | {n: F.col(c) if isinstance(c, str) else c for n, c in named.items()}
        columns |= {"suspect": F.coalesce(columns["starts"] != 1, F.lit(False)), "namespaces": F.col(namespaces) if isinstance(namespaces, str) else namespaces}
        return df.select(*(columns[c].alias(c) for c in _COLUMNS))

    no_text = null.cast("string")
    whole = shaped(lexed.where("kind = 'entry'"), "file", "block", "ord", F.col("xml"), "starts", no_text, "namespaces")
    joined = parts.where("ends").join(path_of, "key", "left")
    joined = shaped(joined, "file", "start_block", last, F.concat(F.lit("<"), "xml"), "starts", no_text, "namespaces")
    # A file without a record before its first tag and without an entry has no path: its key stands for it.
    named = files_.join(path_of, "key", "left").withColumn("file", F.coalesce("file", F.col("key").cast("string")))
    tails = shaped(named, "file", "block", last + 1, no_text, null.cast("int"), F.when(is_closed, F.concat(F.lit("</"), "root", F.lit(">"))).otherwise(""), no_text)
    return whole.unionByName(joined).unionByName(tails)


def scan_fragments(
    spark: SparkSession,
    paths: Paths,
    dataset: str = "entries",
    dataset_ord: int = 0,
    row_tag: str = "entry",
    min_partitions: int | None = None,
) -> DataFrame:
    """One row per entry plus one per document, cut right whatever the documents hold and wherever they are split.

    A first job looks for files that need the lexer; all others are cut at their close tags. A load saves that job: it
    parses all files by :func:`cut_fragments` and reads those again whose fragments turn out suspect.
    """
    named = (dataset, dataset_ord, row_tag)
    fragments = cut_fragments(spark, paths, *named, min_partitions)
    odd = {r.file for r in suspect_files(fragments).collect()}
    if not odd:
        return fragments
    listed = readable_paths(spark, paths)
    lexed = lexed_fragments(spark, [listed[f] for f in sorted(odd)], *named)
    plain = [path for f, path in listed.items() if f not in odd]
    return cut_fragments(spark, plain, *named, min_partitions).unionByName(lexed) if plain else lexed


def scan_entries(
    spark: SparkSession,
    paths: Paths,
    dataset: str = "entries",
    dataset_ord: int = 0,
    row_tag: str = "entry",
    min_partitions: int | None = None,
) -> DataFrame:
    """One row per entry: dataset, dataset_ord, file, block, ord, raw_xml, starts, suspect, namespaces."""
    return scan_fragments(spark, paths, dataset, dataset_ord, row_tag, min_partitions).where(F.col("raw_xml").isNotNull()).drop("tail")


def dataset_union(spark: SparkSession, sources: Mapping[str, Paths], scan=scan_fragments) -> DataFrame:
    """Scan named datasets in the given order into one DataFrame."""
    scans = [scan(spark, paths, name, i) for i, (name, paths) in enumerate(sources.items())]
    return reduce(DataFrame.unionByName, scans)


def entry_count(entries: DataFrame) -> DataFrame:
    """Entries per dataset."""
    return (
        entries.where(F.col("raw_xml").isNotNull())
        .groupBy("dataset")
        .agg(F.count(F.lit(1)).alias("n_entries"))
    )


def incomplete_documents(fragments: DataFrame) -> DataFrame:
    """Files whose text does not end with a closed root element.

    A complete document leaves exactly one fragment without an entry, ending in a close tag: a
    file cut anywhere else leaves none, or one that ends in the middle of something.
    """
    return (
        fragments.groupBy("dataset", "file")
        .agg(F.count_if(_closing(F.col("tail"))).alias("closed_tails"), F.count("tail").alias("tails"))
        .where((F.col("closed_tails") != 1) | (F.col("tails") != 1))
        .select("dataset", "file", "closed_tails")
    )
