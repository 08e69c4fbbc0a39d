"""Tab-separated interchange files, one gzip folder per table."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ..functions.columns import conform
from ..schemas import TABLES
from ..session import materialize, scratch_dir

# Workers get these functions with the task, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

# Field separator, quoting, header row, empty field for a missing value.
_FORMAT = {
    "sep": "\t",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_table_tsv(df: DataFrame, path: str) -> None:
    """Write one table; every task writes one part file with a header."""
    texts = []
    for f in df.schema:
        c = F.col(f.name)
        # Fixed value: booleans are spelled True / False in these files.
        text = F.initcap(c.cast("string")) if isinstance(f.dataType, T.BooleanType) else c
        texts.append(text.alias(f.name))
    df.select(*texts).write.options(**_FORMAT, compression="gzip", lineSep="\n").csv(path)


def write_tsv(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write all tables below ``path``."""
    for name, df in tables.items():
        write_table_tsv(df, f"{path}/{name}")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Physical lines in order: file key, block, file, value."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.xxhash64("_metadata.file_path").alias("key"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_path").alias("file"),
        "value",
    )


def line_parities(lines: DataFrame) -> DataFrame:
    """Per split whether its quotes are odd in number, whether any of its lines' are, and the file's first line.

    Quotes inside a value are doubled, so a line whose quotes before it (in its file) are odd in number starts inside a
    quoted value. The parities of splits add up like those of lines: nothing but one row a split leaves the scan.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    first = F.when(F.col("block") == 0, F.col("value"))
    counted = lines.select("key", "block", "file", (quotes % 2).alias("odd"), first.alias("value"), F.monotonically_increasing_id().alias("at"))
    return counted.groupBy("key", "block").agg(
        F.min("file").alias("file"),
        (F.sum("odd") % 2).cast("int").alias("parity"),
        F.max("odd").cast("int").alias("spans"),
        F.min_by("value", "at").alias("header"),
    )


def _header(file: str, line: str) -> tuple[str, ...]:
    if line.count('"') % 2:
        raise ValueError(f"{file}: a line break in a column name")
    names = next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")], delimiter="\t"), [])
    if len(set(names)) < len(names) or not names:
        raise ValueError(f"{file}: repeated or missing column names in {names}")
    return tuple(names)


def _contexts(splits: Sequence[Row]) -> dict[tuple[int, int], int]:
    """For every split the split in which the record that is open at its start began; -1 if none is open."""
    out: dict[tuple[int, int], int] = {}
    before = None
    for r in sorted(splits, key=lambda r: (r.key, r.block)):
        if before is None or before.key != r.key:
            opened = -1
        elif (opened >= 0) == bool(before.parity):
            opened = -1  # an even number of quotes since the file's start
        elif opened < 0 or before.spans:
            opened = before.block
        out[r.key, r.block] = opened
        before = r
    return out


_SCHEMA = pa.schema(
    [("key", pa.int64()), ("start_block", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())]
)


def _records(lines: DataFrame, contexts: Mapping[tuple[int, int], int]) -> DataFrame:
    """Records without the header, in parts where one lies in several splits: key, start_block, block, whole, text.

    Only lines with an odd number of quotes change anything, so the others pass through as they are.
    """
    sent = lines.sparkSession.sparkContext.broadcast(dict(contexts))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: tuple[int, int] | None = None
        waiting: list[str] = []  # lines of the open record
        start = -1  # the split it began in
        header = False
        out: list[tuple] = []

        def batch_of_rows() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

        for batch in batches:
            for key, block, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, block) != split:
                    if waiting:
                        out.append((split[0], start, split[1], False, "\n".join(waiting)))
                    if (key, block) not in sent.value:
                        raise RuntimeError("the splits changed between the two passes of the scan; run it again")
                    split, waiting, start, header = (key, block), [], sent.value[key, block], block == 0
                if header:
                    header = False
                    continue
                odd = line.count('"') % 2
                if start < 0 and not odd:
                    out.append((key, block, block, True, line))
                    continue
                if start < 0:
                    start = block
                    waiting.append(line)
                    continue
                waiting.append(line)
                if odd:
                    out.append((key, start, block, start == block, "\n".join(waiting)))
                    waiting, start = [], -1
            if out:
                yield batch_of_rows()
                out = []
        if waiting:
            out.append((split[0], start, split[1], False, "\n".join(waiting)))
            yield batch_of_rows()

    return lines.select("key", "block", "value").mapInArrow(cut, "key long, start_block long, block long, whole boolean, text string")


def read_tsv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Read a table by its files' headers; '' is NULL, bad text or a wrong number of fields fails the job.

    ``schema`` is a StructType or the name of one of the fixed tables. Every file has its own header, in any order: its
    columns are found by name, columns it lacks are NULL, others are ignored. A file with none of the table's
    columns is an error.

    Plain files are read by many tasks. A first pass counts quotes, which tells for every split whether it starts inside
    a value with line breaks; the second cuts records at the line breaks that end one, and puts records that lie in
    several splits together. Compressed files are a task each.
    """
    if isinstance(schema, str):
        schema = TABLES[schema].schema
    lines = _lines(spark, path)
    splits = line_parities(lines).collect()  # a small row for each split that the driver plans anyway
    headers: dict[tuple[str, ...], list[int]] = {}
    for r in splits:
        if r.block == 0:
            names = _header(r.file, r.header)
            if not set(names) & set(schema.names):
                raise ValueError(f"{r.file}: none of the columns {schema.names} in {names}")
            headers.setdefault(names, []).append(r.key)
    if not headers:
        return spark.createDataFrame([], schema)
    contexts = _contexts(splits)
    records = _records(lines, contexts)
    if any(start >= 0 for start in contexts.values()):
        records = materialize(records, scratch_dir(spark, "tsv-records"))
        parts = records.where(~F.col("whole")).groupBy("key", "start_block").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "\n").alias("text")
        )
        records = records.where("whole").select("key", "text").unionByName(parts.select("key", "text"))
    records = records.where(F.rtrim("text", F.lit("\r")) != "")
    # A line break of two signs at a record's end; inside of values it stays.
    text = F.regexp_replace("text", "\r$", "")
    numbers = {key: i for i, keys in enumerate(headers.values()) for key in keys}
    common = max(headers.values(), key=len)
    others = {k: i for k, i in numbers.items() if i != numbers[common[0]]}
    number = F.lit(numbers[common[0]])
    if others:
        known = F.create_map(*(F.lit(x) for pair in others.items() for x in pair))
        number = F.coalesce(F.try_element_at(known, F.col("key")), number)
    columns = []
    for names in headers:
        types = ", ".join(f"`c{i}` string" for i in range(len(names)))
        columns.append(F.from_csv(text, types, _FORMAT | {"mode": "FAILFAST", "multiLine": "true", "header": "false"}))
    rows = records.withColumn("header", number)
    parsed = None
    for i, (names, fields) in enumerate(zip(headers, columns, strict=True)):
        own = F.struct(*((fields[f"c{names.index(n)}"] if n in names else F.lit(None).cast("string")).alias(n) for n in schema.names))
        parsed = F.when(F.col("header") == i, own) if parsed is None else parsed.when(F.col("header") == i, own)
    return conform(rows.select(F.explode(F.array(parsed)).alias("r")).select("r.*"), schema)
