"""Release texts and checksums, read over whole folders of release files."""

from __future__ import annotations

import hashlib
import re
import sys
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .entries import Paths

# Workers get these functions with the task, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

# Formats of the release files.
MANIFEST_LINE = r"^\s*([a-f0-9]{32})\s+([\w.\-]+\.gz)\s*$"
RELEASE_LINE = r"Release\s+(\S+)\s+of\s+(.*)"
RELEASE_DATE = "d-MMM-yyyy"
# Labels of the declared counts, column by column.
COUNT_LABELS = {"swissprot_entry_count": "Swiss-Prot", "trembl_entry_count": "TrEMBL"}

# Larger files are hashed piece by piece.
_WHOLE_FILE_BYTES = 256 << 20
_CHUNK_BYTES = 8 << 20


def read_texts(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row per file: file, release (the folder it lies in), value."""
    texts = spark.read.option("wholetext", True).text(paths if isinstance(paths, str) else list(paths))
    file = F.col("_metadata.file_path")
    return texts.select(
        file.alias("file"), F.element_at(F.split(file, "/"), -2).alias("release"), "value"
    )


def read_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row per line: release (the folder its file lies in), ord (file order), value."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    release = F.element_at(F.split("_metadata.file_path", "/"), -2).alias("release")
    return lines.select(release, F.monotonically_increasing_id().alias("ord"), "value")


def parse_manifest(lines: DataFrame) -> DataFrame:
    """(release, filename, md5) of the well-formed lines; a file named twice has its last checksum.

    ``lines`` has a column ``value``, to tell releases apart ``release`` (else NULL), and to order repeated
    names ``ord``. Without ``ord`` the smallest of different checksums counts.
    """
    has = lines.columns
    found = lines.where(F.col("value").rlike(MANIFEST_LINE)).select(
        (F.col("release") if "release" in has else F.lit(None).cast("string")).alias("release"),
        F.regexp_extract("value", MANIFEST_LINE, 2).alias("filename"),
        F.regexp_extract("value", MANIFEST_LINE, 1).alias("md5"),
        *([F.col("ord")] if "ord" in has else []),
    )
    last = F.max_by("md5", "ord") if "ord" in has else F.min("md5")
    return found.groupBy("release", "filename").agg(last.alias("md5"))


def parse_release_date(texts: DataFrame, strict: bool = True) -> DataFrame:
    """Adds version, release_date, release_date_text to release notes in column ``value``.

    A date in another format stays as text only. Without a release line the job fails, or with
    ``strict=False`` the columns are NULL.
    """
    found = F.col("value").rlike(RELEASE_LINE)

    def part(i: int) -> Column:
        missing = (
            F.raise_error(F.lit("no release version and date in the release notes")).cast("string")
            if strict
            else F.lit(None).cast("string")
        )
        return F.when(found, F.regexp_extract("value", RELEASE_LINE, i)).otherwise(missing)

    return texts.withColumns({"version": part(1), "release_date_text": part(2)}).withColumn(
        "release_date", F.try_to_date("release_date_text", RELEASE_DATE)
    )


def parse_release_counts(texts: DataFrame, labels: Mapping[str, str] = COUNT_LABELS) -> DataFrame:
    """Adds one declared entry count for each label, by column name; 0 where the text does not give it.

    A count is the number between a label with a colon and the word ``entries``. The label is a word of its own,
    or the last part of a name with slashes.
    """

    def count(label: str) -> Column:
        stated = rf"(?<![^\s/])\Q{label}\E:\s+([0-9][0-9,]*)\s+entries\b"
        digits = F.replace(F.regexp_extract("value", stated, 1), F.lit(","), F.lit(""))
        return F.coalesce(digits.try_cast("int"), F.lit(0))

    return texts.withColumns({name: count(label) for name, label in labels.items()})


def release_catalog(dates: DataFrame, notes: DataFrame, on: str = "release") -> DataFrame:
    """One row per release: version, date and declared counts from the two kinds of text.

    A release without count notes has counts of 0.
    """
    dated = parse_release_date(dates).select(on, "version", "release_date", "release_date_text")
    counted = parse_release_counts(notes).select(on, "swissprot_entry_count", "trembl_entry_count")
    return dated.join(counted, on, "left").fillna(0, ["swissprot_entry_count", "trembl_entry_count"])


# What file names can't hold, as Spark escapes it in names of partition folders, and its name for no value.
_UNSAFE = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _safe_name(value: str | None) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else _NO_VALUE


def write_files(lines: DataFrame, path: str, folder: str, name: str, order: Sequence[str], ending: str = "") -> None:
    """Write each group of rows as ``<path>/<folder>=<value>/<value of name><ending>``, its column ``value`` as lines.

    Rows of a file follow ``order``. A task writes its files one by one, as the rows come, under a hidden name until they
    are whole; so a task that is run again, or runs twice, leaves the same files.
    """
    # An empty text and none give the same name.
    named = lines.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in (folder, name)})
    rows = named.repartition(folder, name).sortWithinPartitions(folder, name, *order)
    rows = rows.select(F.col(folder).alias("folder"), F.col(name).alias("name"), F.col("value").cast("binary").alias("value"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(path)
        is_open, stream, draft, whole, n_files = None, None, "", "", 0
        for batch in batches:
            for key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key[:2] != is_open or stream is None:
                    if stream is not None:
                        stream.close()
                        system.move(draft, whole)
                    target = f"{base}/{folder}={_safe_name(key[0])}"
                    system.create_dir(target, recursive=True)
                    draft, whole = f"{target}/.{uuid.uuid4().hex}", f"{target}/{_safe_name(key[1])}{ending}"
                    is_open, stream, n_files = key[:2], system.open_output_stream(draft, compression=None), n_files + 1
                stream.write((key[2] or b"") + b"\n")
        if stream is not None:
            stream.close()
            system.move(draft, whole)
        yield pa.RecordBatch.from_pydict({"n_files": pa.array([n_files], pa.int64())})

    rows.mapInArrow(written, "n_files long").write.format("noop").mode("overwrite").save()


def file_checksums(spark: SparkSession, paths: Paths, names: str | None = None) -> DataFrame:
    """(release, filename, md5) of files; the release is the folder a file lies in.

    With ``names``, a glob of file names, ``paths`` are folders: many files are better named so, as Spark lists a folder
    at once but every path of its own by a task.

    Files that fit a binary value are read by Spark, from any store. Larger ones are read in chunks by the task,
    one file per task, through the client of their scheme (local files, hdfs, s3a, gs, abfs); the sums are equal.
    """
    reader = spark.read.format("binaryFile")
    if names is not None:
        reader = reader.option("pathGlobFilter", names)
    files = reader.load(paths if isinstance(paths, str) else list(paths))
    parts = F.split("path", "/")
    release, name = F.element_at(parts, -2).alias("release"), F.element_at(parts, -1).alias("filename")
    small = files.where(F.col("length") <= _WHOLE_FILE_BYTES).select(release, name, F.md5("content").alias("md5"))
    large = files.where(F.col("length") > _WHOLE_FILE_BYTES).select(release, name, "path")
    hashed = large.repartition("path").mapInPandas(_hash_in_chunks, "release string, filename string, md5 string")
    return small.unionByName(hashed)


# Schemes of the Hadoop client and the names the chunked reader has for them.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss"}


def _file_system(path: str):
    """The client of a path's scheme, and the path in it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}" if colon else path)


def _hash_in_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sums = []
        for path in batch["path"]:
            system, inner = _file_system(path)
            md5 = hashlib.md5()
            with system.open_input_stream(inner, compression=None) as stream:
                while chunk := stream.read(_CHUNK_BYTES):
                    md5.update(chunk)
            sums.append(md5.hexdigest())
        yield pd.DataFrame({"release": batch["release"], "filename": batch["filename"], "md5": sums})


def verify_checksums(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(release, filename, status): valid, mismatch, or unlisted (accepted, the manifest does not name it).

    Both sides have a release, or none of them (NULL): equal names in different releases are different files.
    """
    expected = manifest.select(F.col("release").alias("_release"), F.col("filename").alias("_filename"), F.col("md5").alias("_expected"))
    same = F.col("release").eqNullSafe(F.col("_release")) & (F.col("filename") == F.col("_filename"))
    return files.join(expected, same, "left").select(
        "release",
        "filename",
        F.when(F.col("_expected").isNull(), "unlisted")
        .when(F.col("_expected") == F.col("md5"), "valid")
        .otherwise("mismatch")
        .alias("status"),
    )
