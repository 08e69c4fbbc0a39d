"""Versioned table snapshots below one root folder.

    <root>/generations/<generation>/<table>   Parquet, written once
    <root>/publications/<seq>.json            numbered log; the largest seq is live
    <root>/load_history                       append-only log of runs

A generation becomes visible with one new entry in ``publications``: readers see the old tables before it and all new
ones after it. An entry is created only if its number is free, so of two loads that started from the same live
generation one publishes and the other fails. Older generations stay readable by name, version or time.

``proteins`` and ``sequences`` have a folder per hash bucket of the accession, and child rows carry their protein's
bucket: a lookup by a child's column first finds the few buckets its hits lie in and reads no other.
"""

from __future__ import annotations

import json
import logging
import os
import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window, functions as F, types as T

from ..functions.json_terms import blob_terms
from ..schemas import BUCKET, BUCKETED, CHILD_TABLES, JSON_TERMS, LOAD_HISTORY, PUBLICATIONS, RELEASE_METADATA, TABLES

log = logging.getLogger(__name__)

METADATA = "release_metadata"
LAYOUT = "layout"
JSON_INDEX = "json_terms"
# The columns that can be searched by containment.
INDEXED_BLOBS = ("comments_data", "features_data", "db_references_data")
# Rows a bucket is meant for, and the fewest and most buckets.
BUCKET_ROWS, MIN_BUCKETS, MAX_BUCKETS = 1 << 17, 8, 4096
# Column of a merged row that says what the merge did; counted while the table is written.
CHANGE = "_change"


def _now() -> datetime:
    return datetime.now(timezone.utc)


def new_generation() -> str:
    """Name from time and a random suffix."""
    return f"{_now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def generation_dir(root: str, generation: str) -> str:
    return f"{root.rstrip('/')}/generations/{generation}"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet table, or None if nothing was ever written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def buckets_for(n_rows: int) -> int:
    """Number of buckets for so many proteins: a power of two."""
    wanted = max(1, -(-n_rows // BUCKET_ROWS))
    return min(MAX_BUCKETS, max(MIN_BUCKETS, 1 << (wanted - 1).bit_length()))


def bucket_of(accession: Column, n_buckets: int | Column) -> Column:
    return F.pmod(F.xxhash64(accession), n_buckets).cast("int")


def write_table(df: DataFrame, path: str, name: str, n_buckets: int) -> dict[str, int]:
    """Write one table; returns how many rows were written, by what the merge did to them.

    Bucketed tables get a folder per bucket. Narrow tables are clustered by their lookup column, so that Parquet
    statistics let a lookup skip files. Large buckets and hot values are split over files by the rebalance. The rows
    are counted in the writing tasks, behind every shuffle, so no task that is run again counts twice.
    """
    spec = TABLES[name]
    change = F.col(CHANGE) if CHANGE in df.columns else F.lit("inserted")
    df = df.select(*spec.columns, change.alias(CHANGE))
    partitions: list[str] = []
    if name in BUCKETED or name in CHILD_TABLES:
        df = df.withColumn(BUCKET, bucket_of(F.col(spec.key[0]), n_buckets))
    if name in BUCKETED:
        df = df.hint("rebalance", BUCKET)
        partitions = [BUCKET]
    elif spec.lookup is not None:
        df = df.hint("rebalance", spec.lookup).sortWithinPartitions(spec.lookup)
    written = Observation()
    counts = [F.count_if(F.col(CHANGE) == c).alias(c) for c in ("inserted", "updated", "kept")]
    writer = df.observe(written, *counts).drop(CHANGE).write.partitionBy(*partitions)
    if "entry_name" in spec.columns:
        writer = writer.option("parquet.bloom.filter.enabled#entry_name", "true")
    writer.parquet(path)
    return written.get


def stage_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    generation: str,
    parallel: int = 3,
    n_buckets: int = MIN_BUCKETS,
) -> dict[str, dict[str, int]]:
    """Write all tables of a new, still invisible generation; a missing table becomes an empty one.

    Writes are submitted from a few threads so that the tail of one does not idle the cluster. Returns the rows
    written for each table (see :func:`write_table`).
    """
    base = generation_dir(root, generation)

    def write(name: str) -> dict[str, int]:
        df = tables.get(name)
        if df is None:
            log.warning("no data for table %s", name)
            df = empty_table(spark, TABLES[name].schema)
        return write_table(df, f"{base}/{name}", name, n_buckets)

    with ThreadPoolExecutor(parallel) as pool:
        counts = dict(zip(TABLES, pool.map(write, TABLES), strict=True))
    spark.createDataFrame([(n_buckets,)], "n_buckets int").coalesce(1).write.parquet(f"{base}/{LAYOUT}")
    return counts


def write_json_index(spark: SparkSession, root: str, generation: str) -> None:
    """The containment index of a staged generation: blob, term, primary_accession, bucket; clustered by term.

    A term that most proteins have is split over files by the rebalance.
    """
    base = generation_dir(root, generation)
    spec = TABLES["proteins"]
    schema = T.StructType([*spec.schema, T.StructField(BUCKET, T.IntegerType())])
    proteins = spark.read.schema(schema).parquet(f"{base}/proteins")
    named = [F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("blob"), F.col(c).alias("value"))) for c in INDEXED_BLOBS]
    blobs = proteins.select("primary_accession", BUCKET, F.explode(F.array_compact(F.array(*named))).alias("b"))
    terms = blobs.select("primary_accession", BUCKET, "b.blob", blob_terms(F.col("b.value")).alias("terms"))
    rows = terms.select("blob", F.explode("terms").alias("term"), "primary_accession", BUCKET)
    rows.hint("rebalance", "term").sortWithinPartitions("term", "blob").write.parquet(f"{base}/{JSON_INDEX}")


def release_day(value: date | str | None) -> date | None:
    """A date, or ISO text of one; anything else is an error."""
    if isinstance(value, datetime):
        return value.date()
    if value is None or isinstance(value, date):
        return value
    if isinstance(value, str):
        return date.fromisoformat(value.strip())
    raise ValueError(f"release_date must be a date or ISO text, not {value!r}")


def check_release(info: Mapping) -> None:
    """Raises unless ``info`` has a version and, if any, a readable date: before anything is written."""
    if not info.get("version"):
        raise ValueError("the release has no version")
    release_day(info.get("release_date"))


class NotLiveError(RuntimeError):
    """Another load published in the meantime."""


def write_release_metadata(spark: SparkSession, root: str, generation: str, info: Mapping) -> None:
    """The one metadata row of a generation, stamped with the load time."""
    check_release(info)
    row = Row(
        version=info["version"],
        release_date=release_day(info.get("release_date")),
        load_timestamp=_now(),
        swissprot_entry_count=info.get("swissprot_entry_count") or 0,
        trembl_entry_count=info.get("trembl_entry_count") or 0,
    )
    df = spark.createDataFrame([row], RELEASE_METADATA)
    df.write.mode("overwrite").parquet(f"{generation_dir(root, generation)}/{METADATA}")


def _publications_dir(root: str) -> str:
    return f"{root.rstrip('/')}/publications"


def publications(spark: SparkSession, root: str) -> DataFrame:
    """All publications, newest first; empty before the first."""
    try:
        df = spark.read.schema(PUBLICATIONS).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(_publications_dir(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = empty_table(spark, PUBLICATIONS)
    return df.orderBy(F.desc("seq"))


def current_generation(spark: SparkSession, root: str) -> str | None:
    row = publications(spark, root).first()
    return row.generation if row else None


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless its name is taken; whether this call created it.

    On a local file system the finished file is linked to its name. Elsewhere the file system's create without
    overwriting decides, which is atomic on HDFS and on object stores with conditional writes.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    if system.getUri().getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        stream = system.create(target, False)
        stream.write(bytearray(text.encode()))
        stream.close()
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def _last_number(spark: SparkSession, root: str) -> int:
    """The largest number an entry has, readable already or not."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(_publications_dir(root))
    system = base.getFileSystem(conf)
    names = [s.getPath().getName() for s in system.listStatus(base)] if system.exists(base) else []
    return max((int(n.split(".")[0]) for n in names if n.split(".")[0].isdigit()), default=0)


ANY_GENERATION = object()


def publish(spark: SparkSession, root: str, generation: str, mode: str = "full", expected: object = ANY_GENERATION, patience: float = 10.0) -> int:
    """Make a completely written generation live; returns the publication's number. Publishing an older generation
    again is the rollback.

    ``expected`` is the generation the new one was built on (None: none). If another one is live, or is made live by
    somebody else before this call's entry is created, :class:`NotLiveError` is raised and this generation was never
    live. Without it the call goes on behind the winner. An entry that another writer has begun is waited for, up to
    ``patience`` seconds; an entry that stays empty (its writer died) counts for nothing.
    """
    waited_until = time.monotonic() + patience
    while True:
        number = _last_number(spark, root)
        last = publications(spark, root).first()
        seq = last.seq if last else 0
        if number > seq and time.monotonic() < waited_until:
            time.sleep(0.1)
            continue
        live = last.generation if last else None
        if expected is not ANY_GENERATION and live != expected:
            raise NotLiveError(f"{live} is live, not {expected}")
        number = max(number, seq) + 1
        entry = {"seq": number, "generation": generation, "mode": mode, "published_at": _now().isoformat(timespec="microseconds")}
        if create_exclusively(spark, f"{_publications_dir(root)}/{number:012d}.json", json.dumps(entry)):
            return number


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove work folders and all generations but the live one and the ``keep`` published before it.

    Not while a load runs below ``root``. Returns the names of what was removed.
    """
    if keep < 0:
        raise ValueError("keep must not be negative")
    published = [r.generation for r in publications(spark, root).select("generation").collect()]
    stay = set(list(dict.fromkeys(published))[: keep + 1])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = []
    for folder in ("work", "generations"):
        base = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{folder}")
        system = base.getFileSystem(conf)
        for status in system.listStatus(base) if system.exists(base) else ():
            name = status.getPath().getName()
            if folder == "work" or name not in stay:
                system.delete(status.getPath(), True)
                removed.append(f"{folder}/{name}")
    return removed


def publish_full(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, info: Mapping | None = None, n_buckets: int = MIN_BUCKETS
) -> str:
    """Write tables as a new generation and make it live; the previous one is kept as archive."""
    generation = new_generation()
    stage_tables(spark, tables, root, generation, n_buckets=n_buckets)
    if info is not None:
        write_release_metadata(spark, root, generation, info)
    publish(spark, root, generation, "full")
    return generation


def ensure_tables(spark: SparkSession, root: str) -> str:
    """The live generation; publishes one of empty tables if there is none yet."""
    live = current_generation(spark, root)
    if live is not None:
        return live
    generation = new_generation()
    stage_tables(spark, {}, root, generation)
    try:
        publish(spark, root, generation, "full", expected=None)
    except NotLiveError:  # somebody else was first
        return current_generation(spark, root)
    return generation


def snapshot_catalog(spark: SparkSession, root: str) -> DataFrame:
    """What was live when: seq, generation, mode, version, release_date, published_at, replaced_at (NULL: still live).

    One row per publication, so a generation that was rolled back to has several. Generations that were expired or
    have no metadata have no version.
    """
    published = publications(spark, root)
    by_time = published.withColumn("replaced_at", F.lead("published_at").over(Window.orderBy("seq")))
    try:
        metadata = spark.read.schema(RELEASE_METADATA).parquet(f"{root.rstrip('/')}/generations/*/{METADATA}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return by_time.select(
            "seq", "generation", "mode", F.lit(None).cast("string").alias("version"), F.lit(None).cast("date").alias("release_date"), "published_at", "replaced_at"
        )
    named = metadata.select(
        F.regexp_extract("_metadata.file_path", r"/generations/([^/]+)/[^/]+/[^/]+$", 1).alias("generation"), "version", "release_date"
    )
    return by_time.join(named, "generation", "left").select("seq", "generation", "mode", "version", "release_date", "published_at", "replaced_at")


def live_at(moments: DataFrame, catalog: DataFrame, at: str = "at") -> DataFrame:
    """``moments`` with the publication that was live at the time in column ``at``; columns of the catalogue are NULL
    before the first one. The catalogue has a row per load, so Spark broadcasts it."""
    during = (F.col(at) >= F.col("published_at")) & (F.col("replaced_at").isNull() | (F.col(at) < F.col("replaced_at")))
    return moments.join(catalog, during, "left")


def resolve_generation(
    spark: SparkSession, root: str, version: str | None = None, as_of: datetime | None = None
) -> str:
    """The generation of a release version (published last), live at a time, or live now."""
    if version is None and as_of is None:
        found = current_generation(spark, root)
        if found is None:
            raise LookupError(f"nothing published below {root}")
        return found
    catalog = snapshot_catalog(spark, root)
    if version is not None:
        catalog = catalog.where(F.col("version") == version)
    if as_of is not None:
        catalog = catalog.where(F.col("published_at") <= F.lit(as_of))
        if version is None:
            catalog = catalog.where(F.col("replaced_at").isNull() | (F.col("replaced_at") > F.lit(as_of)))
    row = catalog.orderBy(F.desc("seq")).first()
    if row is None:
        raise LookupError(f"no publication below {root} with version {version} at {as_of}")
    return row.generation


def open_snapshot(
    spark: SparkSession,
    root: str,
    generation: str | None = None,
    rename: Mapping[str, str] | None = None,
    version: str | None = None,
    as_of: datetime | None = None,
    buckets: bool = False,
) -> dict[str, DataFrame]:
    """The tables of one generation, resolved once: the live one, a named one, or that of a release ``version`` or time.

    ``rename`` maps column names to those existing queries use, e.g. for the natural key. With ``buckets`` the tables
    keep the bucket column by which lookups prune folders (see ``operators.lookup``), and the containment index is among
    them if the load wrote one.
    """
    generation = generation or resolve_generation(spark, root, version, as_of)
    base = generation_dir(root, generation)
    tables = {}
    for name, spec in TABLES.items():
        bucketed = buckets and (name in BUCKETED or name in CHILD_TABLES)
        schema = T.StructType([*spec.schema, T.StructField(BUCKET, T.IntegerType())]) if bucketed else spec.schema
        tables[name] = spark.read.schema(schema).parquet(f"{base}/{name}").select(*schema.names)
    if buckets:
        tables[LAYOUT] = spark.read.schema("n_buckets int").parquet(f"{base}/{LAYOUT}")
        index = _read(spark, f"{base}/{JSON_INDEX}", JSON_TERMS)
        if index is not None:
            tables[JSON_INDEX] = index
    metadata = _read(spark, f"{base}/{METADATA}", RELEASE_METADATA)
    tables[METADATA] = metadata if metadata is not None else empty_table(spark, RELEASE_METADATA)
    if rename:
        tables = {n: df.withColumnsRenamed(dict(rename)) for n, df in tables.items()}
    return tables


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Temporary views for SQL over a snapshot."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def latest_version(metadata: DataFrame) -> DataFrame:
    """The version loaded last, as a one-row DataFrame."""
    return metadata.orderBy(F.desc("load_timestamp"), F.desc("version")).limit(1).select("version", "load_timestamp")


def latest_release(spark: SparkSession, root: str) -> str | None:
    """Version of the live generation, None if nothing (or nothing with metadata) is live."""
    generation = current_generation(spark, root)
    if generation is None:
        return None
    row = latest_version(open_snapshot(spark, root, generation)[METADATA]).first()
    return row.version if row else None


def append_load_history(spark: SparkSession, root: str, run: Mapping) -> None:
    """Log a run; a failure to log is reported and does not fail the run."""
    try:
        row = tuple(run.get(c) for c in LOAD_HISTORY.names)
        df = spark.createDataFrame([row], LOAD_HISTORY).coalesce(1)
        df.write.mode("append").parquet(f"{root.rstrip('/')}/load_history")
    except Exception:  # noqa: BLE001 - bookkeeping must not break a load
        log.exception("could not append to the load history")


def row_counts(history: DataFrame) -> DataFrame:
    """What each run did to each table: run_id, mode, table_name, inserted, updated, kept, deleted."""
    return history.select("run_id", "mode", F.inline("row_counts"))


def load_history(spark: SparkSession, root: str, generation: str | None = None) -> DataFrame:
    """Runs by start time, all of them or those that ended on one generation."""
    df = _read(spark, f"{root.rstrip('/')}/load_history", LOAD_HISTORY)
    df = df if df is not None else empty_table(spark, LOAD_HISTORY)
    return ordered_history(df if generation is None else df.where(F.col("generation") == generation))


def ordered_history(history: DataFrame) -> DataFrame:
    return history.orderBy("start_time", "run_id")
