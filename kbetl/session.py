"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings the load is sized for. Entries are a few KB to some MB, so Arrow batches are kept
# short in rows; scan tasks read 512 MB of XML so that a 100 TB release gives ~200k tasks.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.parquet.compression.codec": "zstd",
    # Recording the call site of every column expression costs more than building the expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply :data:`RECOMMENDED_CONF` to a session builder."""
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="kbetl-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage, survives executor loss, and gives the
    planner the real size, so a join broadcasts it only when it is below the threshold."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# File endings of formats that one task must read from the start.
UNSPLITTABLE = r"(?i)\.(gz|gzip|zst|zstd|snappy|lz4|deflate|xz|br)$"
_SPREAD_BYTES = 128 << 20
_PACKED = 4  # how much larger entries are than their compressed file, for the number of partitions


def spread(df: DataFrame, *by: str, files: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """Hash rows over the cluster if some of the input can't be split.

    ``files`` lists the input (``path``, ``length``). Any compressed file may hold most of the data, so one is
    enough for the shuffle; the number of partitions follows the bytes. Splittable inputs pass through unchanged.
    Hashing by value, unlike round robin, gives the same partitions when a lost task is run again.
    """
    if files is None:
        return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism, *by)
    packed = F.col("path").rlike(UNSPLITTABLE)
    row = files.agg(F.count_if(packed).alias("n"), F.sum(F.col("length") * F.when(packed, _PACKED).otherwise(1)).alias("bytes")).first()
    if not row.n:
        return df
    enough = max(df.sparkSession.sparkContext.defaultParallelism, -(-(row.bytes or 0) // _SPREAD_BYTES))
    return df.repartition(partitions or enough, *by)
