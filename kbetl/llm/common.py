"""Helpers shared by the operators: exact column choice, tables, written intermediates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_dir

# What separates words everywhere in this subpackage: space and the controls 0x09 to 0x0D.
WHITESPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the given columns under the given names, whatever else the table holds.

    Columns are taken by position, so further columns whose names clash (also only by case) do no harm.
    """
    names = df.columns
    plain = df.toDF(*(f"_{i}" for i in range(len(names))))
    return plain.select(*(F.col(f"_{names.index(source)}").alias(target) for target, source in columns.items()))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table in the shared folder: cuts the lineage and survives lost executors."""
    return materialize(df, scratch_dir(df.sparkSession, label))


def crc32_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(buckets)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keep_rows(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, key: Callable[[Column], Column]) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose id and ``key`` of the text are in ``chosen``.

    ``chosen`` has the columns ``doc_id, text_key, copies``; where ``copies`` rows share id and text, one stays.
    """
    names = docs.columns
    ids, texts = f"_{names.index(id_col)}", f"_{names.index(text_col)}"
    chosen = written(chosen.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "copies"), "chosen")
    plain = docs.toDF(*(f"_{i}" for i in range(len(names)))).withColumn("_own", key(F.coalesce(texts, F.lit(""))))

    def those(part: DataFrame) -> DataFrame:
        return plain.join(part, (F.col("_own") == F.col("_key")) & F.col(ids).eqNullSafe(F.col("_id")), "left_semi")

    kept = those(chosen.where("copies = 1"))
    repeated = chosen.where("copies > 1")
    if repeated.limit(1).count():
        kept = kept.unionByName(those(repeated).dropDuplicates([ids, "_own"]))
    return kept.drop("_own").toDF(*names)
