"""Exact deduplication: counting quotient filters find repeated fingerprints, bytes decide.

1. Each document gets a 64-bit fingerprint and a SHA-256 of its normalised text (one scan, a narrow table).
2. Each task builds a :class:`CountingQuotientFilter` of its fingerprints and cuts it by the high bits.
   A text with millions of copies is one slot per task, so hot groups are reduced before the shuffle.
3. The pieces of one range are merged losslessly; fingerprints with a count above one come out.
4. Only documents with such a fingerprint have their texts compared, by grouping on the text itself.

Whether the repeated fingerprints are broadcast to the scan of step 4 is Spark's choice by the measured
size of the written table; above the threshold the join shuffles and adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, pick, table, written
from .quotient_filter import CountingQuotientFilter

FINGERPRINTS_PER_SHARD = 1 << 20


def _build(shard_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CountingQuotientFilter.build(np.empty(0, np.uint64))
        pending: list[CountingQuotientFilter] = []
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            pending.append(CountingQuotientFilter.build(values))
            if len(pending) == 64:
                own, pending = CountingQuotientFilter.merge([own, *pending]), []
        for shard, part in CountingQuotientFilter.merge([own, *pending]).split(shard_bits).items():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([part.to_bytes()], pa.binary())], ["shard", "filter"])

    return build


def _repeated(pieces: pa.Table) -> pa.Table:
    filters = [CountingQuotientFilter.from_bytes(x.as_py()) for x in pieces.column("filter")]
    found = CountingQuotientFilter.merge(filters).repeated()
    return pa.table({"fp": pa.array(found.view(np.int64), pa.int64())})


def repeated_fingerprints(fingerprints: DataFrame, n_rows: int) -> DataFrame:
    """The values of the one long column ``fp`` that occur more than once."""
    shard_bits = max(0, (n_rows // FINGERPRINTS_PER_SHARD).bit_length())
    pieces = fingerprints.mapInArrow(_build(shard_bits), "shard long, filter binary")
    return pieces.groupBy("shard").applyInArrow(_repeated, "fp long")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] | None = None
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal normalised texts the row with the largest id stays.

    * A null text is the empty text; all empty texts are one group.
    * Rows with a null id are returned; such a row stays only if its whole group has null ids.
    * Repeated rows (same id and text) count one by one in ``group_size``; one of them stays.
    * An empty table gives no rows. Texts have no length limit. Further columns are ignored.
    """
    same = normalise or (lambda c: c)
    source = pick(docs, doc_id=id_col, text=text_col)
    texts = source.select("doc_id", same(F.coalesce("text", F.lit(""))).alias("text"))
    keyed = texts.select("doc_id", "text", F.xxhash64("text").alias("fp"))
    narrow = written(keyed.select("doc_id", "fp", F.sha2("text", 256).alias("sha")), "dedup-rows")

    multi = written(repeated_fingerprints(narrow.select("fp"), narrow.count()), "dedup-repeated")
    # Grouping by the text compares bytes; the digest only names the group afterwards.
    groups = (
        keyed.join(multi, "fp", "left_semi")
        .groupBy("text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.sha2("text", 256).alias("group_sha"), "keep_id", "group_size")
    )
    rows = narrow.groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("copies"))
    joined = rows.join(groups, rows.sha == groups.group_sha, "left")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    keep_id = F.when(F.col("group_sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), "sha", copy
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of repeated rows (same id and text) one stays, whatever their other columns hold.
    """
    decided = exact_dedup(docs, id_col, text_col)
    each = decided.groupBy("doc_id", F.col("text_sha256").alias("text_key")).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("copies"))
    return keep_rows(docs, each.where("kept"), id_col, text_col, lambda text: F.sha2(text, 256))


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = """
with t as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from t group by text)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.text) as text_sha256
from t join g using (text)
"""
