"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in the given order; NULL keys form one group.

    An aggregate, not a window: every task reduces each key to one row before the shuffle, so a
    key that owns a third of the table costs no more than any other. ``order`` must be total
    within a key for a repeatable result.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("first"))
        .select(*(F.col(c) if c in key else F.col("first")[c].alias(c) for c in df.columns))
    )


def duplicates_removed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many rows ``keep_first`` drops: one row with n_rows, n_keys, n_removed."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_removed"),
        )
    )
