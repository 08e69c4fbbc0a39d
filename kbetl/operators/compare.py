"""Order-insensitive comparison and counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .quality import QualityError


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference both ways: the rows, with ``side`` naming where each is in excess.

    One shuffle of both tables: equal rows are summed with the sign of their side.
    """
    both = left.withColumn("_sign", F.lit(1)).unionByName(right.select(left.columns).withColumn("_sign", F.lit(-1)))
    excess = both.groupBy(*left.columns).agg(F.sum("_sign").alias("_excess")).where("_excess <> 0")
    side = F.when(F.col("_excess") > 0, "left").otherwise("right").alias("side")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_excess"))).alias("_copy")
    return excess.select(*left.columns, side, copies).drop("_copy")


def assert_same_rows(left: DataFrame, right: DataFrame) -> None:
    rows = row_differences(left, right).limit(10).collect()
    if rows:
        raise QualityError(f"tables differ: {[tuple(r) for r in rows]}")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) as one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile_counts(declared: DataFrame, loaded: DataFrame) -> DataFrame:
    """Declared entries per dataset against loaded ones; a dataset on one side only counts as 0 on the other.

    ``declared`` is (dataset, n_entries), one row per dataset; ``loaded`` has one row per entry.
    """
    actual = loaded.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_loaded"))
    return (
        declared.select("dataset", F.col("n_entries").alias("n_declared"))
        .join(actual, "dataset", "full")
        .select(
            "dataset",
            F.coalesce("n_declared", F.lit(0)).cast("bigint").alias("n_declared"),
            F.coalesce("n_loaded", F.lit(0)).cast("bigint").alias("n_loaded"),
        )
        .withColumn("matches", F.col("n_declared") == F.col("n_loaded"))
    )
