"""Release delta: merge a staged release into the live tables.

The merge is a closed form over whole tables instead of a sequence of deletes and inserts:

* ``moved`` are live keys whose natural key now has another key. They never contribute old values.
* ``survivors`` are staged parents with a natural key. They are exactly the parents of the result:
  every other live parent is either moved or has vanished from the release.
* columns the upsert leaves alone keep their live value where the key was live before.

Only narrow columns are compared and shuffled. Wide staged rows (JSON, sequences) stream from the
scan to the writer; the few values taken from the live side join as a small table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..session import materialize
from ..sources.snapshots import CHANGE


@dataclass(frozen=True)
class DeltaPlan:
    """Which table plays which part, and which columns an update leaves alone."""

    parent: str = "proteins"
    key: str = "primary_accession"
    natural_key: str = "entry_name"
    kept_on_update: tuple[str, ...] = ("protein_name", "created_date")
    # One row per parent, replaced when staged, otherwise kept: table -> value column.
    attachments: Mapping[str, str] = field(default_factory=lambda: {"sequences": "sequence"})
    # Many rows per parent; the first key column is the parent's key.
    children: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "accessions": ("protein_accession", "secondary_accession"),
            "genes": ("protein_accession", "gene_name"),
            "keywords": ("protein_accession", "keyword_id"),
            "protein_to_go": ("protein_accession", "go_term_id"),
        }
    )
    # Shared rows that are only ever added or updated.
    dimensions: Mapping[str, str] = field(default_factory=lambda: {"taxonomy": "ncbi_taxid"})


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _natural_keys(stage: DataFrame, natural_key: str, key: str) -> DataFrame:
    """One row per staged natural key with the range of its keys.

    Comparing with a range instead of joining row to row keeps the result linear even when a
    natural key is repeated, and the aggregation absorbs a hot one before the shuffle.
    """
    return (
        stage.where(F.col(natural_key).isNotNull())
        .groupBy(natural_key)
        .agg(F.min(key).alias("low_key"), F.max(key).alias("high_key"))
    )


def changed_keys(prod: DataFrame, stage: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Live keys whose natural key is staged under a different key."""
    staged = _natural_keys(stage, natural_key, key)
    return (
        prod.select(natural_key, key)
        .join(staged, natural_key)
        .where((F.col("low_key") != F.col(key)) | (F.col("high_key") != F.col(key)))
        .select(key)
        .distinct()
    )


def removed_keys(prod: DataFrame, stage: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Live keys whose natural key is not staged; a NULL natural key counts as not staged."""
    staged = stage.where(F.col(natural_key).isNotNull()).select(natural_key).distinct()
    named = prod.where(F.col(natural_key).isNotNull())
    unnamed = prod.where(F.col(natural_key).isNull()).select(key)
    return named.select(natural_key, key).join(staged, natural_key, "left_anti").select(key).unionByName(unnamed)


def rekey_delete(prod: DataFrame, stage: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Live rows without those whose natural key moved to another key."""
    return prod.join(changed_keys(prod, stage, natural_key, key), key, "left_anti").select(prod.columns)


def cascade_delete(
    tables: Mapping[str, DataFrame], keys: DataFrame, parent_columns: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Remove the rows of every table that belong to a deleted parent; ``keys`` has one column."""
    (key,) = keys.columns
    return {
        name: df.join(keys.select(F.col(key).alias(parent_columns[name])), parent_columns[name], "left_anti")
        .select(df.columns)
        for name, df in tables.items()
    }


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Insert or update by key; on update only ``update_columns`` (default: all) take new values."""
    untouched = target.join(source.select(*key), list(key), "left_anti").select(source.columns)
    kept = [] if update_columns is None else [c for c in source.columns if c not in (*key, *update_columns)]
    return keep_old_values(source, target, key, kept).unionByName(untouched)


def insert_ignore(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Insert rows with a new key, leave the others as they are."""
    new = source.join(target.select(*key), list(key), "left_anti").select(target.columns)
    return target.unionByName(new)


def keep_old_values(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    kept: Sequence[str],
    work: str | None = None,
    met: Observation | None = None,
) -> DataFrame:
    """``source`` rows with the ``kept`` columns of the target row of the same key, if there is one.

    Only rows where old and new value differ are looked up again, so the wide source rows meet a
    table of real changes. With ``work`` that table is written first and Spark knows its size; ``met`` then observes
    how many source rows have a target row (``n_rows``).
    """
    if not kept:
        return source
    key = list(key)
    old = target.select(*key, *(F.col(c).alias(f"old_{c}") for c in kept))
    same = _all([F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in kept])
    both = source.select(*key, *kept).join(old, key)
    if met is not None:
        both = both.observe(met, F.count(F.lit(1)).alias("n_rows"))
    changes = both.where(~same).select(*key, *(f"old_{c}" for c in kept), F.lit(True).alias("was_live"))
    if work is not None:
        changes = materialize(changes, work)
    return source.join(changes, key, "left").select(
        *(
            F.when(F.col("was_live"), F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) if c in kept else F.col(c)
            for c in source.columns
        )
    )


def sync_children(
    target: DataFrame,
    source: DataFrame,
    parents: DataFrame,
    key: Sequence[str],
    refresh_payload: bool = False,
) -> DataFrame:
    """Make the child rows of the staged ``parents`` those of ``source``.

    Rows of other parents stay. A row that was there already keeps its payload columns unless
    ``refresh_payload``. ``parents`` has one column; every source row belongs to one of them.
    """
    (parent_key,) = parents.columns
    others = target.join(parents.select(F.col(parent_key).alias(key[0])), key[0], "left_anti").select(source.columns)
    kept = [] if refresh_payload else [c for c in source.columns if c not in key]
    return keep_old_values(source, target, key, kept).unionByName(others)


def delete_removed(
    prod: Mapping[str, DataFrame], stage_parent: DataFrame, plan: DeltaPlan = DeltaPlan()
) -> dict[str, DataFrame]:
    """Delete parents whose natural key is gone from the release, and all their rows."""
    gone = removed_keys(prod[plan.parent], stage_parent, plan.natural_key, plan.key)
    owner = {plan.parent: plan.key}
    owner.update({name: plan.key for name in plan.attachments if name in prod})
    owner.update({name: key[0] for name, key in plan.children.items() if name in prod})
    return cascade_delete({name: prod[name] for name in owner}, gone, owner)


def classify_changes(prod: DataFrame, stage: DataFrame, natural_key: str, key: str) -> DataFrame:
    """What happens to every natural key: NEW, UPDATED, REKEYED or REMOVED.

    A full outer comparison as one aggregation over both sides, so repeated natural keys give one
    row each.
    """
    absent = F.lit(None).cast(prod.schema[key].dataType)
    sides = prod.select(natural_key, F.col(key).alias("old_key"), absent.alias("new_key")).unionAll(
        stage.select(natural_key, absent.alias("old_key"), F.col(key).alias("new_key"))
    )
    return (
        sides.where(F.col(natural_key).isNotNull())
        .groupBy(natural_key)
        .agg(
            F.min("old_key").alias("old_key"),
            F.max("old_key").alias("old_high"),
            F.min("new_key").alias("new_key"),
            F.max("new_key").alias("new_high"),
        )
        .select(
            natural_key,
            "old_key",
            "new_key",
            F.when(F.col("old_key").isNull(), "NEW")
            .when(F.col("new_key").isNull(), "REMOVED")
            .when((F.col("old_key") != F.col("new_high")) | (F.col("old_high") != F.col("new_key")), "REKEYED")
            .otherwise("UPDATED")
            .alias("change"),
        )
    )


def delta_report(prod: DataFrame, stage: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Number of natural keys per kind of change."""
    changes = classify_changes(prod, stage, natural_key, key)
    return changes.groupBy("change").agg(F.count(F.lit(1)).alias("n_keys"))


def apply_delta(
    prod: Mapping[str, DataFrame],
    stage: Mapping[str, DataFrame],
    plan: DeltaPlan = DeltaPlan(),
    refresh_payload: bool = False,
    scope: Column | None = None,
    work_dir: str | None = None,
    met: dict[str, Callable[[], int]] | None = None,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The tables after the delta. Both sides must have the same tables of the plan.

    Staged keys must be unique (the load's gates see to that). By default child payloads of keys
    that stay are not refreshed, and live parents that are not in the release are removed
    whatever data set they came from; ``scope`` (a condition on live parents) limits that removal.
    ``work_dir`` (a shared folder) is where small key sets are written so that Spark knows their
    sizes and does not compute them once per table. ``only`` names the tables that are wanted.

    With ``met`` (which needs ``work_dir``) the merge tells what it does to the rows: they get a column ``_change``
    (inserted, updated, kept) that is counted when they are written. The wide staged rows are all called inserted, as
    they never meet the live ones; ``met`` gets for each wide table a function that returns how many were live before.
    """
    if met is not None and work_dir is None:
        raise ValueError("counting what was met needs a work_dir")
    planned = {plan.parent, *plan.dimensions, *plan.attachments, *plan.children}
    if one_sided := sorted(n for n in planned if (n in prod) != (n in stage)):
        raise ValueError(f"tables on one side of the delta only: {one_sided}")
    key, natural = plan.key, plan.natural_key
    live_parent, staged_parent = prod[plan.parent], stage[plan.parent]
    survivors = staged_parent.where(F.col(natural).isNotNull())

    def small(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, f"{work_dir}/{name}") if work_dir else df

    def work(name: str) -> str | None:
        return f"{work_dir}/{name}" if work_dir else None

    def without(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
        return df.join(keys.select(F.col(key).alias(column)), column, "left_anti").select(df.columns)

    # The written key sets are small independent jobs; a few threads keep the cluster busy.
    with ThreadPoolExecutor(4) as pool:
        key_sets = pool.map(
            small,
            (
                changed_keys(live_parent, staged_parent, natural, key),
                # Staged parents that will not survive; nearly always none.
                staged_parent.where(F.col(natural).isNull()).select(key),
            ),
            ("moved", "unnamed"),
        )
        moved, unnamed = key_sets

        out_of_scope = None
        if scope is not None:
            live = without(live_parent.where(~F.coalesce(scope, F.lit(False))), moved, key)
            out_of_scope = without(live, staged_parent, key)

        def with_out_of_scope(result: DataFrame, live: DataFrame, column: str) -> DataFrame:
            if out_of_scope is None:
                return result
            rows = live.join(out_of_scope.select(F.col(key).alias(column)), column, "left_semi")
            return result.unionByName(rows.select(result.columns))

        def merge_parent(name: str) -> DataFrame:
            kept = [c for c in plan.kept_on_update if c in staged_parent.columns]
            old = without(live_parent.select(key, *kept), moved, key)
            if met is None:
                merged = keep_old_values(survivors, old, [key], kept, work("kept_values"))
                return merged if out_of_scope is None else merged.unionByName(out_of_scope.select(merged.columns))
            observed = Observation()
            merged = keep_old_values(survivors, old, [key], kept, work("kept_values"), observed)
            met[name] = (lambda: observed.get["n_rows"]) if kept else survivors.select(key).join(old, key, "left_semi").count
            merged = merged.withColumn(CHANGE, F.lit("inserted"))
            if out_of_scope is not None:
                merged = merged.unionByName(out_of_scope.withColumn(CHANGE, F.lit("kept")).select(merged.columns))
            return merged

        def merge_attachment(name: str) -> DataFrame:
            staged = without(stage[name], unnamed, key)
            # Parents without a staged row keep the live one. Few, so the live table is filtered.
            bare = without(survivors.select(key), stage[name], key)
            bare = small(without(bare, moved, key), f"without_{name}")
            old = prod[name].join(bare, key, "left_semi").select(staged.columns)
            if met is not None:
                # Keys only: the wide rows of the two sides never meet.
                again = without(staged.select(key).join(prod[name].select(key), key, "left_semi"), moved, key)
                met[name] = again.count
                staged, old, live = (df.withColumn(CHANGE, F.lit(c)) for df, c in ((staged, "inserted"), (old, "kept"), (prod[name], "kept")))
                return with_out_of_scope(staged.unionByName(old), live, key)
            return with_out_of_scope(staged.unionByName(old), prod[name], key)

        def merge_children(name: str) -> DataFrame:
            columns = plan.children[name]
            staged = without(stage[name], unnamed, columns[0])
            payload = [] if refresh_payload else [c for c in staged.columns if c not in columns]
            if met is not None:
                old = without(prod[name], moved, columns[0]).select(*columns, *(F.col(c).alias(f"old_{c}") for c in payload), F.lit(True).alias("was_live"))
                stays = "updated" if refresh_payload and len(staged.columns) > len(columns) else "kept"
                merged = staged.join(old, list(columns), "left").select(
                    *(F.when(F.col("was_live"), F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) if c in payload else F.col(c) for c in staged.columns),
                    F.when(F.col("was_live"), stays).otherwise("inserted").alias(CHANGE),
                )
                return with_out_of_scope(merged, prod[name].withColumn(CHANGE, F.lit("kept")), columns[0])
            old = without(prod[name], moved, columns[0]) if payload else prod[name]
            merged = keep_old_values(staged, old, columns, payload, work(f"kept_{name}"))
            return with_out_of_scope(merged, prod[name], columns[0])

        def merge_dimension(name: str) -> DataFrame:
            own = plan.dimensions[name]
            if met is not None:
                live = prod[name].select(own, F.lit(True).alias("was_live"))
                staged = stage[name].join(live, own, "left").withColumn(CHANGE, F.when(F.col("was_live"), "updated").otherwise("inserted")).drop("was_live")
                untouched = prod[name].join(stage[name].select(own), own, "left_anti").withColumn(CHANGE, F.lit("kept"))
                return staged.unionByName(untouched)
            return upsert(prod[name], stage[name], [own])

        merges = {plan.parent: merge_parent}
        merges.update(dict.fromkeys(plan.dimensions, merge_dimension))
        merges.update(dict.fromkeys(plan.attachments, merge_attachment))
        merges.update(dict.fromkeys(plan.children, merge_children))
        names = [n for n in merges if n in prod and (only is None or n in only)]
        return dict(zip(names, pool.map(lambda n: merges[n](n), names)))
