"""Load pipelines: documents to a published snapshot."""

from __future__ import annotations

import logging
import traceback
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..operators.compare import reconcile_counts
from ..operators.delta import DeltaPlan, apply_delta
from ..operators.quality import QualityError, check_entries, check_on_duplicate
from ..operators.shred import distinct_in_entry, parse_entry, shred
from ..session import materialize
from ..sources import snapshots
from ..sources.entries import Paths, cut_fragments, dataset_union, lexed_fragments, readable_paths, suspect_files

log = logging.getLogger(__name__)

MODES = ("full", "delta")


class StaleReleaseError(ValueError):
    """The release to load is older than the live one."""


def version_gate(current: str | None, new: str | None) -> bool:
    """False if the live version is the new one already; an older new version is an error."""
    if not current or not new:
        return True
    if new < current:
        raise StaleReleaseError(f"release {new} is older than the loaded release {current}")
    return new != current


def stage_entries(
    spark: SparkSession,
    sources: Mapping[str, Paths],
    path: str,
    profile: str = "standard",
    on_duplicate: str = "fail",
) -> DataFrame:
    """Scan, parse and check all datasets; returns the parsed entries as a written table.

    The documents are read and parsed once. The seven tables and all gates then read single
    columns of the result, and a lost executor costs no second parse. Files that were cut where they
    may not be (see ``sources.entries``) are read again by the lexer and replace their first parse.
    """
    check_on_duplicate(on_duplicate)
    fragments = dataset_union(spark, sources, cut_fragments)
    parsed = materialize(parse_entry(fragments, profile, mode="PERMISSIVE"), f"{path}/cut")
    odd = materialize(suspect_files(parsed), f"{path}/suspect-files")
    files: dict[str, list[str]] = {}
    for row in odd.toLocalIterator():
        files.setdefault(row.dataset, []).append(row.file)
    if files:
        lexed = []
        for i, (name, paths) in enumerate(sources.items()):
            if name in files:
                listed = readable_paths(spark, paths)
                lexed.append(lexed_fragments(spark, [listed[f] for f in sorted(files[name])], name, i))
        again = parse_entry(reduce(DataFrame.unionByName, lexed), profile, mode="PERMISSIVE")
        right = parsed.join(odd, ["dataset", "file"], "left_anti").select(parsed.columns)
        parsed = right.unionByName(materialize(again, f"{path}/lexed"))
    check_entries(parsed, on_duplicate)
    return parsed


def build_staging(
    spark: SparkSession,
    sources: Mapping[str, Paths],
    path: str,
    profile: str = "standard",
    on_duplicate: str = "fail",
) -> dict[str, DataFrame]:
    """The seven staged tables of a release, keys unique.

    With ``on_duplicate="keep_first"`` a name, keyword or id repeated inside one entry is kept once
    instead of failing the load.
    """
    return _shredded(stage_entries(spark, sources, path, profile, on_duplicate), on_duplicate)


def _shredded(parsed: DataFrame, on_duplicate: str) -> dict[str, DataFrame]:
    return shred(distinct_in_entry(parsed) if on_duplicate == "keep_first" else parsed)


def declared_counts(release: Mapping) -> dict[str, int]:
    """Entries per dataset as the release's notes declare them; what they don't declare (or as 0) is left out."""
    named = {"swissprot": release.get("swissprot_entry_count"), "trembl": release.get("trembl_entry_count")}
    return {dataset: n for dataset, n in named.items() if n}


def check_counts(spark: SparkSession, parsed: DataFrame, declared: Mapping[str, int], tolerance: float = 0.0) -> list[Row]:
    """Entries per dataset against the declared ones: dataset, n_declared (NULL: not declared), n_loaded.

    Raises if a declared count is missed by more than its share ``tolerance``. Reads two narrow columns of the
    staged entries.
    """
    named = spark.createDataFrame([(d, int(n)) for d, n in declared.items()], "dataset string, n_entries bigint")
    found = reconcile_counts(named, parsed.where(F.col("primary_accession").isNotNull()))
    rows = found.orderBy("dataset").collect()  # one a dataset
    for row in rows:
        if row.dataset in declared and abs(row.n_loaded - row.n_declared) > tolerance * row.n_declared:
            raise QualityError(f"{row.dataset}: {row.n_loaded} entries, the release declares {row.n_declared}")
    return [Row(dataset=r.dataset, n_declared=r.n_declared if r.dataset in declared else None, n_loaded=r.n_loaded) for r in rows]


def _row_counts(written: Mapping[str, Mapping[str, int]], live: Mapping[str, DataFrame], met: Mapping) -> list[Row]:
    """What a load did to every table; live rows are counted from Parquet footers."""
    out = []
    for name, counts in written.items():
        inserted, updated, kept = (counts[c] for c in ("inserted", "updated", "kept"))
        if name in met:
            again = met[name]()
            inserted, updated = inserted - again, updated + again
        before = live[name].count() if live else 0
        out.append(Row(table_name=name, inserted=inserted, updated=updated, kept=kept, deleted=before - updated - kept))
    return out


def run_load(
    spark: SparkSession,
    sources: Mapping[str, Paths],
    root: str,
    release: Mapping,
    mode: str = "full",
    profile: str = "standard",
    on_duplicate: str = "fail",
    refresh_payload: bool = False,
    scope: Column | None = None,
    declared: Mapping[str, int] | None = None,
    tolerance: float = 0.0,
    json_index: bool = False,
) -> str | None:
    """Load a release into the snapshots below ``root``; returns the new live generation.

    ``sources`` maps dataset names to documents, in load order. ``release`` holds version,
    release_date and the declared entry counts. ``declared`` (see :func:`declared_counts`) makes the entries of each
    dataset a gate: a count that is off by more than ``tolerance`` fails the load. ``json_index`` also writes the index
    that ``find_by_json`` uses. A delta onto the version that is live already does
    nothing and returns None. Any failure leaves the live generation as it was and is logged. The log's row
    of a completed run says how many rows of each table were inserted, updated, kept and deleted.
    """
    run = {
        "run_id": str(uuid.uuid4()),
        "mode": mode,
        "dataset": "all" if len(sources) > 1 else next(iter(sources), None),
        "start_time": datetime.now(timezone.utc),
    }
    live = None
    try:
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        check_on_duplicate(on_duplicate)
        snapshots.check_release(release)
        if unknown := sorted(set(declared or ()) - set(sources)):
            raise ValueError(f"counts declared for datasets that aren't loaded: {unknown}")
        live = snapshots.current_generation(spark, root)
        if mode == "delta" and not version_gate(
            snapshots.latest_release(spark, root), release.get("version")
        ):
            log.warning("release %s is live already", release.get("version"))
            return None

        generation = snapshots.new_generation()
        work = f"{root.rstrip('/')}/work/{generation}"
        parsed = stage_entries(spark, sources, f"{work}/entries", profile, on_duplicate)
        run["entry_counts"] = check_counts(spark, parsed, declared or {}, tolerance)
        tables = _shredded(parsed, on_duplicate)
        met: dict = {}
        if mode == "delta":
            live = snapshots.ensure_tables(spark, root)
        before = snapshots.open_snapshot(spark, root, live) if live else {}
        if mode == "delta":
            tables = apply_delta(
                before,
                tables,
                DeltaPlan(),
                refresh_payload=refresh_payload,
                scope=scope,
                work_dir=work,
                met=met,
            )
        n_buckets = snapshots.buckets_for(sum(r.n_loaded for r in run["entry_counts"]))
        written = snapshots.stage_tables(spark, tables, root, generation, n_buckets=n_buckets)
        if json_index:
            snapshots.write_json_index(spark, root, generation)
        snapshots.write_release_metadata(spark, root, generation, release)
        run["row_counts"] = _row_counts(written, before, met)
        snapshots.publish(spark, root, generation, mode, live)
    except Exception as error:
        run.update(
            status="FAILED",
            end_time=datetime.now(timezone.utc),
            error_message="".join(traceback.format_exception(error)),
            generation=live,
            row_counts=None,
        )
        snapshots.append_load_history(spark, root, run)
        raise
    run.update(status="COMPLETED", end_time=datetime.now(timezone.utc), generation=generation)
    snapshots.append_load_history(spark, root, run)
    return generation
