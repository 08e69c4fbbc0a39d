"""Knowledge-base releases as Spark tables: scan, shred, check, merge, publish, look up."""

from .operators.compare import assert_same_rows, reconcile_counts, table_counts
from .operators.dedup import keep_first
from .operators.delta import DeltaPlan, apply_delta, classify_changes, delta_report
from .operators.quality import QualityError, check_tables
from .operators.shred import parse_entry, shred
from .plans.load import build_staging, run_load, version_gate
from .schemas import TABLES
from .session import RECOMMENDED_CONF, configure
from .sources.entries import dataset_union, entry_count, scan_entries
from .sources.release_files import release_catalog, verify_checksums
from .sources.snapshots import (
    ensure_tables,
    latest_release,
    load_history,
    open_snapshot,
    publish,
    publish_full,
    register_views,
)
from .sources.tsv import read_tsv, write_tsv

__all__ = [
    "DeltaPlan", "QualityError", "RECOMMENDED_CONF", "TABLES", "apply_delta", "assert_same_rows", "build_staging",
    "check_tables", "classify_changes", "configure", "dataset_union", "delta_report", "ensure_tables", "entry_count",
    "keep_first", "latest_release", "load_history", "open_snapshot", "parse_entry", "publish", "publish_full",
    "read_tsv", "reconcile_counts", "register_views", "release_catalog", "run_load", "scan_entries", "shred",
    "table_counts", "verify_checksums", "version_gate", "write_tsv",
]
