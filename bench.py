"""Headline timings at one scale; prints one JSON line.

Documents are rendered and written once before the clock starts, then:
shred_* scans and parses them, load_full / load_delta run the whole pipeline, the others run on
the tables as they are.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from kbetl.operators.shred import parse_entry  # noqa: E402
from kbetl.plans.load import run_load, stage_entries  # noqa: E402
from kbetl.plans.queries import REGISTRY, documents_on_disk, fragments  # noqa: E402
from kbetl.session import configure, scratch_dir  # noqa: E402
from kbetl.sources.entries import dataset_union, entry_count  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

PLAIN = (
    "shred_genes", "shred_taxonomy", "taxon_counts", "json_tree_comments_full", "dedup_keep_first_lineitem",
    "duplicate_keys", "fk_orphans", "length_violations", "delta_classify", "delta_proteins", "delta_sequences",
    "delta_children", "delta_taxonomy", "upsert_partial", "sync_children", "delete_removed", "release_catalog",
    "verify_checksums", "resolve_accession", "lookup_gene", "tsv_roundtrip_documents", "row_differences",
)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        configure(SparkSession.builder.master(f"local[{CPUS}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-"))

    sources = documents_on_disk(spark, SF_DIR)
    entries = fragments(spark, SF_DIR).count()
    seconds: dict[str, float] = {}

    def clock(name: str, work) -> None:
        started = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - started, 3)

    def info(version: str) -> dict:
        return {"version": version, "release_date": date(2025, 9, 1)}

    def relational() -> None:
        parsed = parse_entry(
            dataset_union(spark, sources), "standard", ("sequences", "accessions", "taxonomy", "genes", "keywords", "protein_to_go")
        )
        drain(parsed)

    root = scratch_dir(spark, "root")
    clock("scan_entries_count", lambda: drain(entry_count(dataset_union(spark, sources))))
    clock("shred_relational", relational)
    clock("shred_full_staged", lambda: stage_entries(spark, sources, scratch_dir(spark, "stage"), "full"))
    clock("load_full", lambda: run_load(spark, sources, root, info("2025_01"), "full", "full"))
    clock("load_delta", lambda: run_load(spark, sources, root, info("2025_02"), "delta", "full"))
    for name in PLAIN:
        clock(name, lambda: drain(REGISTRY[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "total headline time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "entries": entries,
                "entries_per_sec_relational": round(entries / seconds["shred_relational"]),
                "entries_per_sec_full_staged": round(entries / seconds["shred_full_staged"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
