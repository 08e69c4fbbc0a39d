"""Publication by several writers, snapshots by version and time, pruned lookups, containment, counts of a load."""

import json
import os
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from conftest import RELEASE_1, document, entry, rows
from pyspark.sql import functions as F

from kbetl.functions.json_terms import node_terms, pattern_terms
from kbetl.operators import lookup
from kbetl.operators.delta import DeltaPlan, apply_delta
from kbetl.operators.quality import QualityError
from kbetl.plans.load import declared_counts, run_load
from kbetl.sources import snapshots


def info(version):
    return {"version": version, "swissprot_entry_count": 2, "trembl_entry_count": 0}


def many(n, **kw):
    return document(
        *(
            entry(f"P{i}", name=f"N{i}", taxid=str(i % 7 + 1), genes=[[("primary", f"g{i % 50}")]], keywords=[(f"k{i % 5}", f"l{i}")], go=[f"GO:{i}"], secondary=[f"S{i}"],
                  extra=f'<feature type="x" description="f{i % 9}"><location><begin position="{i % 11}"/></location></feature>'
                  f'<comment type="function"><text>t{i % 4}</text><more><text>u{i % 3}</text></more></comment>', **kw)
            for i in range(n)
        )
    )


@pytest.fixture
def root(spark, write, tmp_path):
    root = str(tmp_path / "root")
    run_load(spark, {"d": write(many(120))}, root, info("2025_01"), profile="full", json_index=True)
    return root


def test_of_two_writers_one_wins(spark, tmp_path):
    root = str(tmp_path / "r")
    base = snapshots.ensure_tables(spark, root)
    for k in range(3):
        live = snapshots.current_generation(spark, root)

        def attempt(name):
            try:
                return name, snapshots.publish(spark, root, name, "delta", expected=live)
            except snapshots.NotLiveError:
                return name, None

        with ThreadPoolExecutor(4) as pool:
            results = list(pool.map(attempt, [f"{k}{c}" for c in "abcd"]))
        winners = [name for name, seq in results if seq is not None]
        assert len(winners) == 1 and snapshots.current_generation(spark, root) == winners[0]
    log = snapshots.publications(spark, root).collect()
    assert [r.seq for r in log] == [4, 3, 2, 1] and log[-1].generation == base
    with ThreadPoolExecutor(3) as pool:
        assert sorted(pool.map(lambda g: snapshots.publish(spark, root, g), "xyz")) == [5, 6, 7]


def test_names_are_created_once(spark, tmp_path):
    path = f"{tmp_path}/folder/name.json"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: snapshots.create_exclusively(spark, path, str(i)), range(16)))
    assert sum(made) == 1 and open(path).read() == str(made.index(True)) and os.listdir(f"{tmp_path}/folder") == ["name.json"]


def test_an_entry_whose_writer_died_counts_for_nothing(spark, tmp_path):
    root = str(tmp_path / "r")
    first = snapshots.ensure_tables(spark, root)
    open(f"{root}/publications/{2:012d}.json", "w").close()
    assert snapshots.current_generation(spark, root) == first
    assert snapshots.publish(spark, root, "next", expected=first, patience=0.3) == 3
    assert snapshots.current_generation(spark, root) == "next"


def test_two_ensure_tables_agree(spark, tmp_path):
    root = str(tmp_path / "r")
    with ThreadPoolExecutor(2) as pool:
        found = set(pool.map(lambda _: snapshots.ensure_tables(spark, root), range(2)))
    assert found == {snapshots.current_generation(spark, root)} and snapshots.publications(spark, root).count() == 1


def test_snapshots_by_version_and_time(spark, root, write):
    first = snapshots.current_generation(spark, root)
    second = run_load(spark, {"d": write(RELEASE_1, "r.xml")}, root, info("2025_02"))
    snapshots.publish(spark, root, first, "rollback")
    catalog = snapshots.snapshot_catalog(spark, root).orderBy("seq").collect()
    assert [(r.seq, r.generation, r.mode, r.version) for r in catalog] == [
        (1, first, "full", "2025_01"), (2, second, "full", "2025_02"), (3, first, "rollback", "2025_01"),
    ]
    assert [r.replaced_at for r in catalog] == [catalog[1].published_at, catalog[2].published_at, None]
    count = lambda **kw: snapshots.open_snapshot(spark, root, **kw)["proteins"].count()
    assert (count(), count(version="2025_01"), count(version="2025_02")) == (120, 120, 2)
    times = [r.published_at.replace(tzinfo=timezone.utc) for r in catalog]
    assert count(as_of=times[1]) == 2 and count(as_of=times[0]) == 120 and count(as_of=datetime.now(timezone.utc) + timedelta(days=1)) == 120
    for kw in ({"version": "1999_01"}, {"as_of": times[0] - timedelta(seconds=1)}, {"version": "2025_02", "as_of": times[0]}):
        with pytest.raises(LookupError):
            snapshots.open_snapshot(spark, root, **kw)
    moments = spark.createDataFrame([(i, t) for i, t in enumerate([times[0] - timedelta(days=1), *times])], "k int, at timestamp")
    assert rows(snapshots.live_at(moments, snapshots.snapshot_catalog(spark, root)), "k", "seq") == [(0, None), (1, 1), (2, 2), (3, 3)]
    with pytest.raises(LookupError):
        snapshots.resolve_generation(spark, root + "-none", version="2025_01")




def folders_read(df, table):
    """Partition folders that the scan of a table read when ``df`` ran."""
    leaves = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if leaves.apply(i).getClass().getSimpleName() == "FileSourceScanExec"]
    (scan,) = (x for x in scans if x.metadata().apply("Location").find(table + "]") >= 0)
    return scan.metrics().apply("numPartitions").value()


def test_lookups_read_only_hit_buckets(spark, root):
    t = snapshots.open_snapshot(spark, root, buckets=True)
    plain = snapshots.open_snapshot(spark, root)
    n = t[snapshots.LAYOUT].first().n_buckets
    assert n == snapshots.MIN_BUCKETS and len([d for d in os.listdir(f"{root}/generations/{snapshots.current_generation(spark, root)}/proteins") if d.startswith("bucket=")]) == n
    for find, table, value in ((lookup.find_by_gene, "genes", "g7"), (lookup.find_by_keyword, "keywords", "l3"), (lookup.find_by_go, "protein_to_go", "GO:11")):
        found = find(t["proteins"], t[table], value)
        want = rows(find(plain["proteins"], plain[table], value), "primary_accession", "entry_name")
        assert want and rows(found, "primary_accession", "entry_name") == want
        # The wide scan is pruned by the broadcast of the hits' buckets.
        assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
        hit = {r.bucket for r in found.collect()}
        assert folders_read(found, "proteins") == len(hit) < n
    sequences = lookup.with_sequences(lookup.find_by_gene(t["proteins"], t["genes"], "g7"), t["sequences"])
    assert rows(sequences, "primary_accession", "sequence") == [("P107", "MTEST"), ("P57", "MTEST"), ("P7", "MTEST")]
    one = lookup.find_by_accession(t["proteins"], ["P5", "none"], n)
    assert rows(one, "primary_accession") == [("P5",)] and "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString().replace("PartitionFilters: [(", "PartitionFilters: [isnotnull(bucket")
    assert rows(lookup.find_by_accession(plain["proteins"], "P5"), "primary_accession") == [("P5",)]


def test_buckets_follow_the_rows():
    assert [snapshots.buckets_for(n) for n in (0, 1, 1 << 20, (1 << 20) + 1, 10**12)] == [8, 8, 8, 16, 4096]


def random_tree(r, depth=0):
    node = {"tag": r.choice("abc")}
    if r.random() < 0.6:
        node["attributes"] = {r.choice("xy"): r.choice("12") for _ in range(r.randint(1, 2))}
    if r.random() < 0.4:
        node["text"] = r.choice("tu")
    if depth < 4 and r.random() < 0.6:
        node["children"] = [random_tree(r, depth + 1) for _ in range(r.randint(1, 3))]
    return node


def contained(pattern, tree):
    """Containment of JSON documents, by its definition."""
    if isinstance(pattern, list):
        return isinstance(tree, list) and all(any(contained(p, t) for t in tree) for p in pattern)
    if isinstance(pattern, dict):
        return isinstance(tree, dict) and all(k in tree and contained(v, tree[k]) for k, v in pattern.items())
    return pattern == tree


def test_containment_is_that_of_json(spark, root):
    r = random.Random(4)
    trees = [[random_tree(r) for _ in range(r.randint(0, 3))] for _ in range(150)]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(trees)] + [(-1, None)], "k int, b string").cache()
    n_hits = 0
    for _ in range(25):
        pattern = [random_tree(r, r.randint(1, 4)) for _ in range(r.randint(1, 2))]
        want = [i for i, t in enumerate(trees) if contained(pattern, t)]
        got = df.select("k", lookup.json_contains_tree(F.col("b"), pattern).alias("hit"))
        assert sorted(x.k for x in got.where("hit").collect()) == want
        assert all(set(pattern_terms(pattern)) <= set(node_terms(trees[i])) for i in want)
        n_hits += len(want)
    assert n_hits > 50
    below = [{"tag": "a", "descendants": [{"tag": "b", "text": "t"}]}]

    def walk(nodes):
        for n in nodes:
            yield n
            yield from walk(n.get("children", []))

    want = [i for i, t in enumerate(trees) if any(n["tag"] == "a" and any(m["tag"] == "b" and m.get("text") == "t" for m in walk(n.get("children", []))) for n in t)]
    hit = lookup.json_contains_tree(F.col("b"), below)
    assert want and sorted(x.k for x in df.where(hit).collect()) == want and df.where(hit.isNull()).count() == 0
    with pytest.raises(ValueError, match="pattern"):
        lookup.json_contains_tree(F.col("b"), [{"name": "a"}])


def test_lookup_by_json(spark, root):
    t = snapshots.open_snapshot(spark, root, buckets=True)
    index = t[snapshots.JSON_INDEX]

    def found(column, pattern):
        return [r[0] for r in rows(lookup.find_by_json(t["proteins"], index, column, pattern), "primary_accession")]

    deep = [{"tag": "comment", "children": [{"tag": "text", "text": "t1"}, {"tag": "more", "children": [{"tag": "text", "text": "u2"}]}]}]
    assert found("comments_data", deep) == sorted(f"P{i}" for i in range(120) if i % 4 == 1 and i % 3 == 2)
    begin = [{"tag": "feature", "attributes": {"description": "f3"}, "descendants": [{"tag": "begin", "attributes": {"position": "4"}}]}]
    assert found("features_data", begin) == sorted(f"P{i}" for i in range(120) if i % 9 == 3 and i % 11 == 4)
    assert found("features_data", [{"tag": "feature"}, {"tag": "none"}]) == []
    with pytest.raises(ValueError, match="nothing to look up"):
        found("features_data", [{"descendants": [{"tag": "begin"}]}])


def test_what_a_delta_does_to_each_table(spark, root, write):
    changed = [entry(f"P{i}", name=f"N{i}", taxid=str(i % 9 + 1), genes=[[("primary", f"g{i % 50}"), ("synonym", "new")]], sequence="MNEW" if i % 2 else None) for i in range(100, 140)]
    moved = entry("Q1", name="N99", taxid=None, go=["GO:99"])
    run_load(spark, {"d": write(document(*changed, moved), "next.xml")}, root, info("2025_02"), "delta")
    run = snapshots.load_history(spark, root).where("mode = 'delta'")
    counts = {r.table_name: (r.inserted, r.updated, r.kept, r.deleted) for r in snapshots.row_counts(run).collect()}
    assert counts == {
        "taxonomy": (2, 7, 0, 0),
        "proteins": (21, 20, 0, 100),
        "sequences": (11, 10, 10, 100),  # entries that were live and lost their sequence keep it
        "accessions": (0, 0, 0, 120),
        "genes": (60, 0, 20, 100),
        "keywords": (0, 0, 0, 120),
        "protein_to_go": (1, 0, 0, 120),
    }
    after = snapshots.open_snapshot(spark, root)
    for name, (inserted, updated, kept, _) in counts.items():
        assert after[name].count() == inserted + updated + kept
    with pytest.raises(ValueError, match="work_dir"):
        apply_delta(after, after, DeltaPlan(), met={})


def test_full_loads_are_counted_too(spark, root, write):
    run_load(spark, {"d": write(RELEASE_1, "r.xml")}, root, info("2025_02"))
    history = snapshots.load_history(spark, root).collect()
    counts = {t.table_name: tuple(t)[1:] for t in history[-1].row_counts}
    assert counts["proteins"] == (2, 0, 0, 120) and counts["genes"] == (1, 0, 0, 120)
    assert [tuple(c) for c in history[-1].entry_counts] == [("d", None, 2)]


def test_declared_counts_are_a_gate(spark, root, write):
    live = snapshots.current_generation(spark, root)
    source = {"swissprot": write(many(18), "s.xml"), "trembl": write(document(), "t.xml")}
    with pytest.raises(QualityError, match="18 entries, the release declares 20"):
        run_load(spark, source, root, info("2025_02"), declared={"swissprot": 20})
    assert snapshots.current_generation(spark, root) == live
    failed = snapshots.load_history(spark, root).collect()[-1]
    assert failed.status == "FAILED" and failed.row_counts is None
    with pytest.raises(ValueError, match="aren't loaded"):
        run_load(spark, source, root, info("2025_02"), declared={"other": 1})
    with pytest.raises(QualityError, match="trembl: 0 entries"):
        run_load(spark, source, root, info("2025_02"), declared={"swissprot": 18, "trembl": 1})
    run_load(spark, source, root, info("2025_02"), declared={"swissprot": 20}, tolerance=0.1)
    done = snapshots.load_history(spark, root).collect()[-1]
    assert [tuple(c) for c in done.entry_counts] == [("swissprot", 20, 18)]
    assert declared_counts({"swissprot_entry_count": 5, "trembl_entry_count": 0}) == {"swissprot": 5}
