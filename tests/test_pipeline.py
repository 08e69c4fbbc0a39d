import json
import os
from datetime import date

import pytest
from conftest import RELEASE_1, document, entry, rows

from kbetl.operators.quality import QualityError
from kbetl.plans.load import StaleReleaseError, run_load, version_gate
from kbetl.sources import snapshots

RELEASE_2 = document(
    entry("W7AB01", name="LAMP_FROG", full_name="Renamed", sequence="MKLLAVWGGHT", length="11", mass="1408",
          genes=[[("primary", "LMPX")]], keywords=[("KX-0042", "Other label")], created="2001-01-01"),
    entry("W8EF03", name="ROOF_FROG", full_name="New protein", sequence="NEW", length="3"),
)
REKEYED = document(entry("W9GH04", name="LAMP_FROG", full_name="Moved", secondary=["W7AB01"], sequence="MV"))


def info(version):
    return {"version": version, "release_date": date(2025, 9, 8), "swissprot_entry_count": 2, "trembl_entry_count": 0}


@pytest.fixture
def root(spark, write, tmp_path):
    root = str(tmp_path / "root")
    run_load(spark, {"swissprot": write(RELEASE_1, "v1.xml.gz")}, root, info("2025_01"))
    return root


def accessions(spark, root, **kw):
    return [r[0] for r in rows(snapshots.open_snapshot(spark, root, **kw)["proteins"], "primary_accession")]


def history(spark, root):
    return [(r.status, r.mode) for r in snapshots.load_history(spark, root).collect()]


def test_full_load(spark, root):
    t = snapshots.open_snapshot(spark, root)
    assert accessions(spark, root) == ["W7AB01", "W7CD02"]
    assert rows(t["genes"]) == [("W7AB01", "LMP", True)]
    (meta,) = t["release_metadata"].collect()
    assert (meta.version, meta.release_date, meta.swissprot_entry_count) == ("2025_01", date(2025, 9, 8), 2)
    assert meta.load_timestamp is not None
    assert snapshots.latest_release(spark, root) == "2025_01"
    assert history(spark, root) == [("COMPLETED", "full")]
    (run,) = snapshots.load_history(spark, root, snapshots.current_generation(spark, root)).collect()
    assert run.dataset == "swissprot" and len(run.run_id) == 36 and run.end_time >= run.start_time


def test_delta_updates_inserts_and_deletes(spark, root, write):
    run_load(spark, {"swissprot": write(RELEASE_2, "v2.xml")}, root, info("2025_02"), "delta")
    t = snapshots.open_snapshot(spark, root)
    assert accessions(spark, root) == ["W7AB01", "W8EF03"]
    old = t["proteins"].where("primary_accession = 'W7AB01'").first()
    assert (old.protein_name, old.created_date) == ("Lamp oil carrier", date(2003, 4, 11))
    assert old.sequence_length == 11
    assert rows(t["genes"]) == [("W7AB01", "LMPX", True)]
    assert rows(t["keywords"]) == [("W7AB01", "KX-0042", "Oil binding")]
    assert rows(t["sequences"]) == [("W7AB01", "MKLLAVWGGHT"), ("W8EF03", "NEW")]
    assert rows(t["protein_to_go"]) == [] and rows(t["accessions"]) == []
    assert rows(t["taxonomy"], "ncbi_taxid") == [(10871,), (9301,)]
    assert snapshots.latest_release(spark, root) == "2025_02"
    assert history(spark, root) == [("COMPLETED", "full"), ("COMPLETED", "delta")]


def test_delta_with_moved_accession(spark, root, write):
    run_load(spark, {"swissprot": write(REKEYED, "v3.xml")}, root, info("2025_03"), "delta")
    t = snapshots.open_snapshot(spark, root)
    assert rows(t["proteins"], "primary_accession", "protein_name") == [("W9GH04", "Moved")]
    assert rows(t["accessions"]) == [("W9GH04", "W7AB01")]
    assert rows(t["genes"]) == [] and rows(t["sequences"]) == [("W9GH04", "MV")]


def test_delta_into_nothing(spark, write, tmp_path):
    root = str(tmp_path / "fresh")
    run_load(spark, {"d": write(RELEASE_1)}, root, info("2025_01"), "delta")
    assert accessions(spark, root) == ["W7AB01", "W7CD02"]


def test_version_gate(spark, root, write):
    assert version_gate(None, "2025_01") and version_gate("2025_01", None) and version_gate("2025_01", "2025_02")
    live = snapshots.current_generation(spark, root)
    source = {"swissprot": write(RELEASE_2, "v2.xml")}
    assert run_load(spark, source, root, info("2025_01"), "delta") is None
    assert history(spark, root) == [("COMPLETED", "full")]
    with pytest.raises(StaleReleaseError):
        run_load(spark, source, root, info("2024_12"), "delta")
    assert snapshots.current_generation(spark, root) == live
    assert history(spark, root)[-1] == ("FAILED", "delta")


@pytest.mark.parametrize(
    "bad",
    [
        document(entry("A"), entry("A")),
        document(entry("A"), "<entry><accession>B</entry>"),
        document(entry("A", taxid="x")),
        document(entry("A"))[:-8],
    ],
)
def test_failed_load_changes_nothing(spark, root, write, bad):
    live = snapshots.current_generation(spark, root)
    for mode in ("full", "delta"):
        with pytest.raises(Exception):
            run_load(spark, {"d": write(bad, "bad.xml")}, root, info("2025_09"), mode)
    assert snapshots.current_generation(spark, root) == live
    assert accessions(spark, root) == ["W7AB01", "W7CD02"]
    last = snapshots.load_history(spark, root).collect()[-1]
    assert last.status == "FAILED" and last.error_message and last.generation == live


def test_wrong_mode_is_logged(spark, root, write):
    with pytest.raises(ValueError, match="mode"):
        run_load(spark, {"d": write(RELEASE_1)}, root, info("1"), "half")
    assert history(spark, root)[-1][0] == "FAILED"


@pytest.mark.parametrize(
    "release, options, message",
    [
        (info("2025_09") | {"release_date": "yesterday"}, {}, "isoformat"),
        (info("2025_09") | {"release_date": 20250901}, {}, "release_date"),
        (info(None), {}, "no version"),
        (info("2025_09"), {"on_duplicate": "first"}, "on_duplicate"),
    ],
)
def test_wrong_arguments_stop_before_any_work(spark, root, write, release, options, message):
    live = snapshots.current_generation(spark, root)
    work = sorted(os.listdir(f"{root}/work"))
    with pytest.raises(ValueError, match=message):
        run_load(spark, {"d": write(RELEASE_1)}, root, release, **options)
    assert snapshots.current_generation(spark, root) == live and sorted(os.listdir(f"{root}/work")) == work


def test_release_date_as_text(spark, write, tmp_path):
    root = str(tmp_path / "text")
    run_load(spark, {"d": write(RELEASE_1)}, root, info("1") | {"release_date": "2025-09-08"})
    assert rows(snapshots.open_snapshot(spark, root)["release_metadata"], "release_date") == [(date(2025, 9, 8),)]


def test_publication_onto_another_live_generation_is_refused(spark, root):
    live = snapshots.current_generation(spark, root)
    with pytest.raises(snapshots.NotLiveError):
        snapshots.publish(spark, root, "mine", "delta", expected="other")
    assert snapshots.current_generation(spark, root) == live


def test_expire(spark, root, write):
    run_load(spark, {"d": write(REKEYED, "v3.xml")}, root, info("2025_03"))
    live = snapshots.current_generation(spark, root)
    removed = snapshots.expire(spark, root, keep=0)
    assert len([r for r in removed if r.startswith("generations/")]) == 1 and os.listdir(f"{root}/work") == []
    assert os.listdir(f"{root}/generations") == [live] and accessions(spark, root) == ["W9GH04"]


def test_two_datasets_keep_the_first_taxon(spark, write, tmp_path):
    root = str(tmp_path / "two")
    sources = {
        "swissprot": write(document(entry("A", organism="one")), "s.xml.gz"),
        "trembl": write(document(entry("B", organism="two"), entry("C", taxid="1", organism="c")), "t.xml.gz"),
    }
    run_load(spark, sources, root, info("1"))
    t = snapshots.open_snapshot(spark, root)
    assert rows(t["taxonomy"], "ncbi_taxid", "scientific_name") == [(1, "c"), (9301, "one")]
    assert snapshots.load_history(spark, root).first().dataset == "all"
    with pytest.raises(QualityError, match="duplicate primary accession"):
        run_load(spark, {"a": sources["swissprot"], "b": sources["swissprot"]}, root, info("2"))


def test_profiles(spark, write, tmp_path):
    doc = document(entry("A", extra='<comment type="function"><text>f</text></comment>'
                         '<comment type="miscellaneous"/><feature type="x"/><evidence key="1"/>'
                         '<dbReference type="PDB" id="1"/>'))
    for profile, n_comments in (("standard", 1), ("full", 2)):
        root = str(tmp_path / profile)
        run_load(spark, {"d": write(doc)}, root, info("1"), profile=profile)
        row = snapshots.open_snapshot(spark, root)["proteins"].first()
        assert len(json.loads(row.comments_data)) == n_comments
        others = [row.features_data, row.db_references_data, row.evidence_data]
        assert all(v is None for v in others) == (profile == "standard")


def test_empty_release(spark, write, tmp_path):
    root = str(tmp_path / "empty")
    run_load(spark, {"d": write("", "e.xml.gz")}, root, info("1"))
    assert accessions(spark, root) == []
    assert snapshots.latest_release(spark, root) == "1"


def test_archive_rollback_and_names(spark, root, write):
    first = snapshots.current_generation(spark, root)
    run_load(spark, {"d": write(REKEYED, "v3.xml")}, root, info("2025_03"))
    assert accessions(spark, root) == ["W9GH04"]
    assert accessions(spark, root, generation=first) == ["W7AB01", "W7CD02"]
    snapshots.publish(spark, root, first, "rollback")
    assert accessions(spark, root) == ["W7AB01", "W7CD02"]
    assert [p.mode for p in snapshots.publications(spark, root).collect()] == ["rollback", "full", "full"]
    renamed = snapshots.open_snapshot(spark, root, rename={"entry_name": "natural_id"})
    snapshots.register_views(renamed, "kb_")
    got = spark.sql("select natural_id from kb_proteins p join kb_taxonomy t using (ncbi_taxid) where t.ncbi_taxid = 9301")
    assert rows(got) == [("LAMP_FROG",)]


def test_staged_tables_are_invisible(spark, root):
    generation = snapshots.new_generation()
    snapshots.stage_tables(spark, {}, root, generation)
    assert accessions(spark, root) == ["W7AB01", "W7CD02"]
    assert accessions(spark, root, generation=generation) == []


def test_ensure_tables(spark, tmp_path):
    root = str(tmp_path / "new")
    assert snapshots.current_generation(spark, root) is None
    assert snapshots.latest_release(spark, root) is None
    with pytest.raises(LookupError):
        snapshots.open_snapshot(spark, root)
    first = snapshots.ensure_tables(spark, root)
    assert snapshots.ensure_tables(spark, root) == first
    assert snapshots.open_snapshot(spark, root)["genes"].count() == 0
    assert snapshots.latest_release(spark, root) is None


def test_history_failure_is_not_raised(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("x")
    snapshots.append_load_history(spark, str(blocked), {"run_id": "r"})


def test_lookup_files_carry_statistics(spark, root):
    generation = snapshots.current_generation(spark, root)
    folder = snapshots.generation_dir(root, generation)
    assert {d for d in os.listdir(folder)} >= set(snapshots.TABLES) | {"release_metadata"}
    genes = snapshots.open_snapshot(spark, root)["genes"].where("gene_name = 'LMP'")
    assert "EqualTo(gene_name,LMP)" in genes._jdf.queryExecution().executedPlan().toString()
