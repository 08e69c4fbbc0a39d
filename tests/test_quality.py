import pytest
from conftest import document, entry, rows

from kbetl.operators import quality
from kbetl.operators.compare import assert_same_rows, reconcile_counts, row_differences, table_counts
from kbetl.operators.dedup import duplicates_removed, keep_first
from kbetl.operators.shred import distinct_in_entry, parse_entry, shred
from kbetl.sources.entries import scan_fragments


def permissive(spark, path):
    return parse_entry(scan_fragments(spark, path), mode="PERMISSIVE")


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "c")], "k int, v string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(quality.null_keys(df, ["k", "v"])) == [(None, "c"), (2, None)]
    with pytest.raises(quality.QualityError, match=r"duplicate key: \(1, 2\)"):
        quality.assert_unique(df, ["k"])
    with pytest.raises(quality.QualityError, match="NULL in key"):
        quality.assert_primary_key(df, ["k"])
    quality.assert_primary_key(df.dropna().distinct(), ["k"])


def test_lengths_and_references(spark):
    child = spark.createDataFrame([("x", 1), ("yyy", 2), ("z", 2), ("n", None)], "v string, fk int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.length_violations(child, ["v"], {"v": 2})) == [("yyy", "v", 3)]
    assert rows(quality.fk_orphans(child, parent, ["fk"], ["id"])) == [(2, 2)]
    with pytest.raises(quality.QualityError):
        quality.assert_lengths(child, ["v"], {"v": 2})
    with pytest.raises(quality.QualityError):
        quality.assert_foreign_key(child, parent, ["fk"], ["id"])


def test_json_gate(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, "{"), (3, None)], "k int, j string")
    assert rows(quality.invalid_json(df, ["k"], ["j"])) == [(2, "j")]


def test_tables_of_good_entries_pass(spark):
    raw = spark.createDataFrame([(entry("A", secondary=["S"], go=["G"], keywords=[("k", "l")]),)], "raw_xml string")
    quality.check_tables(shred(parse_entry(raw)))


@pytest.mark.parametrize(
    "entries, message",
    [
        ([entry("A"), entry("B"), entry("A")], "duplicate primary accession"),
        ([entry("A", go=["G", "G"])], "go_term_id repeated"),
        ([entry("A", keywords=[("k", "a"), ("k", "b")])], "keyword_id repeated"),
        ([entry("A", genes=[[("primary", "g"), ("synonym", "g")]])], "gene_name repeated"),
        ([entry("A", genes=[[("primary", "")]])], "gene_name is NULL"),
        ([entry("A", secondary=["S", "S"])], "secondary_accession repeated"),
        ([entry("A", name="n" * 256)], "entry_name longer than 255"),
        ([entry("A", keywords=[("k", "l" * 256)])], "keyword_label longer than 255"),
        ([entry("A"), "<entry><accession>B</x></entry>"], "malformed entry"),
        ([entry("A"), entry("B")[:-8] + entry("C")], "malformed entry"),
    ],
)
def test_entry_gates(spark, write, entries, message):
    with pytest.raises(quality.QualityError, match=message):
        quality.check_entries(permissive(spark, write(document(*entries))))


def test_cut_document_gate(spark, write):
    text = document(entry("A"), entry("B"))
    with pytest.raises(quality.QualityError, match="cut off"):
        quality.check_entries(permissive(spark, write(text[: text.index("</entry>") + 8])))


def test_keep_first_inside_an_entry(spark, write):
    doc = document(
        entry("A", go=["G", "G"], secondary=["S", "S"], keywords=[("k", "a"), ("k", "b")],
              genes=[[("synonym", "g"), ("primary", "g")]])
    )
    p = permissive(spark, write(doc))
    quality.check_entries(p, on_duplicate="keep_first")
    t = shred(distinct_in_entry(p))
    assert rows(t["protein_to_go"]) == [("A", "G")]
    assert rows(t["accessions"]) == [("A", "S")]
    assert rows(t["keywords"]) == [("A", "k", "a")]
    assert rows(t["genes"]) == [("A", "g", False)]


def test_keep_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 5, "n"), (None, 4, None)], "k int, o int, v string")
    assert rows(keep_first(df, ["k"], ["o"])) == [(None, 4, None), (1, 1, "a")]
    assert rows(duplicates_removed(df, ["k"])) == [(4, 2, 2)]
    assert rows(duplicates_removed(df.limit(0), ["k"])) == [(0, 0, 0)]


def test_comparison(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (1,), (3,)], "x int")
    assert rows(row_differences(a, b)) == [(1, "left"), (3, "right")]
    assert_same_rows(a, spark.createDataFrame([(2,), (1,), (1,)], "x int"))
    with pytest.raises(quality.QualityError):
        assert_same_rows(a, b)
    assert rows(table_counts({"a": a, "none": a.limit(0)})) == [("a", 3), ("none", 0)]


def test_reconcile(spark):
    declared = spark.createDataFrame([("a", 2), ("b", 1)], "dataset string, n_entries long")
    loaded = spark.createDataFrame([("a",), ("a",), ("c",)], "dataset string")
    assert rows(reconcile_counts(declared, loaded)) == [("a", 2, 2, True), ("b", 1, 0, False), ("c", 0, 1, False)]
