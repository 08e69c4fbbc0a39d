import csv
import hashlib
import io
import random
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from kbetl.operators import lookup
from kbetl.schemas import TABLES
from kbetl.session import scratch_dir
from kbetl.sources import release_files as rf, tsv


def texts(spark, *values):
    return spark.createDataFrame([(f"r{i}", v) for i, v in enumerate(values)], "release string, value string")


def test_manifest(spark, write):
    path = write(
        "d41d8cd98f00b204e9800998ecf8427e  a_sprot.xml.gz\nnot a line\n"
        "  0123456789abcdef0123456789abcdef\tb.xml.gz  \n"
        "d41d8cd98f00b204e9800998ecf8427e  c.txt\nD41D8CD98F00B204E9800998ECF8427E  upper.gz\n"
        "ffffffffffffffffffffffffffffffff  a_sprot.xml.gz\n",
        "md5",
    )
    assert rows(rf.parse_manifest(rf.read_lines(spark, path)), "filename", "md5") == [
        ("a_sprot.xml.gz", "f" * 32), ("b.xml.gz", "0123456789abcdef0123456789abcdef"),
    ]


def test_release_dates(spark):
    df = rf.parse_release_date(texts(
        spark, "Knowledge base\nRelease 2025_09 of 08-Sep-2025\n", "Release 2025_09 of 08/09/2025", "Release  x  of 1-jan-2024",
    ))
    assert rows(df, "version", "release_date", "release_date_text") == [
        ("2025_09", None, "08/09/2025"),
        ("2025_09", date(2025, 9, 8), "08-Sep-2025"),
        ("x", date(2024, 1, 1), "1-jan-2024"),
    ]
    other = texts(spark, "This is not the data you are looking for")
    with pytest.raises(Exception, match="no release version"):
        rf.parse_release_date(other).collect()
    assert rows(rf.parse_release_date(other, strict=False), "version") == [(None,)]


def test_release_counts(spark):
    df = rf.parse_release_counts(texts(
        spark, "KB/Swiss-Prot:  1,234 entries and KB/TrEMBL: 5,678,901 entries", "Invalid format",
    ))
    assert rows(df, "swissprot_entry_count", "trembl_entry_count") == [(0, 0), (1234, 5678901)]


def test_catalog_over_folders(spark, write):
    for n in (1, 2):
        write(f"Release 2025_0{n} of 0{n}-Sep-2025", "reldate.txt", f"2025_0{n}")
    notes = write("Swiss-Prot: 7 entries and TrEMBL: 8 entries", "relnotes.txt", "2025_01")
    base = notes.rsplit("/", 2)[0]
    df = rf.release_catalog(rf.read_texts(spark, f"{base}/*/reldate.txt"), rf.read_texts(spark, f"{base}/*/relnotes.txt"))
    assert rows(df, "release", "version", "swissprot_entry_count", "trembl_entry_count") == [
        ("2025_01", "2025_01", 7, 8), ("2025_02", "2025_02", 0, 0),
    ]


@pytest.mark.parametrize("whole_file_bytes", [1 << 30, 4])
def test_checksums(spark, tmp_path, monkeypatch, whole_file_bytes):
    monkeypatch.setattr(rf, "_WHOLE_FILE_BYTES", whole_file_bytes)
    for name, data in {"a.gz": b"alpha", "b.gz": b"beta", "c.gz": b"x"}.items():
        (tmp_path / name).write_bytes(data)
    files = rf.file_checksums(spark, str(tmp_path))
    assert rows(files, "filename", "md5") == sorted((n, hashlib.md5((tmp_path / n).read_bytes()).hexdigest()) for n in ("a.gz", "b.gz", "c.gz"))
    lines = spark.createDataFrame(
        [(tmp_path.name, hashlib.md5(b"alpha").hexdigest() + "  a.gz"), (tmp_path.name, "0" * 32 + "  b.gz")], "release string, value string"
    )
    assert rows(rf.verify_checksums(files, rf.parse_manifest(lines)), "filename", "status") == [
        ("a.gz", "valid"), ("b.gz", "mismatch"), ("c.gz", "unlisted"),
    ]


def test_files_are_written_by_their_names_and_listed_by_folder(spark, tmp_path):
    lines = [("r", f"f{n % 40}", n, f"é {n}" if n % 50 else None) for n in range(200)]
    lines += [("a/b", "x:[1]", 2, "two"), ("a/b", "x:[1]", 1, "one"), ("", "e", 0, "no"), (None, "e", 1, "folder"), ("r", None, 0, "n"), ("r", "", 1, "m")]
    df = spark.createDataFrame(lines, "rel string, part string, n int, value string").repartition(3)
    rf.write_files(df, f"file:{tmp_path}/out", "rel", "part", ["n"], ".gz")
    found = {f"{f.parent.name}/{f.name}": f.read_text() for f in (tmp_path / "out").glob("*/*")}
    none = "__HIVE_DEFAULT_PARTITION__"
    expected = {f"rel=r/f{k}.gz": "".join((v or "") + "\n" for _, p, _, v in lines[:200] if p == f"f{k}") for k in range(40)}
    assert found == expected | {"rel=a%2Fb/x%3A%5B1%5D.gz": "one\ntwo\n", f"rel={none}/e.gz": "no\nfolder\n", f"rel=r/{none}.gz": "n\nm\n"}

    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        files = rf.file_checksums(spark, f"{tmp_path}/out/rel=*", "*.gz")
        listing = spark.sparkContext.statusTracker().getJobIdsForGroup("listing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(listing) == 0
    # As before, a name with a leading underscore is none of the data.
    assert rows(files) == rows(rf.file_checksums(spark, f"{tmp_path}/out/rel=*/*.gz")) and files.count() == 42


def test_same_file_name_in_two_releases(spark, tmp_path):
    for release, data in (("r1", b"one"), ("r2", b"two")):
        (tmp_path / release).mkdir()
        (tmp_path / release / "a.gz").write_bytes(data)
        (tmp_path / release / "md5").write_text(hashlib.md5(data).hexdigest() + "  a.gz\n")
    files = rf.file_checksums(spark, f"{tmp_path}/*/*.gz")
    manifest = rf.parse_manifest(rf.read_lines(spark, f"{tmp_path}/*/md5"))
    assert rows(rf.verify_checksums(files, manifest)) == [("r1", "a.gz", "valid"), ("r2", "a.gz", "valid")]


def test_tsv_round_trip(spark, tmp_path):
    data = [
        ("P1", "g\t1", True), ("P2", ' "quoted" \n two\r\nlines ', False), ("P3", "", None), ("P4", None, True),
        ("P5", "back\\slash\\", None), ("P6", '"', False),
    ]
    df = spark.createDataFrame(data, TABLES["genes"].schema).coalesce(1)
    tsv.write_tsv({"genes": df}, str(tmp_path / "t"))
    back = tsv.read_tsv(spark, str(tmp_path / "t/genes"), "genes")
    assert back.schema == df.schema
    assert rows(back) == sorted(((a, b or None, c) for a, b, c in data))


def test_tsv_header_order_and_bad_values(spark, write):
    path = write("scientific_name\tlineage\tncbi_taxid\nHomo\t\t9606\n", "t.tsv.gz", "t1")
    assert rows(tsv.read_tsv(spark, path, "taxonomy")) == [(9606, "Homo", None)]
    bad = write("ncbi_taxid\tscientific_name\tlineage\nx\tHomo\t\n", "t.tsv.gz", "t2")
    with pytest.raises(Exception, match="bad value for ncbi_taxid"):
        tsv.read_tsv(spark, bad, "taxonomy").collect()


def random_table(r, n):
    signs = ["a", "B c", "\n", "\r\n", '"', '""', "\t", "é", "語", "'", "\\", "", " "]
    return [(str(i), "".join(r.choices(signs, k=r.choice([0, 1, 3, 40]))) or None, "".join(r.choices(signs, k=2)) or None) for i in range(n)]


def as_tsv(names, data, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, delimiter="\t", lineterminator=end)
    writer.writerow(names)
    writer.writerows([["" if v is None else v for v in row] for row in data])
    return out.getvalue()


@pytest.mark.parametrize("size, end", [(1 << 30, "\n"), (700, "\n"), (700, "\r\n"), (60, "\n")])
def test_tsv_records_are_those_of_a_reader_wherever_it_is_cut(spark, write, size, end):
    data = random_table(random.Random(size), 300)
    text = as_tsv(["k", "v", "w"], data, end)
    path = write(text, "t.tsv", f"s{size}{len(end)}")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    want = sorted((tuple(v or None for v in row) for row in csv.reader(io.StringIO(text, newline=""), delimiter="\t")), key=str)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "kvw"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        got = tsv.read_tsv(spark, path, schema)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(w) for w in want if w != ("k", "v", "w"))
        if size < 1000:
            assert tsv._lines(spark, path).select(F.spark_partition_id()).distinct().count() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tsv_headers_differ_by_file(spark, write):
    schema = TABLES["genes"].schema
    write(as_tsv(["protein_accession", "gene_name", "is_primary"], [("P1", "g", "True")]), "a.tsv", "h")
    write(as_tsv(["gene_name", "other", "protein_accession"], [("g2", "x", "P2"), ("a\nb", "", "P3")]), "b.tsv", "h")
    folder = write("", "empty.tsv", "h").rsplit("/", 1)[0]
    assert rows(tsv.read_tsv(spark, folder, schema)) == [("P1", "g", True), ("P2", "g2", None), ("P3", "a\nb", None)]
    with pytest.raises(ValueError, match="none of the columns"):
        tsv.read_tsv(spark, write("x\ty\n1\t2\n", "c.tsv", "other"), schema)
    with pytest.raises(ValueError, match="repeated"):
        tsv.read_tsv(spark, write("gene_name\tgene_name\n1\t2\n", "d.tsv", "twice"), schema)
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        tsv.read_tsv(spark, write("gene_name\tprotein_accession\n1\t2\t3\n", "e.tsv", "long"), schema).collect()
    assert tsv.read_tsv(spark, write("gene_name\tprotein_accession\n", "f.tsv", "head"), schema).count() == 0


def test_resolve_accession(spark):
    proteins = spark.createDataFrame([("P1",), ("P2",)], "primary_accession string")
    old = spark.createDataFrame([("P1", "S"), ("P2", "S"), ("P1", "T")], TABLES["accessions"].schema)
    wanted = spark.createDataFrame([("S",), ("P2",), ("none",), ("P2",)], "accession string")
    assert rows(lookup.resolve_accession(wanted, proteins, old)) == [
        ("P2", "P2", True), ("S", "P1", False), ("S", "P2", False),
    ]


def test_json_lookup(spark):
    blob = '[{"tag":"comment","attributes":{"type":"function"},"text":"t"},{"tag":"x"}]'
    df = spark.createDataFrame([(1, blob), (2, None), (3, '[{"tag":"comment","attributes":{"type":"y"}}]')], "k int, b string")
    b = F.col("b")

    def hits(**kw):
        return [r[0] for r in rows(df.where(lookup.json_contains(b, **kw)), "k")]

    assert hits(tag="comment") == [1, 3]
    assert hits(attributes={"type": "function"}) == [1]
    assert hits(tag="x", attributes={"type": "function"}) == []
    assert hits(text="t") == [1]
    assert rows(df.select(lookup.json_field(b, "$[0].attributes.type"))) == [(None,), ("function",), ("y",)]


def test_scratch_folder_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch_dir(spark, "x").startswith(f"{shared}/x-")
