import gzip
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<kb xmlns="http://example.org/kb">'
TAIL = "</kb>\n"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="module")
def codegen(spark):
    """The plans users get: most modules run without whole-stage code to save compile time."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


def entry(
    accession="P1", *, name="NAME1", full_name="Protein 1", taxid="9301", organism="Rana lucis",
    lineage=("Amphibia", "Anura"), sequence="MTEST", length="5", mass="10", secondary=(), genes=(), go=(),
    keywords=(), created="2003-04-11", modified="2022-09-23", extra="",
):
    """One entry as text; parts given as None are left out."""
    out = [f'<entry dataset="d" created="{created}" modified="{modified}" version="1">']
    if accession is not None:
        out.append(f"<accession>{accession}</accession>")
    out += [f"<accession>{s}</accession>" for s in secondary]
    if name is not None:
        out.append(f"<name>{name}</name>")
    if full_name is not None:
        out.append(f"<protein><recommendedName><fullName>{full_name}</fullName></recommendedName></protein>")
    for names in genes:
        out.append("<gene>" + "".join(f'<name type="{t}">{n}</name>' for t, n in names) + "</gene>")
    if taxid is not None:
        taxa = "".join(f"<taxon>{t}</taxon>" for t in lineage)
        out.append(
            f'<organism><name type="scientific">{organism}</name><name type="common">x</name>'
            f'<dbReference type="NCBI Taxonomy" id="{taxid}"/><lineage>{taxa}</lineage></organism>'
        )
    out += [f'<dbReference type="GO" id="{g}"/>' for g in go]
    out += [f'<keyword id="{i}">{label}</keyword>' for i, label in keywords]
    out.append(extra)
    if sequence is not None:
        out.append(f'<sequence length="{length}" mass="{mass}" checksum="C">{sequence}</sequence>')
    return "".join(out) + "</entry>"


def document(*entries):
    return HEAD + "\n".join(entries) + TAIL


RELEASE_1 = document(
    entry(
        "W7AB01", name="LAMP_FROG", full_name="Lamp oil carrier", sequence="\nMKLLA\nVWGGH\n", length="10", mass="1307",
        secondary=["V3XY09"], genes=[[("primary", "LMP")]], go=["GO:0990017"],
        keywords=[("KX-0042", "Oil binding")],
    ),
    entry(
        "W7CD02", name="DOOR_TOAD", full_name="Door hinge factor", taxid="10871", organism="Bufo portae",
        sequence="MRRNDQEYYPSF", length="12", mass="1588", created="2012-01-05", modified="2023-02-14",
    ),
)


@pytest.fixture
def write(tmp_path):
    def _write(text, name="release.xml", folder=None):
        base = tmp_path / (folder or "in")
        base.mkdir(exist_ok=True)
        path = base / name
        if name.endswith(".gz"):
            with gzip.open(path, "wt", encoding="utf-8") as f:
                f.write(text)
        else:
            path.write_text(text, encoding="utf-8")
        return str(path)

    return _write


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
