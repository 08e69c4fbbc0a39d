"""Fixed table layouts: columns, types, keys, references and text limits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Table:
    """One output table. ``references`` maps own columns to (table, columns)."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    references: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    json_columns: tuple[str, ...] = ()
    # Column a lookup filters on; narrow tables are clustered by it when written.
    lookup: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def payload(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]


# Table names, columns, declared types, keys and VARCHAR limits.
TAXONOMY = Table(
    "taxonomy",
    _struct("ncbi_taxid int, scientific_name string, lineage string"),
    key=("ncbi_taxid",),
    max_length={"scientific_name": 1023},
)
PROTEINS = Table(
    "proteins",
    _struct(
        "primary_accession string, entry_name string, protein_name string, ncbi_taxid int, "
        "sequence_length int, molecular_weight int, created_date date, modified_date date, "
        "comments_data string, features_data string, db_references_data string, evidence_data string"
    ),
    key=("primary_accession",),
    references=((("ncbi_taxid",), "taxonomy", ("ncbi_taxid",)),),
    max_length={"primary_accession": 255, "entry_name": 255, "protein_name": 1023},
    json_columns=("comments_data", "features_data", "db_references_data", "evidence_data"),
)
_TO_PROTEIN = (("protein_accession",), "proteins", ("primary_accession",))
SEQUENCES = Table(
    "sequences",
    _struct("primary_accession string, sequence string"),
    key=("primary_accession",),
    references=((("primary_accession",), "proteins", ("primary_accession",)),),
    max_length={"primary_accession": 255},
)
ACCESSIONS = Table(
    "accessions",
    _struct("protein_accession string, secondary_accession string"),
    key=("protein_accession", "secondary_accession"),
    references=(_TO_PROTEIN,),
    max_length={"protein_accession": 255, "secondary_accession": 255},
    lookup="secondary_accession",
)
GENES = Table(
    "genes",
    _struct("protein_accession string, gene_name string, is_primary boolean"),
    key=("protein_accession", "gene_name"),
    references=(_TO_PROTEIN,),
    max_length={"protein_accession": 255, "gene_name": 255},
    lookup="gene_name",
)
KEYWORDS = Table(
    "keywords",
    _struct("protein_accession string, keyword_id string, keyword_label string"),
    key=("protein_accession", "keyword_id"),
    references=(_TO_PROTEIN,),
    max_length={"protein_accession": 255, "keyword_id": 255, "keyword_label": 255},
    lookup="keyword_label",
)
PROTEIN_TO_GO = Table(
    "protein_to_go",
    _struct("protein_accession string, go_term_id string"),
    key=("protein_accession", "go_term_id"),
    references=(_TO_PROTEIN,),
    max_length={"protein_accession": 255, "go_term_id": 255},
    lookup="go_term_id",
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (TAXONOMY, PROTEINS, SEQUENCES, ACCESSIONS, GENES, KEYWORDS, PROTEIN_TO_GO)
}
CHILD_TABLES = ("accessions", "genes", "keywords", "protein_to_go")

RELEASE_METADATA = _struct(
    "version string, release_date date, load_timestamp timestamp, "
    "swissprot_entry_count int, trembl_entry_count int"
)
_COUNTS = ("inserted", "updated", "kept", "deleted")
ROW_COUNTS = T.StructType([T.StructField("table_name", T.StringType()), *(T.StructField(c, T.LongType()) for c in _COUNTS)])
ENTRY_COUNTS = _struct("dataset string, n_declared bigint, n_loaded bigint")
# ``row_counts`` has what a load did to each table, ``entry_counts`` the entries of each dataset.
LOAD_HISTORY = T.StructType(
    [
        *_struct(
            "run_id string, status string, mode string, dataset string, start_time timestamp, "
            "end_time timestamp, error_message string, generation string"
        ),
        T.StructField("row_counts", T.ArrayType(ROW_COUNTS)),
        T.StructField("entry_counts", T.ArrayType(ENTRY_COUNTS)),
    ]
)
# One entry per publication; the one with the largest ``seq`` names the live generation.
PUBLICATIONS = _struct("seq bigint, generation string, mode string, published_at timestamp")

# Rows of these tables lie in a folder per hash bucket of their key; child rows carry the bucket of their protein.
BUCKET = "bucket"
BUCKETED = ("proteins", "sequences")
# The containment index over JSON columns.
JSON_TERMS = _struct("blob string, term bigint, primary_accession string, bucket int")
