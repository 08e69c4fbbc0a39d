"""Entry documents to relational tables.

``parse_entry`` turns each entry into one row that holds everything the seven tables need: plain
columns for single values, arrays for repeated ones. Every table is then a projection of that row,
so no shuffle is needed to shred (only ``shred_taxonomy`` with ``distinct=True`` groups rows).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import conform, empty_to_null, first_of, flat, strict_cast
from ..functions.json_tree import BLOBS, STANDARD_COMMENT_TYPES, entry_blobs
from ..schemas import TABLES
from ..sources.entries import FILE_ORDER
from .dedup import keep_first

PROFILES = ("full", "standard")

# Gene name types that are kept, the type flagged as primary, reference types.
GENE_NAME_TYPES = ("primary", "synonym", "ordered locus")
PRIMARY = "primary"
GO = "GO"
TAXONOMY = "NCBI Taxonomy"

# Parts of the entry each table reads. Elements of which only the first counts are declared as
# arrays too, because a scalar field would take the last one.
_PARTS = {
    "accession": "array<string>",
    "name": "array<string>",
    "_created": "string",
    "_modified": "string",
    "protein": "array<struct<recommendedName:array<struct<fullName:array<string>>>>>",
    "sequence": "array<struct<_VALUE:string,_length:string,_mass:string>>",
    "organism": "array<struct<name:array<struct<_VALUE:string,_type:string>>,"
    "dbReference:array<struct<_type:string,_id:string>>,lineage:array<struct<taxon:array<string>>>>>",
    "gene": "array<struct<name:array<struct<_VALUE:string,_type:string>>>>",
    "dbReference": "array<struct<_type:string,_id:string>>",
    "keyword": "array<struct<_id:string,_VALUE:string>>",
    "comment": "array<struct<_type:string>>",
}
_NEEDS = {
    "proteins": ("name", "_created", "_modified", "protein", "sequence", "organism", "comment"),
    "sequences": ("sequence",),
    "accessions": (),
    "taxonomy": ("organism",),
    "genes": ("gene",),
    "keywords": ("keyword",),
    "protein_to_go": ("dbReference",),
}


def _occurrences(raw: Column, text: str) -> Column:
    """How often a literal occurs."""
    removed = F.replace(raw, F.lit(text), F.lit(""))
    return (F.octet_length(raw) - F.octet_length(removed)) / len(text.encode())


def _without_references(raw: Column) -> Column:
    """No character references, so literal text search sees every attribute value."""
    return ~raw.contains("&#")


def _tax_ref(raw: Column, organism: Column, sound: Column) -> Column:
    """Id of the first taxonomy reference anywhere below the first organism.

    Nearly always it is a direct child, which the struct parse has already. Only if the type name
    occurs a second time somewhere in the entry is the path evaluated on a tree of its own.
    """
    path = f'(/entry/organism[1]//dbReference[@type="{TAXONOMY}"])[1]/@id'
    direct = first_of(F.filter(organism["dbReference"], lambda r: r["_type"] == TAXONOMY))
    mentions = _occurrences(raw, TAXONOMY)
    value = (
        F.when(~raw.contains(TAXONOMY) & _without_references(raw), F.lit(None).cast("string"))
        .when((mentions == 1) & direct.isNotNull(), direct["_id"])
        .when(sound, F.xpath_string(raw, F.lit(path)))
    )
    return empty_to_null(value)


# One attribute, and the start tag of a GO reference up to its id: group 2 is the id.
_ATTRIBUTE = r"""(?:\s+[^\s=<>"']+\s*=\s*(?:"[^"<]*"|'[^'<]*'))"""
_GO_TAG = rf"""<dbReference(?={_ATTRIBUTE}*?\s+type\s*=\s*(?:"{GO}"|'{GO}')){_ATTRIBUTE}*?\s+id\s*=\s*(["'])((?:(?!\1)[^<])*+)\1"""


def _go_ids(raw: Column, references: Column, sound: Column) -> Column:
    """Ids of GO references at any depth. Direct children come from the parse. Deeper ones are found by their tags if
    nothing hidden can hold a tag and no id needs to be unescaped; only else the tree is built.

    ``sound`` keeps the tree from being built of an entry that is known to be malformed: that would end the job.
    """
    direct = F.filter(references, lambda r: r["_type"] == GO)
    quoted = (f'"{GO}"', f"'{GO}'")
    none = ~(raw.contains(quoted[0]) | raw.contains(quoted[1]))
    mentions = _occurrences(raw, quoted[0]) + _occurrences(raw, quoted[1])
    all_direct = none | (mentions == F.size(direct))
    plain = _without_references(raw)
    tagged = F.when(sound & plain & ~raw.contains("<!") & ~raw.contains("<?"), F.regexp_extract_all(raw, F.lit(_GO_TAG), F.lit(2)))
    ids = (
        F.when(plain & all_direct, F.transform(direct, lambda r: r["_id"]))
        .when(~F.exists(tagged, lambda i: i.rlike(r"[&\t\r\n]")), tagged)
        .when(sound, F.xpath(raw, F.lit(f'//dbReference[@type="{GO}"]/@id')))
    )
    return F.filter(ids, lambda i: i != "")


def _genes(gene: Column) -> Column:
    """Names of the kept types; in each gene only the first primary name is flagged."""

    def names(g: Column) -> Column:
        kept = F.filter(g["name"], lambda n: n["_type"].isin(*GENE_NAME_TYPES))
        first = F.array_position(F.transform(kept, lambda n: n["_type"]), PRIMARY)
        return F.transform(
            kept,
            lambda n, i: F.struct(
                empty_to_null(n["_VALUE"]).alias("gene_name"),
                (i + 1 == first).alias("is_primary"),
            ),
        )

    return F.flatten(F.transform(F.filter(gene, lambda g: g["name"].isNotNull()), names))


def parse_entry(
    entries: DataFrame,
    profile: str = "full",
    tables: Iterable[str] = tuple(TABLES),
    mode: str = "FAILFAST",
) -> DataFrame:
    """Raw entries (a ``raw_xml`` column) to one wide row per entry.

    Only the parts that ``tables`` need are parsed. ``profile`` decides at plan time which JSON
    blobs exist: ``standard`` has comments of three types only and never parses for the others.
    ``mode="PERMISSIVE"`` keeps malformed entries and names them in ``malformed``; the default
    fails the job. Rows without a primary accession (entries that lack one, document tails, malformed
    entries) stay here for the gates; the shredders leave them out.
    """
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, not {profile!r}")
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode must be FAILFAST or PERMISSIVE, not {mode!r}")
    tables = tuple(tables)
    parts = {"accession": _PARTS["accession"]}
    for table in tables:
        parts.update({p: _PARTS[p] for p in _NEEDS[table]})
    permissive = mode == "PERMISSIVE"
    if permissive:
        parts["_corrupt_record"] = "string"
    schema = ", ".join(f"`{name}` {kind}" for name, kind in parts.items())
    options = {"mode": mode, "ignoreSurroundingSpaces": "false"}

    raw = F.col("raw_xml")
    carried = [c for c in entries.columns if c not in ("raw_xml", "tail", "starts", "suspect", "namespaces")]
    # The parse is the output of a one-element explode, not a projected column: a filter on it (the
    # shredders', or one of the caller) then stays above it instead of being pushed down as a copy
    # that parses every entry once more.
    several = F.coalesce(F.col("starts") > 1, F.lit(False)) if "starts" in entries.columns else F.lit(False)
    if "suspect" in entries.columns:
        several = several | F.coalesce("suspect", F.lit(False))
    text = raw
    if not permissive and {"starts", "suspect"} & set(entries.columns):
        text = F.when(several, F.raise_error(F.lit("MALFORMED: not one whole entry")).cast("string")).otherwise(raw)
    parsed = F.explode(F.array(F.from_xml(text, schema, options)))
    df = entries.select(*entries.columns, parsed.alias("e"))
    e = F.col("e")
    out: dict[str, Column] = {c: F.col(c) for c in carried}
    if "tail" in entries.columns:
        out["tail"] = F.col("tail")
    if permissive:
        out.update({c: F.col(c) for c in ("starts", "suspect") if c in entries.columns})
        out["malformed"] = (raw.isNotNull() & e["_corrupt_record"].isNotNull()) | several
    sound = e["_corrupt_record"].isNull() & ~several if permissive else F.lit(True)
    accession = empty_to_null(first_of(e["accession"]))
    out["primary_accession"] = accession

    if "proteins" in tables:
        recommended = flat(e["protein"], "recommendedName")
        out["entry_name"] = empty_to_null(first_of(e["name"]))
        out["protein_name"] = empty_to_null(first_of(flat(recommended, "fullName")))
        out["sequence_length"] = empty_to_null(first_of(e["sequence"])["_length"])
        out["molecular_weight"] = empty_to_null(first_of(e["sequence"])["_mass"])
        out["created_date"] = empty_to_null(e["_created"])
        out["modified_date"] = empty_to_null(e["_modified"])
    if "proteins" in tables or "taxonomy" in tables:
        out["ncbi_taxid"] = _tax_ref(raw, first_of(e["organism"]), sound)
    if "taxonomy" in tables:
        organism = first_of(e["organism"])
        taxa = F.filter(flat(organism["lineage"], "taxon"), lambda t: t != "")
        out["scientific_name"] = empty_to_null(first_of(organism["name"])["_VALUE"])
        out["lineage"] = empty_to_null(F.array_join(taxa, " > "))
    if "sequences" in tables:
        out["sequence"] = empty_to_null(F.replace(first_of(e["sequence"])["_VALUE"], F.lit("\n"), F.lit("")))
    if "accessions" in tables:
        out["secondary"] = F.filter(
            F.slice(e["accession"], F.lit(2), F.greatest(F.size(e["accession"]), F.lit(0))),
            lambda a: a != "",
        )
    if "genes" in tables:
        out["genes"] = _genes(e["gene"])
    if "keywords" in tables:
        out["keywords"] = F.transform(
            F.filter(e["keyword"], lambda k: k["_id"] != ""),
            lambda k: F.struct(
                k["_id"].alias("keyword_id"), empty_to_null(k["_VALUE"]).alias("keyword_label")
            ),
        )
    if "protein_to_go" in tables:
        out["go_ids"] = _go_ids(raw, e["dbReference"], sound)
    if "proteins" in tables:
        declared = F.col("namespaces") if "namespaces" in entries.columns else None
        out.update(_blob_columns(raw, e["comment"], accession, profile, declared, not permissive))

    df = df.select(*(c.alias(name) for name, c in out.items()))
    if "proteins" in tables:
        null = F.lit(None).cast("string")
        made = _blobs_of(profile)
        found = {b: F.col("blobs")[b] if b in made else null for b in BLOBS}
        if permissive:
            found["malformed"] = F.col("malformed") | F.coalesce(F.col("blobs")["broken"], F.lit(False))
        df = df.withColumns(found).drop("blobs")
    return df


def _blobs_of(profile: str) -> tuple[str, ...]:
    return BLOBS if profile == "full" else ("comments_data",)


def _blob_columns(
    raw: Column, comment: Column, accession: Column, profile: str, namespaces: Column | None, strict: bool
) -> dict[str, Column]:
    # Entries that cannot yield a blob are not sent to Python.
    wanted = accession.isNotNull()
    if profile == "standard":
        wanted = wanted & F.exists(comment, lambda c: c["_type"].isin(*STANDARD_COMMENT_TYPES))
    else:
        wanted = wanted & raw.rlike("<(comment|feature|dbReference|evidence)")
    return {"blobs": entry_blobs(F.when(wanted, raw), profile, _blobs_of(profile), namespaces, strict)}


def _entries(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("primary_accession").isNotNull())


def shred_proteins(parsed: DataFrame) -> DataFrame:
    """One row per entry; text becomes INTEGER / DATE here, bad text fails the job."""
    return conform(_entries(parsed), TABLES["proteins"].schema)


def shred_sequences(parsed: DataFrame) -> DataFrame:
    return _entries(parsed).where(F.col("sequence").isNotNull()).select("primary_accession", "sequence")


def shred_accessions(parsed: DataFrame) -> DataFrame:
    return _entries(parsed).select(
        F.col("primary_accession").alias("protein_accession"),
        F.explode("secondary").alias("secondary_accession"),
    )


def shred_taxonomy(parsed: DataFrame, distinct: bool = True) -> DataFrame:
    """Organisms; with ``distinct`` the first one in file order per tax id."""
    rows = _entries(parsed).where(F.col("ncbi_taxid").isNotNull()).select(
        strict_cast(F.col("ncbi_taxid"), T.IntegerType(), "ncbi_taxid").alias("ncbi_taxid"),
        "scientific_name",
        "lineage",
        *(c for c in FILE_ORDER if c in parsed.columns),
    )
    if not distinct:
        return rows.select(*TABLES["taxonomy"].columns)
    order = [c for c in FILE_ORDER if c in parsed.columns]
    return keep_first(rows, ["ncbi_taxid"], order).select(*TABLES["taxonomy"].columns)


def shred_genes(parsed: DataFrame) -> DataFrame:
    return _entries(parsed).select(F.col("primary_accession").alias("protein_accession"), F.inline("genes"))


def shred_keywords(parsed: DataFrame) -> DataFrame:
    return _entries(parsed).select(F.col("primary_accession").alias("protein_accession"), F.inline("keywords"))


def shred_go(parsed: DataFrame) -> DataFrame:
    return _entries(parsed).select(
        F.col("primary_accession").alias("protein_accession"), F.explode("go_ids").alias("go_term_id")
    )


SHREDDERS = {
    "taxonomy": shred_taxonomy,
    "proteins": shred_proteins,
    "sequences": shred_sequences,
    "accessions": shred_accessions,
    "genes": shred_genes,
    "keywords": shred_keywords,
    "protein_to_go": shred_go,
}


def shred(parsed: DataFrame, tables: Iterable[str] = tuple(TABLES)) -> dict[str, DataFrame]:
    """All tables of parsed entries, as DataFrames by name."""
    return {t: SHREDDERS[t](parsed) for t in tables}


def distinct_in_entry(parsed: DataFrame) -> DataFrame:
    """Keep the first of names, keywords and ids that are repeated inside one entry.

    Keys of the child tables start with the accession, so this row-local step makes them unique.
    """

    def first_by(array: str, field: str) -> Column:
        keys = F.transform(array, lambda s: s[field])
        return F.filter(array, lambda s, i: F.array_position(keys, s[field]) == i + 1)

    return parsed.withColumns(
        {
            "secondary": F.array_distinct("secondary"),
            "genes": first_by("genes", "gene_name"),
            "keywords": first_by("keywords", "keyword_id"),
            "go_ids": F.array_distinct("go_ids"),
        }
    )
