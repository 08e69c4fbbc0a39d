"""Lookups over the published tables.

Tables opened with their bucket column (``open_snapshot(..., buckets=True)``) are pruned to the folders a lookup's hits lie
in; without it the same functions read the whole table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.json_terms import pattern_terms, tree_contains
from ..schemas import BUCKET
from ..sources.snapshots import bucket_of

NODES = "array<struct<tag:string,attributes:map<string,string>,text:string>>"
_PATTERN_KEYS = {"tag", "attributes", "text", "children", "descendants"}


def find_by_entry_name(proteins: DataFrame, names: str | list[str]) -> DataFrame:
    names = [names] if isinstance(names, str) else list(names)
    return proteins.where(F.col("entry_name").isin(names))


def proteins_of_taxon(proteins: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Proteins with the organism's columns.

    No broadcast hint: the organism table grows with the release, so Spark decides by its size. A
    tax id that owns a third of the proteins is split by the adaptive skew join.
    """
    return proteins.join(taxonomy, "ncbi_taxid")


def taxon_counts(proteins: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Entries per organism: counted per tax id before the join, so only one row per id is joined."""
    counted = proteins.where(F.col("ncbi_taxid").isNotNull()).groupBy("ncbi_taxid").agg(
        F.count(F.lit(1)).alias("n_proteins")
    )
    return counted.join(taxonomy, "ncbi_taxid").select("ncbi_taxid", "scientific_name", "lineage", "n_proteins")


def resolve_accession(wanted: DataFrame, proteins: DataFrame, accessions: DataFrame) -> DataFrame:
    """(accession, primary_accession, is_current) for a DataFrame with a column ``accession``.

    A secondary accession can lead to several primaries; unknown ones are left out.
    """
    known = proteins.select(
        F.col("primary_accession").alias("accession"), "primary_accession", F.lit(True).alias("is_current")
    ).unionByName(
        accessions.select(
            F.col("secondary_accession").alias("accession"),
            F.col("protein_accession").alias("primary_accession"),
            F.lit(False).alias("is_current"),
        )
    )
    return wanted.select("accession").distinct().join(known, "accession")


def in_buckets(wide: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows of a bucketed table that lie in the buckets of ``hits``.

    The distinct buckets are at most as many as the table has folders, which bounds the broadcast; the scan of the wide
    table is pruned by it at run time and reads no folder without a hit.
    """
    wanted = F.broadcast(hits.select(BUCKET).distinct())
    return wide.join(wanted, BUCKET, "left_semi").select(wide.columns)


def _of(proteins: DataFrame, children: DataFrame, condition: Column) -> DataFrame:
    hits = children.where(condition).withColumnRenamed("protein_accession", "primary_accession")
    if BUCKET in proteins.columns and BUCKET in children.columns:
        proteins = in_buckets(proteins, hits)
    return proteins.join(hits.select("primary_accession"), "primary_accession", "left_semi").select(proteins.columns)


def with_sequences(proteins: DataFrame, sequences: DataFrame) -> DataFrame:
    """Some proteins with their sequence, NULL if they have none; only their buckets of ``sequences`` are read."""
    if BUCKET in proteins.columns and BUCKET in sequences.columns:
        sequences = in_buckets(sequences, proteins).drop(BUCKET)
    return proteins.join(sequences, "primary_accession", "left").select(*proteins.columns, "sequence")


def find_by_accession(proteins: DataFrame, accessions: str | list[str], n_buckets: int | None = None) -> DataFrame:
    """Proteins by primary accession; with the number of buckets only the folders of their buckets are read."""
    accessions = [accessions] if isinstance(accessions, str) else list(accessions)
    found = proteins.where(F.col("primary_accession").isin(accessions))
    if n_buckets is None:
        return found
    of_one = (F.col(BUCKET) == bucket_of(F.lit(a), n_buckets) for a in accessions)
    return found.where(reduce(lambda a, b: a | b, of_one, F.lit(False)))


def find_by_gene(proteins: DataFrame, genes: DataFrame, gene_name: str, primary_only: bool = False) -> DataFrame:
    condition = F.col("gene_name") == gene_name
    return _of(proteins, genes, condition & F.col("is_primary") if primary_only else condition)


def find_by_keyword(proteins: DataFrame, keywords: DataFrame, label: str) -> DataFrame:
    return _of(proteins, keywords, F.col("keyword_label") == label)


def find_by_go(proteins: DataFrame, protein_to_go: DataFrame, go_term_id: str) -> DataFrame:
    return _of(proteins, protein_to_go, F.col("go_term_id") == go_term_id)


def json_contains(blob: Column, tag: str | None = None, attributes: dict[str, str] | None = None,
                  text: str | None = None) -> Column:
    """TRUE if a top-level element of a JSON blob has the tag, all the attributes and the text."""

    def matches(node: Column) -> Column:
        ok = F.lit(True)
        if tag is not None:
            ok = ok & node["tag"].eqNullSafe(F.lit(tag))
        for name, value in (attributes or {}).items():
            ok = ok & F.try_element_at(node["attributes"], F.lit(name)).eqNullSafe(F.lit(value))
        if text is not None:
            ok = ok & node["text"].eqNullSafe(F.lit(text))
        return ok

    return F.coalesce(F.exists(F.from_json(blob, NODES), matches), F.lit(False))


def _depth(pattern: list[dict]) -> int:
    return max((1 + _depth(p.get("children", [])) for p in pattern), default=0)


def _check_pattern(pattern: list[dict]) -> None:
    if not isinstance(pattern, list) or not all(isinstance(p, dict) and set(p) <= _PATTERN_KEYS for p in pattern):
        raise ValueError(f"a pattern is a list of nodes with keys of {sorted(_PATTERN_KEYS)}")
    for p in pattern:
        _check_pattern(p.get("children", []))
        _check_pattern(p.get("descendants", []))


def _uses_descendants(pattern: list[dict]) -> bool:
    return any(p.get("descendants") or _uses_descendants(p.get("children", [])) for p in pattern)


def _nodes_type(depth: int) -> str:
    below = f",children:{_nodes_type(depth - 1)}" if depth > 1 else ""
    return f"array<struct<tag:string,attributes:map<string,string>,text:string{below}>>"


def json_contains_tree(blob: Column, pattern: list[dict]) -> Column:
    """TRUE if a JSON blob contains a pattern of nodes, at whatever depth the pattern goes; FALSE for a NULL blob.

    Containment as for JSON documents: every node of the pattern is contained in some element of the array. A node has the
    pattern node's tag, text and all its attributes, and its children contain those of the pattern. The blob is read
    as deep as the pattern goes, by expressions alone. ``descendants`` of a pattern node may be at any depth below its
    match; that needs the whole tree and is evaluated in Arrow batches.
    """
    _check_pattern(pattern)
    if _uses_descendants(pattern):
        return F.coalesce(tree_contains(blob, pattern), F.lit(False))

    def matches(node: Column, p: dict) -> Column:
        ok = F.lit(True)
        for name in ("tag", "text"):
            if p.get(name) is not None:
                ok = ok & node[name].eqNullSafe(F.lit(p[name]))
        for name, value in p.get("attributes", {}).items():
            ok = ok & F.try_element_at(node["attributes"], F.lit(name)).eqNullSafe(F.lit(value))
        return ok & holds(node["children"], p["children"]) if p.get("children") else ok

    def holds(nodes: Column, wanted: list[dict]) -> Column:
        ok = F.lit(True)
        for p in wanted:
            ok = ok & F.coalesce(F.exists(nodes, lambda n: matches(n, p)), F.lit(False))  # noqa: B023 - called at once
        return ok

    parsed = F.from_json(blob, _nodes_type(max(1, _depth(pattern))))
    return blob.isNotNull() & holds(parsed, pattern)


def find_by_json(proteins: DataFrame, json_terms: DataFrame, column: str, pattern: list[dict]) -> DataFrame:
    """Proteins whose JSON ``column`` contains the pattern, by the containment index of a snapshot.

    The index names the proteins that have all of the pattern's terms; only their buckets are read, and what is read is
    checked against the pattern itself. Both tables need their bucket column. Patterns without a tag, attribute or text
    have no term and are not looked up.
    """
    _check_pattern(pattern)
    terms = pattern_terms(pattern)
    if not terms:
        raise ValueError("the pattern has nothing to look up")
    found = json_terms.where((F.col("blob") == column) & F.col("term").isin(terms))
    # Index rows are distinct, so a protein with all terms has as many rows.
    hits = found.groupBy(BUCKET, "primary_accession").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(terms))
    candidates = in_buckets(proteins, hits).join(hits.select("primary_accession"), "primary_accession", "left_semi")
    return candidates.where(json_contains_tree(F.col(column), pattern)).select(proteins.columns)


def json_field(blob: Column, path: str) -> Column:
    """Text at a JSON path, e.g. ``$[0].children[0].attributes.position``."""
    return F.get_json_object(blob, path)
