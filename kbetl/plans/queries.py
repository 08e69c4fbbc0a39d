"""The registered queries: every operator over the given tables.

``part`` and ``documents`` rows are rendered as entry documents (see ``sources.star_entries``); the
release delta runs on two releases made of ``orders``, ``lineitem`` and ``customer``. Every row of
those tables is in at least one of the two releases.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import BLOBS, valid_json
from ..operators import compare, delta, lookup, quality, shred as sh
from ..operators.dedup import duplicates_removed, keep_first
from ..session import materialize, scratch_dir
from ..sources import entries as scan, release_files, snapshots, tsv
from ..sources.star_entries import (
    XML_HEAD,
    XML_TAIL,
    as_fragments,
    document_entries,
    document_xml,
    part_entries,
    part_xml,
    read_table,
    spread_table,
    write_documents,
)
from .load import run_load

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


# ---------------------------------------------------------------- entries


def part_fragments(spark: SparkSession, sf: str) -> DataFrame:
    return as_fragments(part_entries(spread_table(spark, sf, "part", "p_partkey")), "part", 0)


def document_fragments(spark: SparkSession, sf: str, escape: bool = True) -> DataFrame:
    docs = spread_table(spark, sf, "documents", "doc_id")
    return as_fragments(document_entries(docs, escape), "documents", 1)


def fragments(spark: SparkSession, sf: str) -> DataFrame:
    return part_fragments(spark, sf).unionByName(document_fragments(spark, sf))


def parsed(spark: SparkSession, sf: str, *tables: str, profile: str = "full") -> DataFrame:
    return sh.parse_entry(fragments(spark, sf), profile, tables)


def documents_on_disk(spark: SparkSession, sf: str) -> dict[str, str]:
    """Both datasets written as documents: parts plain (splittable), texts gzipped."""
    base = scratch_dir(spark, "documents")
    write_documents(read_table(spark, sf, "part"), f"{base}/part", 5_000, key="p_partkey", raw_xml=part_xml())
    write_documents(read_table(spark, sf, "documents"), f"{base}/documents", 1_000, gzip=True, key="doc_id", raw_xml=document_xml())
    return {"part": f"{base}/part", "documents": f"{base}/documents"}


_RELATIONAL = [c for c in sh.TABLES["proteins"].columns if not c.endswith("_data")]


@query
def scan_entries_count(spark: SparkSession, sf: str) -> DataFrame:
    sources = documents_on_disk(spark, sf)
    return scan.entry_count(scan.dataset_union(spark, sources, scan.scan_entries))


@query
def scan_then_shred_genes(spark: SparkSession, sf: str) -> DataFrame:
    raw = scan.dataset_union(spark, documents_on_disk(spark, sf))
    return sh.shred_genes(sh.parse_entry(raw, tables=["genes"]))


@query
def scan_commented_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as written documents whose comments hold an entry's close tag in a section; every third entry stands in a
    comment twice more."""
    docs = spread_table(spark, sf, "documents", "doc_id")
    raw = F.replace(document_xml(), F.lit("</text></comment>"), F.lit("<![CDATA[ </entry>]]></text></comment>"))
    repeated = F.concat(raw, F.lit("\n<!-- "), raw, raw, F.lit(" -->"))
    path = scratch_dir(spark, "commented")
    write_documents(docs, path, 1_000, key="doc_id", raw_xml=F.when(F.col("doc_id") % 3 == 0, repeated).otherwise(raw))
    proteins = sh.shred_proteins(sh.parse_entry(scan.dataset_union(spark, {"documents": path}), "full", ["proteins"]))
    text = lookup.json_field(F.col("comments_data"), "$[0].children[0].text")
    return proteins.select("primary_accession", text.alias("comment_text"))


@query
def dataset_union_counts(spark: SparkSession, sf: str) -> DataFrame:
    return scan.entry_count(fragments(spark, sf))


@query
def shred_proteins(spark: SparkSession, sf: str) -> DataFrame:
    return sh.shred_proteins(parsed(spark, sf, "proteins", profile="standard")).select(*_RELATIONAL)


@query
def shred_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return sh.shred_sequences(parsed(spark, sf, "sequences"))


@query
def shred_accessions(spark: SparkSession, sf: str) -> DataFrame:
    return sh.shred_accessions(parsed(spark, sf, "accessions"))


@query
def shred_taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    return sh.shred_taxonomy(parsed(spark, sf, "taxonomy"))


@query
def shred_genes(spark: SparkSession, sf: str) -> DataFrame:
    return sh.shred_genes(parsed(spark, sf, "genes"))


@query
def shred_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return sh.shred_keywords(parsed(spark, sf, "keywords"))


@query
def shred_go(spark: SparkSession, sf: str) -> DataFrame:
    return sh.shred_go(parsed(spark, sf, "protein_to_go"))


def _comment_fields(proteins: DataFrame, *more: Column) -> DataFrame:
    c = F.col("comments_data")
    return proteins.select(
        "primary_accession",
        lookup.json_field(c, "$[0].attributes.type").alias("comment_type"),
        lookup.json_field(c, "$[0].children[0].text").alias("comment_text"),
        lookup.json_field(c, "$[0].children[1].attributes.id").alias("nested_id"),
        *more,
    )


@query
def json_tree_comments_full(spark: SparkSession, sf: str) -> DataFrame:
    return _comment_fields(sh.shred_proteins(parsed(spark, sf, "proteins")))


@query
def json_tree_comments_standard(spark: SparkSession, sf: str) -> DataFrame:
    proteins = sh.shred_proteins(parsed(spark, sf, "proteins", profile="standard"))
    missing = F.col("features_data").isNull() & F.col("db_references_data").isNull() & F.col("evidence_data").isNull()
    return _comment_fields(proteins, missing.alias("others_missing"))


@query
def json_tree_prefixed(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as written documents with a prefixed attribute whose prefix the root declares."""
    docs = spread_table(spark, sf, "documents", "doc_id")
    prefixed = F.regexp_replace(document_xml(), '<comment type="', '<comment x:kind="text" type="')
    path = scratch_dir(spark, "prefixed")
    head = XML_HEAD.replace(" xmlns=", ' xmlns:x="http://example.org/x" xmlns=')
    write_documents(docs, path, 1_000, head=head, key="doc_id", raw_xml=prefixed)
    raw = scan.dataset_union(spark, {"documents": path})
    proteins = sh.shred_proteins(sh.parse_entry(raw, "full", ["proteins"]))
    kind = lookup.json_field(F.col("comments_data"), "$[0].attributes['{http://example.org/x}kind']")
    return proteins.select("primary_accession", kind.alias("kind"))


@query
def json_tree_features(spark: SparkSession, sf: str) -> DataFrame:
    f, e = F.col("features_data"), F.col("evidence_data")
    return sh.shred_proteins(parsed(spark, sf, "proteins")).select(
        "primary_accession",
        lookup.json_field(f, "$[0].attributes.description").alias("description"),
        lookup.json_field(f, "$[0].children[0].children[0].attributes.position").alias("position"),
        lookup.json_field(e, "$[0].attributes.type").alias("evidence_type"),
        lookup.json_field(e, "$[0].children[0].text").alias("evidence_source"),
    )


@query
def json_tree_db_references(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("db_references_data")
    return sh.shred_proteins(parsed(spark, sf, "proteins")).select(
        "primary_accession",
        F.json_array_length(r).cast("int").alias("n_references"),
        lookup.json_field(r, "$[0].attributes.id").alias("reference_id"),
        lookup.json_field(r, "$[0].children[0].attributes.value").alias("property_value"),
    )


# ---------------------------------------------------------------- quality


@query
def malformed_entries(spark: SparkSession, sf: str) -> DataFrame:
    raw = document_fragments(spark, sf, escape=False)
    p = sh.parse_entry(raw, tables=["accessions"], mode="PERMISSIVE")
    return p.select(F.col("ord").alias("doc_id"), "malformed")


@query
def incomplete_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Texts written as documents of up to 50 entries; every third document ends in the middle of its root's close tag."""
    path = scratch_dir(spark, "cut")
    cut = F.when(F.col("doc") % 3 == 0, XML_TAIL.rstrip()[:-3]).otherwise(XML_TAIL)
    write_documents(spread_table(spark, sf, "documents", "doc_id"), path, 50, tail=cut, key="doc_id", raw_xml=document_xml())
    found = scan.incomplete_documents(scan.scan_fragments(spark, path, "documents"))
    number = F.regexp_extract("file", r"/doc=(\d+)/", 1).cast("bigint")
    return found.select("dataset", number.alias("document"), "closed_tails")


@query
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def null_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_keys(release(spark, sf)["stage"]["proteins"], ["acc", "uid"])


@query
def length_violations(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return quality.length_violations(docs, ["doc_id"], {"text": 4000, "source": 4})


@query
def json_validity(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties, cut off for errors."""
    events = read_table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.rtrim("props", F.lit("}"))).otherwise(F.col("props")).alias("props"),
    )
    return quality.invalid_json(events, ["event_id"], ["props"])


@query
def json_tree_validity(spark: SparkSession, sf: str) -> DataFrame:
    """Number of blobs per entry that are no JSON: none."""
    proteins = sh.shred_proteins(parsed(spark, sf, "proteins"))
    blobs = sh.TABLES["proteins"].json_columns
    invalid = sum((F.when(valid_json(F.col(b)), 0).otherwise(1) for b in blobs), F.lit(0))
    return proteins.select("primary_accession", invalid.alias("n_invalid"))


@query
def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    orders = release(spark, sf)["prod"]["proteins"]
    return quality.fk_orphans(read_table(spark, sf, "lineitem"), orders, ["l_orderkey"], ["acc"])


@query
def entry_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of documents whose names are the whole text: too long for their columns."""
    docs = spread_table(spark, sf, "documents", "doc_id").withColumn("source", F.col("text"))
    p = sh.parse_entry(as_fragments(document_entries(docs), "documents"), "standard")
    return quality.entry_violations(p)


@query
def dedup_keep_first_part(spark: SparkSession, sf: str) -> DataFrame:
    part = read_table(spark, sf, "part").select("p_size", "p_partkey", "p_name", "p_type")
    return keep_first(part, ["p_size"], ["p_partkey"])


@query
def dedup_keep_first_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    return keep_first(lines, ["l_orderkey", "l_linenumber"], order)


@query
def dedup_counts(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates_removed(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def verify_checksums(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as files, one folder a language, whose names repeat in all folders; the manifests miss German files
    and are wrong for one source."""
    path = scratch_dir(spark, "release-files")
    docs = read_table(spark, sf, "documents").select(
        "lang", F.concat("source", F.lit("-"), F.floor(F.col("doc_id") / 5_000)).alias("part"), "doc_id", F.col("text").alias("value")
    )
    release_files.write_files(docs, path, "lang", "part", ["doc_id"], ".gz")
    files = release_files.file_checksums(spark, f"{path}/lang=*", "*.gz")
    content = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "value"))), lambda x: x["value"]), "\n")
    wrong = F.when(F.col("part").startswith("src1-"), "!").otherwise("\n")
    listed = docs.where(F.col("lang") != "de").groupBy("lang", "part").agg(content.alias("content")).select(
        F.concat(F.lit("lang="), F.col("lang")).alias("release"),
        F.lit(0).alias("ord"),
        F.concat(F.md5(F.concat("content", wrong)), F.lit("  "), F.col("part"), F.lit(".gz")).alias("value"),
    )
    return release_files.verify_checksums(files, release_files.parse_manifest(listed))


# ---------------------------------------------------------------- delta

DELTA = delta.DeltaPlan(
    key="acc",
    natural_key="uid",
    kept_on_update=("nm",),
    attachments={"sequences": "seq"},
    children={"children": ("acc", "ln")},
    dimensions={"taxonomy": "taxid"},
)


def release(spark: SparkSession, sf: str) -> dict[str, dict[str, DataFrame]]:
    """Live tables and the next release.

    Live: orders of status F and O. Next: all but the live ones of low priority. In the next release
    urgent open orders have another key, high-priority open ones another natural key, and finished
    ones without a priority have no natural key (in both releases).
    """
    orders = read_table(spark, sf, "orders")
    lines = (
        read_table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_returnflag").alias("flag"))
    )
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    unnamed = (status == "F") & (priority == "4-NOT SPECIFIED")
    natural = F.when(~unnamed, key)
    live = orders.where(status.isin("F", "O"))
    staged = orders.where((status == "P") | (priority != "5-LOW"))

    new_key = F.when((status == "O") & (priority == "1-URGENT"), -key - 1).otherwise(key)
    new_natural = F.when((status == "O") & (priority == "2-HIGH"), -key - 1).otherwise(natural)
    # Lines that only one release can have are in it whatever their flag.
    live_children = (
        live.select(key.alias("l_orderkey"), (priority == "5-LOW").alias("alone"))
        .join(lines, "l_orderkey")
        .where((F.col("flag") != "N") | F.col("alone"))
    )
    staged_children = (
        staged.select(key.alias("l_orderkey"), new_key.alias("acc"), (status == "P").alias("alone"))
        .join(lines, "l_orderkey")
        .where((F.col("flag") != "R") | F.col("alone"))
    )
    customer = read_table(spark, sf, "customer")
    return {
        "prod": {
            "proteins": live.select(
                key.alias("acc"), natural.alias("uid"), status.alias("nm"), F.col("o_totalprice").alias("v")
            ),
            "sequences": live.select(key.alias("acc"), priority.alias("seq")),
            "children": live_children.select(
                F.col("l_orderkey").alias("acc"), F.col("l_linenumber").alias("ln"), "flag"
            ),
            "taxonomy": customer.where(F.col("c_acctbal") < 5000).select(
                F.col("c_custkey").alias("taxid"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("lineage")
            ),
        },
        "stage": {
            "proteins": staged.select(
                new_key.alias("acc"), new_natural.alias("uid"), F.lit("new").alias("nm"),
                (F.col("o_totalprice") + 1).alias("v"),
            ),
            "sequences": staged.where(status != "F").select(
                new_key.alias("acc"), F.concat(F.lit("next-"), priority).alias("seq")
            ),
            "children": staged_children.select("acc", F.col("l_linenumber").alias("ln"), F.lit("Z").alias("flag")),
            "taxonomy": customer.where(F.col("c_acctbal") >= 2000).select(
                F.col("c_custkey").alias("taxid"),
                F.concat(F.lit("next-"), F.col("c_name")).alias("name"),
                F.col("c_mktsegment").alias("lineage"),
            ),
        },
    }


def _parents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r = release(spark, sf)
    return r["prod"]["proteins"], r["stage"]["proteins"]


def _written_children(spark: SparkSession, sf: str) -> dict[str, dict[str, DataFrame]]:
    """Both releases with their children as written tables, as a load has them."""
    r = release(spark, sf)
    return {
        side: tables | {"children": materialize(tables["children"], scratch_dir(spark, "children"))} for side, tables in r.items()
    }


def _merged(spark: SparkSession, sf: str, table: str, **options) -> DataFrame:
    """One table of the merge, on the path a load takes: small key sets are written."""
    r = _written_children(spark, sf) if table == "children" else release(spark, sf)
    return delta.apply_delta(r["prod"], r["stage"], DELTA, work_dir=scratch_dir(spark, "merge"), only=[table], **options)[table]


@query
def delta_changed_keys(spark: SparkSession, sf: str) -> DataFrame:
    return delta.changed_keys(*_parents(spark, sf), "uid", "acc")


@query
def delta_removed_keys(spark: SparkSession, sf: str) -> DataFrame:
    return delta.removed_keys(*_parents(spark, sf), "uid", "acc")


@query
def delta_rekey_delete(spark: SparkSession, sf: str) -> DataFrame:
    return delta.rekey_delete(*_parents(spark, sf), "uid", "acc")


@query
def delta_classify(spark: SparkSession, sf: str) -> DataFrame:
    return delta.classify_changes(*_parents(spark, sf), "uid", "acc")


@query
def delta_report(spark: SparkSession, sf: str) -> DataFrame:
    return delta.delta_report(*_parents(spark, sf), "uid", "acc")


@query
def delta_proteins(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "proteins")


@query
def delta_proteins_scoped(spark: SparkSession, sf: str) -> DataFrame:
    """Only live orders of status F belong to the release, others are not removed."""
    return _merged(spark, sf, "proteins", scope=F.col("nm") == "F")


@query
def delta_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "sequences")


@query
def delta_children(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "children")


@query
def delta_children_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "children", refresh_payload=True)


@query
def delta_taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "taxonomy")


@query
def upsert_partial(spark: SparkSession, sf: str) -> DataFrame:
    prod, stage = _parents(spark, sf)
    return delta.upsert(prod, stage, ["acc"], ["uid", "v"])


@query
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    r = release(spark, sf)
    return delta.insert_ignore(r["prod"]["children"], r["stage"]["children"], ["acc", "ln"])


@query
def sync_children(spark: SparkSession, sf: str) -> DataFrame:
    r = release(spark, sf)
    return delta.sync_children(
        r["prod"]["children"], r["stage"]["children"], r["stage"]["proteins"].select("acc"), ["acc", "ln"]
    )


@query
def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    r = release(spark, sf)
    keys = delta.changed_keys(*_parents(spark, sf), "uid", "acc")
    return delta.cascade_delete({"children": r["prod"]["children"]}, keys, {"children": "acc"})["children"]


@query
def delete_removed(spark: SparkSession, sf: str) -> DataFrame:
    r = release(spark, sf)
    return delta.delete_removed(r["prod"], r["stage"]["proteins"], DELTA)["children"]


# ---------------------------------------------------------------- release texts and bookkeeping


def _release_notes(spark: SparkSession, sf: str) -> DataFrame:
    """A pair of release texts per order; finished orders have another date format, orders without
    a priority no counts."""
    orders = read_table(spark, sf, "orders")
    d = F.col("o_orderdate")
    shown = F.when(F.col("o_orderstatus") == "F", F.date_format(d, "dd/MM/yyyy")).otherwise(
        F.date_format(d, "dd-MMM-yyyy")
    )
    counts = F.concat(
        F.lit("This release has Swiss-Prot: "),
        F.format_number(F.col("o_custkey") + 1000, 0),
        F.lit(" entries and TrEMBL: "),
        F.format_number(F.col("o_orderkey") + 1000000, 0),
        F.lit(" entries."),
    )
    return orders.select(
        F.col("o_orderkey").cast("string").alias("release"),
        F.concat(F.lit("Knowledge base\nRelease "), F.date_format(d, "yyyy_MM"), F.lit(" of "), shown, F.lit("\nend"))
        .alias("reldate"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Invalid format").otherwise(counts).alias("relnotes"),
    )


@query
def release_date(spark: SparkSession, sf: str) -> DataFrame:
    texts = _release_notes(spark, sf).select("release", F.col("reldate").alias("value"))
    return release_files.parse_release_date(texts).drop("value")


@query
def release_counts(spark: SparkSession, sf: str) -> DataFrame:
    texts = _release_notes(spark, sf).select("release", F.col("relnotes").alias("value"))
    return release_files.parse_release_counts(texts).drop("value")


@query
def release_catalog(spark: SparkSession, sf: str) -> DataFrame:
    texts = _release_notes(spark, sf)
    return release_files.release_catalog(
        texts.select("release", F.col("reldate").alias("value")),
        texts.select("release", F.col("relnotes").alias("value")),
    )


@query
def manifest_parse(spark: SparkSession, sf: str) -> DataFrame:
    """A checksum line per part; promotional parts are listed without the file ending and ignored."""
    part = read_table(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    line = F.concat(
        F.md5(F.concat("p_name", key)),
        F.lit("  "),
        F.concat(F.lit("part-"), key, F.when(F.col("p_type") == "PROMO", ".txt").otherwise(".xml.gz")),
    )
    return release_files.parse_manifest(part.select(F.col("p_partkey").alias("ord"), line.alias("value"))).drop("release")


@query
def latest_release(spark: SparkSession, sf: str) -> DataFrame:
    loads = read_table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy_MM").alias("version"), F.col("o_orderdate").alias("load_timestamp")
    )
    return snapshots.latest_version(loads).select("version")


@query
def history_in_order(spark: SparkSession, sf: str) -> DataFrame:
    runs = read_table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("COMPLETED").alias("status"),
        F.col("ts").alias("start_time"),
    )
    return snapshots.ordered_history(runs)


@query
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Entries declared by the row counts of both tables against entries that can be parsed."""
    declared = (
        read_table(spark, sf, "part").agg(F.count(F.lit(1)).alias("n_entries")).withColumn("dataset", F.lit("part"))
    ).unionByName(
        read_table(spark, sf, "documents")
        .agg(F.count(F.lit(1)).alias("n_entries"))
        .withColumn("dataset", F.lit("documents"))
    )
    raw = part_fragments(spark, sf).unionByName(document_fragments(spark, sf, escape=False))
    p = sh.parse_entry(raw, tables=["accessions"], mode="PERMISSIVE")
    return compare.reconcile_counts(declared, p.where(~F.col("malformed")))


# ---------------------------------------------------------------- lookups


def _tables(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    """Tables of one written parse. The lookups here do not read JSON, so no blob is made."""
    wide = parsed(spark, sf, *names, profile="standard").drop(*BLOBS)
    staged = materialize(wide, scratch_dir(spark, "parsed"))
    staged = staged.withColumns({b: F.lit(None).cast("string") for b in BLOBS})
    return [sh.SHREDDERS[n](staged) for n in names]


def _id_and_name(proteins: DataFrame) -> DataFrame:
    return proteins.select("primary_accession", "entry_name")


@query
def lookup_entry_name(spark: SparkSession, sf: str) -> DataFrame:
    (proteins,) = _tables(spark, sf, "proteins")
    return lookup.find_by_entry_name(proteins, ["ID_7", "DOC_11"]).select("primary_accession", "entry_name", "protein_name")


@query
def proteins_of_taxon(spark: SparkSession, sf: str) -> DataFrame:
    joined = lookup.proteins_of_taxon(*_tables(spark, sf, "proteins", "taxonomy"))
    return joined.select("primary_accession", "ncbi_taxid", "scientific_name", "lineage")


@query
def taxon_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.taxon_counts(*_tables(spark, sf, "proteins", "taxonomy"))


@query
def resolve_accession(spark: SparkSession, sf: str) -> DataFrame:
    wanted = read_table(spark, sf, "part").select(
        F.explode(F.array(*(F.concat(F.lit(x), F.col("p_partkey")) for x in "PSX"))).alias("accession")
    )
    return lookup.resolve_accession(wanted, *_tables(spark, sf, "proteins", "accessions"))


@query
def lookup_gene(spark: SparkSession, sf: str) -> DataFrame:
    return _id_and_name(lookup.find_by_gene(*_tables(spark, sf, "proteins", "genes"), "SMALL"))


@query
def lookup_gene_primary(spark: SparkSession, sf: str) -> DataFrame:
    return _id_and_name(lookup.find_by_gene(*_tables(spark, sf, "proteins", "genes"), "Brand#7", primary_only=True))


@query
def lookup_keyword(spark: SparkSession, sf: str) -> DataFrame:
    return _id_and_name(lookup.find_by_keyword(*_tables(spark, sf, "proteins", "keywords"), "fr"))


@query
def lookup_go(spark: SparkSession, sf: str) -> DataFrame:
    return _id_and_name(lookup.find_by_go(*_tables(spark, sf, "proteins", "protein_to_go"), "GO:N12"))


@query
def json_contains_comments(spark: SparkSession, sf: str) -> DataFrame:
    proteins = sh.shred_proteins(parsed(spark, sf, "proteins"))
    hit = lookup.json_contains(F.col("comments_data"), "comment", {"type": "function"})
    return proteins.select("primary_accession", hit.alias("has_function"))


# Patterns of the containment queries.
_GO_COMMENT = [{"tag": "comment", "attributes": {"type": "function"}, "children": [{"tag": "text"}, {"tag": "dbReference", "attributes": {"type": "GO"}}]}]
_EVIDENCE = [{"tag": "feature", "attributes": {"type": "chain"}, "children": [{"tag": "evidence", "attributes": {"type": "ECO:17"}, "children": [{"tag": "source"}]}]}]
_BELOW = [{"tag": "feature", "descendants": [{"tag": "begin", "attributes": {"position": "12"}}]}]


@query
def json_contains_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Comments with a text and a GO reference as children, features with a certain evidence, a position at any depth."""
    proteins = sh.shred_proteins(parsed(spark, sf, "proteins"))
    return proteins.select(
        "primary_accession",
        lookup.json_contains_tree(F.col("comments_data"), _GO_COMMENT).alias("has_go_comment"),
        lookup.json_contains_tree(F.col("features_data"), _EVIDENCE).alias("has_evidence"),
        lookup.json_contains_tree(F.col("features_data"), _BELOW).alias("begins_at_12"),
    )


def _published(spark: SparkSession, sf: str, **options) -> dict[str, DataFrame]:
    """Parts and texts loaded and published, opened with buckets."""
    root = scratch_dir(spark, "root")
    run_load(spark, documents_on_disk(spark, sf), root, _info("2025_01", 1), **options)
    return snapshots.open_snapshot(spark, root, buckets=True)


@query
def published_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """Lookups by gene, keyword, GO term and accession on a published snapshot, with sequence lengths."""
    t = _published(spark, sf)
    proteins, n_buckets = t["proteins"], t[snapshots.LAYOUT].first().n_buckets
    found = {
        "gene": lookup.find_by_gene(proteins, t["genes"], "Brand#7", primary_only=True),
        "keyword": lookup.find_by_keyword(proteins, t["keywords"], "fr"),
        "go": lookup.find_by_go(proteins, t["protein_to_go"], "GO:N12"),
        "accession": lookup.find_by_accession(proteins, ["P7", "D11", "none"], n_buckets),
    }
    parts = [
        lookup.with_sequences(df, t["sequences"]).select(F.lit(name).alias("lookup"), "primary_accession", "entry_name", F.length("sequence").alias("n_residues"))
        for name, df in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def published_json_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The same containment, answered by the index of a published snapshot."""
    t = _published(spark, sf, profile="full", json_index=True)
    found = {
        "go_comment": lookup.find_by_json(t["proteins"], t[snapshots.JSON_INDEX], "comments_data", _GO_COMMENT),
        "evidence": lookup.find_by_json(t["proteins"], t[snapshots.JSON_INDEX], "features_data", _EVIDENCE),
        "begin": lookup.find_by_json(t["proteins"], t[snapshots.JSON_INDEX], "features_data", _BELOW),
    }
    return reduce(DataFrame.unionByName, [_id_and_name(df).withColumn("pattern", F.lit(name)) for name, df in found.items()])


@query
def json_field_props(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select(
        "event_id", lookup.json_field(F.col("props"), "$.k").cast("bigint").alias("k")
    )


# ---------------------------------------------------------------- sinks and pipelines


@query
def tsv_roundtrip_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Empty text comes back as NULL."""
    customer = read_table(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        (F.col("c_acctbal") < 0).alias("in_debt"),
    )
    path = scratch_dir(spark, "tsv")
    tsv.write_table_tsv(customer, path)
    return tsv.read_tsv(spark, path, customer.schema)


@query
def tsv_roundtrip_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with line breaks, quotes and tabs."""
    docs = spread_table(spark, sf, "documents", "doc_id").select(
        "doc_id", F.concat(F.lit(' "'), F.col("text"), F.lit('"\t\n')).alias("text"), "lang"
    )
    path = scratch_dir(spark, "tsv")
    tsv.write_table_tsv(docs, path)
    return tsv.read_tsv(spark, path, docs.schema)


@query
def row_differences(spark: SparkSession, sf: str) -> DataFrame:
    r = _written_children(spark, sf)
    return compare.row_differences(r["prod"]["children"], r["stage"]["children"])


def _info(version: str, day: int) -> dict:
    return {
        "version": version,
        "release_date": date(2025, 9, day),
        "swissprot_entry_count": 1,
        "trembl_entry_count": 2,
    }


@query
def load_full_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Scan, parse, gates, seven tables written and published, then counted."""
    root = scratch_dir(spark, "root")
    run_load(spark, documents_on_disk(spark, sf), root, _info("2025_01", 1), profile="full")
    return compare.table_counts(snapshots.open_snapshot(spark, root))


@query
def load_release_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The metadata row after a load, declaring the row counts of the tables."""
    root = scratch_dir(spark, "root")
    info = _info("2025_01", 1) | {
        "swissprot_entry_count": read_table(spark, sf, "part").count(),
        "trembl_entry_count": read_table(spark, sf, "documents").count(),
    }
    run_load(spark, documents_on_disk(spark, sf), root, info)
    metadata = snapshots.open_snapshot(spark, root)[snapshots.METADATA]
    return metadata.drop("load_timestamp")


def _release_on_disk(spark: SparkSession, part: DataFrame) -> dict[str, str]:
    path = scratch_dir(spark, "release")
    write_documents(part, path, 5_000, key="p_partkey", raw_xml=part_xml())
    return {"part": path}


def _two_releases(spark: SparkSession, sf: str) -> str:
    """A full load of parts up to size 40, then a delta with parts from size 10, all changed."""
    root = scratch_dir(spark, "root")
    part = read_table(spark, sf, "part")
    first = _release_on_disk(spark, part.where(F.col("p_size") <= 40))
    changed = part.where(F.col("p_size") >= 10).withColumns(
        {"p_name": F.concat("p_name", F.lit(" v2")), "p_brand": F.reverse("p_brand")}
    )
    run_load(spark, first, root, _info("2025_01", 1))
    run_load(spark, _release_on_disk(spark, changed), root, _info("2025_02", 2), mode="delta")
    return root


@query
def load_delta_proteins(spark: SparkSession, sf: str) -> DataFrame:
    tables = snapshots.open_snapshot(spark, _two_releases(spark, sf))
    return tables["proteins"].join(tables["sequences"], "primary_accession", "left").select(
        "primary_accession", "entry_name", "protein_name", "sequence_length", "sequence"
    )


def _delta_table(name: str) -> Query:
    def loaded(spark: SparkSession, sf: str) -> DataFrame:
        return snapshots.open_snapshot(spark, _two_releases(spark, sf))[name]

    return loaded


for _name in ("accessions", "genes", "keywords", "protein_to_go", "taxonomy"):
    REGISTRY[f"load_delta_{_name}"] = _delta_table(_name)


@query
def load_delta_counts(spark: SparkSession, sf: str) -> DataFrame:
    return compare.table_counts(snapshots.open_snapshot(spark, _two_releases(spark, sf)))


@query
def load_delta_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What the delta did to each table, as its log row says."""
    history = snapshots.load_history(spark, _two_releases(spark, sf))
    return snapshots.row_counts(history.where("mode = 'delta'")).drop("run_id", "mode")


@query
def load_bookkeeping(spark: SparkSession, sf: str) -> DataFrame:
    """The log of a root: empty tables, a full load with declared counts, the same version again (no run), an older one
    (refused), and a load that lacks entries (refused)."""
    root = scratch_dir(spark, "root")
    part = read_table(spark, sf, "part")
    snapshots.ensure_tables(spark, root)
    release_1 = _release_on_disk(spark, part)
    run_load(spark, release_1, root, _info("2025_02", 1), declared={"part": part.count()})
    run_load(spark, release_1, root, _info("2025_02", 1), mode="delta")
    for version, sources, declared in (
        ("2025_01", release_1, None),
        ("2025_03", _release_on_disk(spark, part.where(F.col("p_size") <= 40)), {"part": part.count()}),
    ):
        try:
            run_load(spark, sources, root, _info(version, 2), mode="delta", declared=declared)
        except ValueError:
            pass
    history = snapshots.load_history(spark, root)
    counts = F.element_at("entry_counts", 1)
    return history.select(
        "status", "mode", "dataset", counts["n_declared"].alias("n_declared"), counts["n_loaded"].alias("n_loaded"),
        F.element_at(F.filter("row_counts", lambda t: t["table_name"] == "genes"), 1)["inserted"].alias("genes_inserted"),
    )


@query
def snapshot_of_version(spark: SparkSession, sf: str) -> DataFrame:
    """Two releases, the first published again: both are read by their version."""
    root = _two_releases(spark, sf)
    first = snapshots.resolve_generation(spark, root, version="2025_01")
    snapshots.publish(spark, root, first, "rollback")
    counts = [
        compare.table_counts(snapshots.open_snapshot(spark, root, version=v)).withColumn("version", F.lit(v)) for v in ("2025_01", "2025_02")
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def releases_live_at(spark: SparkSession, sf: str) -> DataFrame:
    """Which release each event falls into, if one were published at the time of every tenth order: an as-of join."""
    seq = F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey"))
    orders = read_table(spark, sf, "orders").where("o_orderkey % 1000 = 0").select("o_orderdate", "o_orderkey", seq.cast("long").alias("seq"))
    catalog = orders.select(
        "seq", F.date_format("o_orderdate", "yyyy_MM").alias("version"), F.col("o_orderdate").alias("published_at"),
        F.lead("o_orderdate").over(Window.orderBy("seq")).alias("replaced_at"),
    )
    events = read_table(spark, sf, "events").select("event_id", F.col("ts").alias("at"))
    return snapshots.live_at(events, catalog).select("event_id", "seq", "version")


@query
def load_rollback_counts(spark: SparkSession, sf: str) -> DataFrame:
    """After two releases the first one is published again."""
    root = _two_releases(spark, sf)
    first = snapshots.publications(spark, root).orderBy("seq").first().generation
    snapshots.publish(spark, root, first, "rollback")
    return compare.table_counts(snapshots.open_snapshot(spark, root))
