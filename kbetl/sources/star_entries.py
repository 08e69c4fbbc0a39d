"""Star-schema tables rendered as entry documents.

The given tables hold no documents, so the queries and the benchmark derive them: every ``part``
row becomes a small entry with all kinds of parts, every ``documents`` row an entry that carries
the whole text. The rendering is a Spark projection and grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import spread

ROOT = "knowledgebase"
XML_HEAD = f'<?xml version="1.0" encoding="UTF-8"?>\n<{ROOT} xmlns="http://example.org/kb">\n'
XML_TAIL = f"\n</{ROOT}>\n"


def escaped(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit(">"), F.lit("&gt;"))
    return F.replace(c, F.lit('"'), F.lit("&quot;"))


def _cat(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _case(condition: Column, *parts: Column | str) -> Column:
    return F.when(condition, _cat(*parts)).otherwise("")


def part_xml() -> Column:
    """The entry of a ``part`` row; which parts an entry has depends on type and size."""
    key = F.col("p_partkey").cast("string")
    name, brand, kind = (escaped(F.col(c)) for c in ("p_name", "p_brand", "p_type"))
    size = F.col("p_size").cast("string")
    has_name = F.col("p_type") != "PROMO"
    return _cat(
        '<entry dataset="part" created="1998-02-03" modified="2021-11-05" version="3">\n',
        "  <accession>P", key, "</accession>\n",
        _case(F.col("p_type").isin("ECONOMY", "SMALL"), "  <accession>S", key, "</accession>\n"),
        "  <name>ID_", key, "</name>\n",
        _case(has_name, '  <protein><recommendedName><fullName evidence="1">', name,
              "</fullName></recommendedName></protein>\n"),
        _case(~has_name, "  <protein><submittedName><fullName>", name,
              "</fullName></submittedName></protein>\n"),
        '  <gene><name type="primary">', brand, '</name><name type="synonym">', kind,
        '</name><name type="ORF">', name, "</name></gene>\n",
        '  <organism><name type="scientific">', kind, '</name><name type="common">other</name>',
        '<dbReference type="NCBI Taxonomy" id="', size, '"/>',
        "<lineage><taxon>", kind, "</taxon><taxon>", brand, "</taxon></lineage></organism>\n",
        '  <comment type="', F.when(F.col("p_size") <= 25, "function").otherwise("miscellaneous"), '">',
        "<text> about ", name, " </text>",
        _case(F.col("p_type").isin("SMALL", "LARGE"), '<dbReference type="GO" id="GO:N', size, '"/>'),
        "</comment>\n",
        '  <dbReference type="PDB" id="', key, '"><property type="method" value="', kind, '"/></dbReference>\n',
        _case(F.col("p_type").isin("ECONOMY", "LARGE"), '  <dbReference type="GO" id="GO:', size, '"/>\n'),
        '  <feature type="chain" description="', name, '"><location><begin position="', size,
        '"/></location>',
        _case(F.col("p_size") > 10, '<evidence key="1" type="ECO:', size, '"><source>', brand, "</source></evidence>"),
        "</feature>\n",
        '  <keyword id="K', size, '">', kind, "</keyword>\n",
        '  <sequence length="', F.length("p_name").cast("string"), '" mass="', size, '">\n',
        name, "\n", brand, "\n</sequence>\n</entry>",
    )


def part_entries(part: DataFrame) -> DataFrame:
    """``(key, raw_xml)``, one entry per part."""
    return part.select(F.col("p_partkey").alias("key"), part_xml().alias("raw_xml"))


def document_xml(escape: bool = True) -> Column:
    """The entry of a ``documents`` row: the text is comment and sequence.

    Without ``escape`` a text with markup characters makes its entry malformed.
    """
    key = F.col("doc_id").cast("string")
    text = escaped(F.col("text")) if escape else F.col("text")
    return _cat(
        '<entry dataset="documents" created="2005-06-07" modified="2022-01-09" version="1">\n',
        "  <accession>D", key, "</accession>\n",
        "  <name>DOC_", key, "</name>\n",
        "  <gene><name type=\"primary\">", escaped(F.col("source")), "</name></gene>\n",
        '  <organism><name type="scientific">', F.col("lang"), "</name></organism>\n",
        '  <comment type="', F.when(F.col("lang") == "en", "function").otherwise("caution"), '"><text>',
        text, "</text></comment>\n",
        '  <keyword id="L-', F.col("lang"), '">', F.col("lang"), "</keyword>\n",
        '  <sequence length="', F.col("n_chars").cast("string"), '">', text, "</sequence>\n</entry>",
    )


def document_entries(documents: DataFrame, escape: bool = True) -> DataFrame:
    """``(key, raw_xml)``, one entry per document."""
    return documents.select(F.col("doc_id").alias("key"), document_xml(escape).alias("raw_xml"))


def as_fragments(entries: DataFrame, dataset: str, dataset_ord: int = 0) -> DataFrame:
    """Rendered entries in the shape of a scan, without writing documents first."""
    return entries.select(
        F.lit(dataset).alias("dataset"),
        F.lit(dataset_ord).alias("dataset_ord"),
        F.lit(dataset).alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("key").alias("ord"),
        "raw_xml",
    )


def write_documents(
    entries: DataFrame,
    path: str,
    per_document: int = 100_000,
    gzip: bool = False,
    head: str = XML_HEAD,
    tail: Column | str = XML_TAIL,
    key: Column | str = "key",
    raw_xml: Column | str = "raw_xml",
) -> None:
    """Write entries as complete documents of up to ``per_document`` consecutive keys each.

    ``tail`` may depend on the number of the document, ``doc``. ``raw_xml`` may be computed from columns of the rows, for
    instance by :func:`part_xml`: then these are shuffled, and the tasks that write the documents render them.

    The head and tail rows of a document sort around its entries; each document is one file.
    """
    key, raw_xml = (F.col(c) if isinstance(c, str) else c for c in (key, raw_xml))
    doc = F.floor(key / per_document)
    body = entries.select("*", doc.alias("_doc"), F.lit(1).alias("_place"), key.alias("_key"), F.lit(None).cast("string").alias("_end"))
    ends = entries.select(doc.alias("doc")).distinct().select(
        F.col("doc").alias("_doc"),
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("_place"), F.lit(0).cast("bigint").alias("_key"), F.lit(head).alias("_end")),
                F.struct(F.lit(2).alias("_place"), F.lit(0).cast("bigint").alias("_key"), F.lit(tail).alias("_end")),
            )
        ),
    )
    (
        body.unionByName(ends, allowMissingColumns=True)
        .repartition("_doc")
        .sortWithinPartitions("_doc", "_place", "_key")
        .select(F.col("_doc").alias("doc"), F.when(F.col("_place") == 1, raw_xml).otherwise(F.col("_end")).alias("value"))
        .write.partitionBy("doc")
        .option("compression", "gzip" if gzip else "none")
        .text(path)
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table that feeds a parse, over all cores even if it is one small file."""
    return spread(read_table(spark, sf_dir, name), key)
