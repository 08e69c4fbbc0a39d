"""From raw documents to packed training sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbetl.llm.common import crc32_bucket, table, written
from kbetl.llm.exact_dedup import keep_one
from kbetl.llm.language_id import keep_identified
from kbetl.llm.packing import pack_documents, word_tokenizer_path
from kbetl.llm.simhash import keep_one_of_near
from kbetl.llm.surrogates import replace_entities


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages go."""
    return keep_identified(docs, crc32_bucket(F.col("doc_id"), 4) != 2)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return keep_one(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the one with the smallest id stays."""
    return keep_one_of_near(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; ``n_chars`` follows the text."""
    replaced = replace_entities(docs)
    # By place: further columns may have any names.
    names, places = docs.columns, [f"_{i}" for i in range(len(replaced.columns))]
    n_chars, text, n_entities = places[names.index("n_chars")], places[names.index("text")], places[-2]
    followed = F.when(F.col(n_entities) > 0, F.length(text)).otherwise(F.col(n_chars)).cast(docs.schema[names.index("n_chars")].dataType)
    kept = (followed.alias(p) if p == n_chars else F.col(p) for p in places[: len(names)])
    return replaced.toDF(*places).select(*kept).toDF(*names)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences of 2048 tokens."""
    return pack_documents(docs, word_tokenizer_path(), keep_ids=False)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("surrogates", surrogates),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


# Language models, components and packing have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None
