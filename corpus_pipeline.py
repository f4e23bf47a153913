"""Corpus preparation: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``documents``.

Defined results: an empty table passes through as an empty table; nulls, empty
and repeated rows follow the operators' own definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourcast.llm import line_dedup, mixing, near_dup, packing, quality
from hourcast.llm.common import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the cascade of quality rules rejects go."""
    return quality.keep_documents(docs.select(*COLUMNS))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in several documents stay in one of them; every document stays."""
    return line_dedup.dedup_lines(docs.select(*COLUMNS)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8) stays."""
    return near_dup.distinct_documents(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time a document is taken."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each taken document lies."""
    return packing.pack_documents(docs.select(*COLUMNS))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("near-duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Bin completion has no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
