"""The corpus pipeline: language, lines, near-duplicates, mix, packing.

Every stage takes the documents that the one before it kept and returns
documents of the same columns; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import best_fit, cross_parse, curriculum, line_runs, near_dups
from faultline.llm.common import columns_of, materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    return cross_parse.keep_known(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; documents that lose all text stay, empty."""
    return line_runs.drop_repeated_lines(docs).select(*columns_of(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dups.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return curriculum.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins."""
    return best_fit.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: Language identification and the hashed orders have no SQL form.
ORACLE_SQL = None
