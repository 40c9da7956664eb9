"""A training corpus from raw documents: quality rules, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as Parquet in
the shared folder and reads it again for the next. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tesserae.llm import linededup, mixing, packing, quality, simhash
from tesserae.llm.common import durable, table
from tesserae.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; documents of which nothing is left go."""
    return linededup.drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, by shingles of five words, the document with the smallest doc_id."""
    return simhash.keep_one(docs, shingle=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source up to its share of the mix, a row for each time that a document is taken."""
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's tokens goes."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizers and fuzzy matching are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = durable(docs)
    return docs
