"""From raw documents to token records: the stages of a training corpus.

Every stage takes rows with the columns of documents, of which only doc_id, text and source count; others,
also of other names, go along up to the last stage. A null text counts as empty; texts of any length are
read whole; rows that are repeated are documents of their own, but for near duplicates, of which one stays. An empty
table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from learnertrace.llm import decontaminate, jaccard_join, mixing, quality, token_records
from learnertrace.llm.common import table, written


def good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier rejects go; empty texts score the labels' rate of good ones."""
    return quality.accepted(docs, table(spark, folder, "labels"))


def apart(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, 80%): that with the smallest doc_id.
    Documents without words are no duplicates of each other."""
    return jaccard_join.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Contaminated documents go; those without words stay."""
    return decontaminate.clean(docs, table(spark, folder, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the mix of sources takes it; a null source is one of its own."""
    return mixing.mix(docs)


def records(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token records, written to the shared folder in the order of doc_id and read back; ties in the order of
    a hash of the text."""
    return token_records.encode_and_read(docs)


STAGES = [
    ("quality", good),
    ("near_duplicates", apart),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_records", records),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in turn, each on what the one before has written."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, folder))
    return docs
