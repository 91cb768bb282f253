"""Stages from raw documents to a training mix.

Each takes (spark, docs, sf_dir) and returns what it keeps, all but the last with the columns of docs, whatever they are called: rows carry
all their columns as one struct through Python.

Defined cases, for every stage: an empty table gives an empty table; rows with a null doc_id, lang or source are judged like any other;
repeated rows are judged one by one, until the near-dedup stage keeps one of them; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramlake.llm import decontaminate, langid, mixing, quality, simhash
from tramlake.llm.common import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter (null and empty ones too), and texts whose language is ambiguous, go. Where no row names its language, all go."""
    return langid.known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score below the quality threshold go; the labels of the documents that are left teach the classifier. Without labels
    all stay; a null or empty text has the score of the bias."""
    return quality.good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that of the smallest doc_id (null last), then fingerprint, then hash of the row. Null, empty and
    blank texts are copies of each other; rows that share a doc_id are told apart by their columns."""
    return simhash.first_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go. Null and empty texts stay, and without items all do."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a document: how many of its words the training mix takes, and the place of each copy taken, by virtual finish time, in the
    order to train in. Null and empty texts are never taken; a null source is a source."""
    return mixing.mix(docs)
