"""A corpus pipeline of five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's rows to the shared folder and reads them back as the next
one's ``docs``, so a lost executor costs at most the stage that was running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harmonia.llm.common import materialise, table
from harmonia.llm.language_id import identified_documents
from harmonia.llm.mixing import mixed_documents
from harmonia.llm.packing import pack_documents
from harmonia.llm.simhash_dedup import one_of_each
from harmonia.llm.toxicity import clean_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the model rejects."""
    return identified_documents(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest doc_id of each group of near copies."""
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that every source meets its share of words."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids."""
    return pack_documents(docs)


STAGES = [("language_id", language_id), ("toxicity", toxicity), ("simhash_dedup", simhash_dedup),
          ("mix_sources", mix_sources), ("pack", pack)]

#: Trained models and packing have no SQL form; tests/llm holds the SimHash, mixing and packing operators against brute force and the
#: models against held-out labels, and the stages' columns and rows kept against their contract.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
