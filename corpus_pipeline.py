"""A corpus pipeline of four stages over ``documents``: classify, apply rules, drop near copies, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pixelfold.llm import packing, quality_classifier, quality_rules, simhash
from pixelfold.llm.common import table
from pixelfold.llm.queries import word_tokenizer
from pixelfold.plans.sizing import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score_documents(docs, model).where("predicted = 1").select(docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every risk-controlled cutoff."""
    return quality_rules.judge(docs, table(spark, sf_dir, "labels")).where("kept").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id: the SimHash operator with the shingle length and bit distance of its contract."""
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents with their places in the packed sequences."""
    return packing.pack_documents(docs, word_tokenizer())


STAGES: list[tuple[str, Stage]] = [("quality_classifier", classify), ("quality_rules", rules), ("simhash_near_dedup", near_copies), ("best_fit_packing", pack)]

#: Trained weights, fingerprints and tokenizers have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
