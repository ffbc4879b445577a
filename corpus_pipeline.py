"""A corpus made ready for training: five stages, each an operator of ``tidemark.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, pieces
from tidemark.llm.contamination import decontaminated
from tidemark.llm.exact import drop_exact_copies
from tidemark.llm.jaccard import one_of_each
from tidemark.session import save

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document goes if its language is not this sure; chance alone gives a quarter with four languages.
LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without letters, or of no language that the network knows, go."""
    found = language.identify(docs, language.learn(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents with one text that with the largest doc_id stays."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each component of similar documents that with the smallest doc_id stays, and of its texts the smallest."""
    return one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold an item of the benchmark go, also those without doc_id."""
    return decontaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), unnamed=True)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with their ids and whether these decode to the text."""
    return pieces.encode_and_check(docs, pieces.Vocabulary.load())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("decontamination", benchmark_free),
    ("pieces", encoded),
]

#: The first stage learns a network and the last one searches for best paths, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of a folder; each is written before the next reads it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
