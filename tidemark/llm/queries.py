"""The registered queries of the operators of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, contamination, conversations, exact, html_text, language, licences, lines, near, pieces, quality, shards
from tidemark.llm.samples import held_out
from tidemark.llm.jaccard import linked_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return linked_components(_table(spark, folder, "documents"))


@_query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_repeated_lines(_table(spark, folder, "documents").select("doc_id", "text"))


@_query
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id")
    return shards.place(docs, F.col("doc_id"), [f"shard-{i}" for i in range(shards.SHARDS)])


@_query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_query
def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(_table(spark, folder, "documents"), pieces.Vocabulary.load())


@_query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Grades: 0 toxic, 1 of low quality, 2 good."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    ratings = labels.select("doc_id", F.expr("CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END").alias("grade"))
    found = quality.grade(docs.select("doc_id", "text"), quality.learn(docs, ratings, 3))
    return found.select("doc_id", held_out().alias("held_out"), "expected_grade", "p_top", "selected")


@_query
def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    lines = licences.features(docs)
    return licences.licence_paragraphs(docs, licences.learn(docs, lines=lines), lines=lines)


@_query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contained(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(_table(spark, folder, "documents"))


@_query
def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract_text(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(_table(spark, folder, "documents"), alignment.Pair.load())


@_query
def op12_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_components(_table(spark, folder, "documents"))


@_query
def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations")
    return conversations.report(given, conversations.repair(conversations.damaged(given)))


SQL |= {
    "op2_line_dedup": lines.SQL,
    "op3_sharding": shards.SQL,
    "op8_decontamination": contamination.SQL,
    "op9_exact_dedup": exact.SQL,
}
