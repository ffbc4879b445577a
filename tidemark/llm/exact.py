"""Exact copies of documents, found by recipes of content-defined chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.native_words import bounded, spare
from tidemark.session import save

#: A chunk ends where the text says so: after white space, f or t, and a letter of a-h,
#: not before ``SHORTEST`` and not after ``LONGEST`` characters.
SHORTEST, LONGEST = 512, 4096
CHUNK = rf"(?s).{{{SHORTEST},{LONGEST}}}?\s[ftFT][a-hA-H]|.{{1,{LONGEST}}}"


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical; null counts as empty, other columns are not
    read. Of equal texts the row with the largest doc_id stays (nulls are
    smallest; of rows that repeat it, one stays). An empty table gives no row.

    Each text is cut into chunks at places its content names. A chunk's
    identifier is its 64-bit hash, and it is verified: the chunks of the whole
    table meet once, reduced in each task before they move, and an identifier
    that stands for two contents is found there. Texts are then equal if their
    ordered identifiers are, so after this step only identifiers move. Texts with
    an identifier that failed its check (about one in 10**8 TB) are told apart by
    their digest as well.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chunks = F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0))
    recipes = save(
        rows.select(
            "doc_id", F.monotonically_increasing_id().alias("row"), F.sha2("text", 256).alias("text_sha256"),
            F.transform(chunks, lambda c: F.xxhash64(c)).alias("recipe"),
        ),
        "recipes",
    )
    chunk = rows.select(F.explode(chunks).alias("chunk")).select(F.xxhash64("chunk").alias("id"), "chunk")
    clashes = chunk.groupBy("id", "chunk").agg(F.lit(1).alias("one")).groupBy("id").agg(F.count("*").alias("texts")).where("texts > 1")
    clashes = save(clashes.select("id"), "clashes")
    doubtful = save(
        recipes.select("text_sha256", F.explode("recipe").alias("id")).join(clashes, "id", "left_semi")
        .select(F.col("text_sha256").alias("doubtful")).distinct(),
        "doubtful",
    )
    keyed = recipes.join(doubtful, F.col("text_sha256") == F.col("doubtful"), "left").withColumn("key", F.xxhash64("recipe"))
    group = ["key", "recipe", "doubtful"]
    kept = keyed.groupBy(*group).agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")).where("group_size > 1")
    kept = save(kept.select(F.col("key").alias("k"), F.col("recipe").alias("r"), F.col("doubtful").alias("d"), "keep", "group_size"), "groups")
    same = (F.col("key") == F.col("k")) & (F.col("recipe") == F.col("r")) & F.col("doubtful").eqNullSafe(F.col("d"))
    return keyed.join(kept, same, "left").select(
        "doc_id",
        F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts: that of the largest doc_id.

    All columns stay. Where rows repeat doc_id and text, one of them stays.
    """
    groups = exact_groups(docs).where("group_size > 1").select("doc_id", F.unhex("text_sha256").alias("digest"), "kept")
    # Rows are told by doc_id and text; a pair with both kept and dropped rows stands for repeated rows.
    id_, digest, sha = spare(docs, "id", "digest", "sha")
    pairs = groups.groupBy("doc_id", "digest").agg(F.max("kept").alias("stays"), F.count("*").alias("times"))
    pairs = save(pairs.where("times > 1 or not stays").select(F.col("doc_id").alias(id_), F.col("digest").alias(digest), "stays"), "pairs")
    stay = save(pairs.where("stays").drop("stays"), "repeated")
    marked = docs.withColumn(sha, F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(sha) == F.col(digest))
    # The texts stay where they are if the rows to drop are few enough to be sent to them.
    others = marked.join(bounded(pairs.drop("stays"), pairs.count()), same, "left_anti")
    again = marked.join(bounded(stay, stay.count()), same, "left_semi").dropDuplicates(["doc_id", sha])
    return others.unionByName(again).drop(sha)


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
