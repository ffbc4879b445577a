"""Repeated passages of three lines and more, removed after their first occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.native_words import spare
from tidemark.session import save


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its texts shortened, and ``n_lines, n_removed`` beside them.

    Lines end at \\n. Three lines in a row make a window; windows overlap, and
    one of blank lines only (spaces, tabs) counts for nothing. Of equal windows
    in the whole table the first by (doc_id, position) stays; a null doc_id comes
    first. The lines that later windows cover are merged and removed, the rest is
    joined by \\n. Null stays null with 0 lines, a text without three lines stays
    as it is; a text of which nothing is left becomes empty. Rows that repeat
    doc_id and text are one text and stay alike. Own columns of the names
    ``n_lines`` and ``n_removed`` are replaced.

    Windows are compared by 96 bits of hashes. They are reduced in each task to
    the first of their kind before the shuffle; a window on a third of all rows
    is one row of the small side of the join that finds later ones.
    """
    texts = docs.select(F.col("doc_id").alias("doc"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = texts.select("doc", F.xxhash64("text").alias("sign"), F.split("text", "\n").alias("lines"))
    placed = rows.where("size(lines) >= 3").select("doc", "sign", "lines", F.posexplode("lines").alias("at", "line"))
    three = [F.col("line"), F.get("lines", F.col("at") + 1), F.get("lines", F.col("at") + 2)]
    blank = F.concat_ws("", *three).rlike(r"^[ \t\r]*$")
    windows = placed.where(F.col("at") + 2 < F.size("lines")).where(~blank).select(
        "doc", "sign", "at", F.xxhash64(*three).alias("h"), F.hash(F.lit("b"), *three).alias("g")
    )
    firsts = windows.groupBy("h", "g").agg(F.min(F.struct("doc", "sign", "at")).alias("first"), F.count("*").alias("times"))
    firsts = save(firsts.where("times > 1").drop("times"), "windows")
    later = windows.join(firsts, ["h", "g"]).where("not struct(doc, sign, at) <=> first")
    covered = later.groupBy("doc", "sign").agg(F.collect_set("at").alias("starts"))  # at most the lines of one text

    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    doc, sign, starts, own_sign, lines = spare(docs, "doc", "sign", "starts", "own_sign", "lines")
    covered = covered.select(F.col("doc").alias(doc), F.col("sign").alias(sign), F.col("starts").alias(starts))
    marked = docs.select(*own).withColumn(own_sign, F.when(F.col("text").isNotNull(), F.xxhash64(F.col("text").cast("string"))))
    joined = marked.join(covered, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own_sign) == F.col(sign)), "left")
    joined = joined.withColumn(lines, F.split(F.col("text").cast("string"), "\n"))
    cut = F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2))))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    joined = joined.withColumns(
        {
            "text": F.when(F.col(starts).isNull(), F.col("text").cast("string")).otherwise(text),
            "n_lines": F.coalesce(F.greatest(F.size(lines), F.lit(0)), F.lit(0)).cast("long"),
            "n_removed": F.coalesce(F.when(F.col(starts).isNotNull(), F.size(cut)), F.lit(0)).cast("long"),
        }
    )
    return joined.select(*own, "n_lines", "n_removed")


SQL = r"""
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
w AS (SELECT doc_id, pos, line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d AS win FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM w WHERE win IS NOT NULL AND NOT regexp_full_match(win, '[ \t\r\n]*')),
c AS (SELECT DISTINCT doc_id, pos + k AS pos FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
g AS (SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL), '') AS text
  FROM l LEFT JOIN c ON c.doc_id = l.doc_id AND c.pos = l.pos GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, text FROM g"""
