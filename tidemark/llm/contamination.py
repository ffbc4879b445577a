"""Benchmark items inside documents: containment search by size-partitioned MinHash sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.native_words import bounded, digest, shingles, spare, words
from tidemark.session import save

WIDTH, PERCENT = 5, 75


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs ``doc_id, item_id, n_item, n_shared, containment`` of items found in documents.

    An item has the distinct runs of five words of its text, lower-cased in A-Z
    (the whole sequence if it is shorter); it is in a document that has at least
    75 % of them. Items and documents without words are in no pair. Rows that
    repeat an id count as further texts of it, and the largest share stands.
    Rows without an id are left out, as no pair could name them; other columns
    are not read.

    Items are partitioned by size (powers of two). The MinHash sketch of an item
    is its k smallest shingle hashes, where k is a quarter of its partition's
    upper size plus one. A document that holds 75 % of n shingles misses at most
    n/4 of them, so it holds at least k - n/4 of the sketch: no hit is lost,
    however long the document is, which sketches of whole documents could not
    promise. Documents stream past the sketches, which are broadcast if they are
    few and joined by a shuffle otherwise; candidates are then counted exactly.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), words(F.col("text").cast("string")).alias("words"))
    return _contained(texts, items)


def _contained(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``contained`` for texts that are cut into ``words`` already; their doc_id may be of any type."""
    items = items.where("item_id is not null").select(F.col("item_id").cast("long"), words(F.col("text").cast("string")).alias("words"))
    items = items.where("size(words) > 0").select(
        F.monotonically_increasing_id().alias("item"), "item_id", F.least(F.size("words"), F.lit(WIDTH)).alias("width"), shingles("words", WIDTH).alias("shingles")
    )
    items = save(items.withColumn("n", F.size("shingles").cast("long")), "items")
    # k by the size partition of the item; hashes of a run of words as below.
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n").cast("double")))).cast("long")
    hashed = F.transform("shingles", lambda s: F.xxhash64(s))
    sketch = items.select("item", "n", "width", F.floor(upper * (100 - PERCENT) / 100 + 1).cast("int").alias("k"), F.array_sort(F.array_distinct(hashed)).alias("h"))
    sketch = sketch.withColumn("h", F.slice("h", F.lit(1), F.col("k")))
    sketch = sketch.select("item", "n", "width", (F.size("h") - F.expr(f"n * {100 - PERCENT} div 100")).alias("least"), F.explode("h").alias("hash"))
    sketch = save(sketch, "sketches")

    placed = texts.select("doc_id", "words", F.posexplode("words").alias("at", "word"))
    runs = None
    for (width,) in sorted(items.select("width").distinct().collect()):  # five numbers at most
        run = F.concat_ws(" ", *(F.get("words", F.col("at") + k) for k in range(width)))
        part = placed.where(F.col("at") + width <= F.size("words")).select("doc_id", F.lit(width).alias("width"), F.xxhash64(run).alias("hash"))
        runs = part if runs is None else runs.unionByName(part)
    if runs is None:
        runs = placed.select("doc_id", F.lit(0).alias("width"), F.lit(0).cast("long").alias("hash"))
    hits = runs.join(bounded(sketch, sketch.count()), ["hash", "width"])
    hits = hits.groupBy("doc_id", "item", "hash").agg(F.first("least").alias("least"))
    found = hits.groupBy("doc_id", "item").agg(F.count("*").alias("hits"), F.first("least").alias("least")).where("hits >= least")
    found = save(found.select(F.col("doc_id").alias("id"), "item"), "candidates")

    ids = save(found.select("id").distinct(), "ids")
    ids = bounded(ids, ids.count())
    near = texts.join(ids, F.col("doc_id") == F.col("id"), "left_semi")
    near = near.join(found, near.doc_id == found.id).join(items, "item")
    run = F.expr("""transform(sequence(1, greatest(1, size(words) - width + 1)), i -> array_join(slice(words, i, width), ' '))""")
    shared = near.select("doc_id", "item_id", F.col("n").alias("n_item"), F.size(F.array_intersect("shingles", run)).cast("long").alias("n_shared"))
    return (
        shared.where(100 * F.col("n_shared") >= PERCENT * F.col("n_item"))
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("containment", "n_item", "n_shared")).alias("best"))
        .select("doc_id", "item_id", "best.n_item", "best.n_shared", "best.containment")
    )


def decontaminated(docs: DataFrame, items: DataFrame, unnamed: bool = False) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns stay.

    Each row is decided by its own text, whatever rows repeat its doc_id. Rows
    without doc_id stay unless ``unnamed`` says that they are decided too. Items
    count with or without an id.
    """
    texts = docs if unnamed else docs.where("doc_id is not null")
    texts = texts.select(digest().alias("doc_id"), words(F.col("text").cast("string")).alias("words"))
    gone = _contained(texts, items.select(F.lit(0).alias("item_id"), "text"))
    (name,) = spare(docs, "gone")
    gone = save(gone.select(F.col("doc_id").alias(name)).distinct(), "gone")
    decided = F.lit(True) if unnamed else F.col("doc_id").isNotNull()
    return docs.join(bounded(gone, gone.count()), decided & (digest() == F.col(name)), "left_anti")


SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') FROM benchmark),
s AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM s d JOIN s i ON d.sh = i.sh AND d.kind = 'd' AND i.kind = 'i' JOIN n ON n.id = i.id
GROUP BY d.id, i.id, n_item HAVING 100 * count(*) >= 75 * n_item"""
