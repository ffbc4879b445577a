"""Layers of a reference graph, and the drop list built on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.scalars import quote_ident
from tidemark.operators.objects import user_objects
from tidemark.session import save

# The order in which a dialect drops kinds of objects, the quote
# style of its names and the text that ends each statement.
CLEAN_ORDER = {
    "duckdb": ["MACRO", "SEQUENCE", "VIEW", "TABLE"],
    "databricks": ["TABLE", "VIEW", "FUNCTION"],
    "db2z": [
        "VIEW",
        "ALIAS",
        "TABLE",
        "TEMPORARY TABLE",
        "TABLESPACE",
        "SEQUENCE",
        "TRIGGER",
        "PROCEDURE",
        "FUNCTION",
        "TYPE",
    ],
    "ignite": ["TABLE", "SEQUENCE", "CONSTANT", "ALIAS", "DOMAIN"],
    "timeplus": ["STREAM", "FORMAT SCHEMA", "FUNCTION"],
    "clickhouse": ["TABLE"],
    "cubrid": ["TABLE"],
    "iris": ["TABLE"],
    "questdb": ["TABLE"],
    "spark": ["VIEW", "TABLE", "FUNCTION"],
}
CLEAN_QUOTES = {"spark": "spark", "databricks": "backtick", "clickhouse": "backtick", "timeplus": "backtick"}
CLEAN_SUFFIX = {"duckdb": " CASCADE"}


class BlockedObjects(ValueError):
    """Objects remain, and each of them is referenced by another."""


#: Objects that an error names at most.
NAMED = 20


def _saved(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    seen = Observation()
    written = save(df.observe(seen, F.count("*").alias("n")), label)
    return written, seen.get["n"]


def _blocked(nodes: DataFrame, cycles: DataFrame, what: str) -> BlockedObjects:
    names = [r[0] for r in cycles.distinct().orderBy("node").limit(NAMED + 1).collect()]
    listed = ", ".join(map(str, names[:NAMED])) + (", ..." if len(names) > NAMED else "")
    return BlockedObjects(f"{nodes.distinct().count()} objects {what}: {listed}")


@dataclass
class Chains:
    """Runs of nodes that one edge enters and one leaves, taken out of a graph.

    ``inner`` (``node, via, top, far``): ``top`` is the node before the run, ``far``
    the length of the way from it, ``via`` the first node of the run. ``runs``
    (``via, src, dst``) are the edges that stand for the runs.
    """

    inner: DataFrame
    runs: DataFrame


def _contracted(edges: DataFrame, held: DataFrame) -> tuple[DataFrame, Chains | None]:
    """``edges`` with every run of inner nodes as one edge of the run's length.

    Nodes in ``held`` have a layer of their own to keep and are never inner. Each
    inner node points to the one before it; doubling these pointers takes them to
    the first of their run in as many rounds as the length of the run has bits.
    Pointers that reach none by then run around a cycle.
    """
    entered = edges.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("n"), F.min("src").alias("up"), F.min("w").alias("w")).where("n = 1")
    left = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("n")).where("n = 1").select("node")
    inner, n = _saved(entered.join(left, "node", "left_semi").join(held, "node", "left_anti").select("node", "up", "w"), "inner")
    if not n:
        return edges, None
    before = inner.select(F.col("node").alias("up"), F.lit(True).alias("goes_on"))
    # The first node of a run points to itself, at no distance.
    start = inner.join(before, "up", "left").select(
        "node", F.when(F.col("goes_on"), F.col("up")).otherwise(F.col("node")).alias("via"),
        F.when(F.col("goes_on"), F.col("w")).otherwise(0).cast("long").alias("far"), F.coalesce("goes_on", F.lit(False)).alias("open"),
    )
    pointers, _ = _saved(start, "pointers")
    for _ in range(n.bit_length() + 1):
        ahead = pointers.select(F.col("node").alias("via"), F.col("via").alias("next"), F.col("far").alias("more"), F.col("open").alias("still"))
        seen = Observation()
        stepped = pointers.join(ahead, "via").select("node", F.col("next").alias("via"), (F.col("far") + F.col("more")).alias("far"), F.col("still").alias("open"))
        pointers = save(stepped.observe(seen, F.count_if("open").alias("n")), "pointers")
        if not seen.get["n"]:
            break
    else:
        stuck = pointers.where("open").select("node")
        raise _blocked(stuck, stuck, "remain and all of them are referenced, in cycles")
    first = inner.select(F.col("node").alias("via"), F.col("up").alias("top"), F.col("w").cast("long").alias("lead"))
    found = save(pointers.join(first, "via").select("node", "via", "top", (F.col("far") + F.col("lead")).alias("far")), "chains")
    ends = edges.join(inner.select(F.col("node").alias("dst")), "dst", "left_anti")
    ends = ends.join(found.withColumnRenamed("node", "src"), "src", "left").select(
        F.coalesce("top", "src").alias("src"), "dst", (F.coalesce("far", F.lit(0)) + F.col("w")).alias("w"), "via"
    )
    ends = save(ends, "ends")
    return save(ends.groupBy("src", "dst").agg(F.max("w").alias("w")), "contracted"), Chains(found, ends.where("via IS NOT NULL").select("via", "src", "dst"))


def _trimmed(edges: DataFrame, n: int) -> DataFrame:
    """Edges of a graph in which all nodes are entered, without those that lead out of its cycles."""
    while True:
        edges, left = _saved(edges.join(edges.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst"), "trimmed")
        if left == n:
            return edges
        n = left


def _members(edges: DataFrame, taken: list[Chains]) -> DataFrame:
    """The nodes of ``edges`` and all that were contracted into them."""
    nodes = edges.select(F.col("dst").alias("node")).union(edges.select("src")).distinct()
    links = edges.select("src", "dst").distinct()
    for chains in reversed(taken):
        runs = chains.runs.join(links, ["src", "dst"], "left_semi")
        inner = chains.inner.join(runs.select("via").distinct(), "via", "left_semi").select("node")
        nodes = nodes.union(inner)
        # A run of an earlier contraction may lie on any way that is left.
        links = links.union(runs.select("src", F.col("via").alias("dst"))).union(
            chains.inner.join(runs.select("via", "dst"), "via").select(F.col("node").alias("src"), "dst")
        )
    return nodes.distinct()


def peel_layers(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """Layer of each node: 0 if nothing references it, else one more than the
    highest layer among the nodes that do. Self-references do not count.

    Runs of nodes with one reference in and one out become one edge each, by
    pointers that double (``_contracted``), so a chain of n references takes
    about log2(n) rounds. What is left is peeled: a round takes the edges of nodes
    that nothing references any more and hands their layers on. Where peeling
    takes less than an eighth of the edges away, runs are contracted again. All
    rounds are written, and only numbers come back. If nothing can be peeled, the
    rest is trimmed from its other end too and its nodes are named in the error.
    """
    names = nodes.select(node).distinct()
    links = edges.filter("src <> dst").select("src", "dst").distinct()
    links = links.join(names.select(F.col(node).alias("dst")), "dst", "left_semi")
    outside = links.join(names.select(F.col(node).alias("src")), "src", "left_anti")
    links, n = _saved(links.select("src", "dst", F.lit(1).cast("long").alias("w")), "references")
    if n and not outside.isEmpty():
        raise BlockedObjects(f"{outside.select('dst').distinct().count()} objects are referenced from outside")
    if not n:
        return nodes.withColumn("layer", F.lit(0))
    layers = links.select(F.col("src").alias("node"), F.lit(0).cast("long").alias("layer")).limit(0)
    taken: list[Chains] = []
    slow = True
    while n:
        if slow:
            links, chains = _contracted(links, layers.select("node"))
            taken += [chains] if chains else []
            n = links.count()
        targets = links.select(F.col("dst").alias("src")).distinct()
        free = links.join(targets, "src", "left_anti").join(layers.withColumnRenamed("node", "src"), "src", "left")
        free, fired = _saved(free.select(F.col("dst").alias("node"), (F.coalesce("layer", F.lit(0)) + F.col("w")).alias("layer")), "free")
        if not fired:
            stuck = links.select(F.col("dst").alias("node"))
            whole = _members(links.select("src", "dst"), taken)
            cycles = _members(_trimmed(links.select("src", "dst"), n), taken)
            raise _blocked(whole if taken else stuck, cycles, "remain and all of them are referenced, in cycles")
        layers = save(layers.union(free).groupBy("node").agg(F.max("layer").alias("layer")), "layers")
        links, left = _saved(links.join(targets, "src", "left_semi").select("src", "dst", "w"), "references")
        slow, n = left > n - n // 8, left
    for chains in reversed(taken):
        inner = chains.inner.join(layers.withColumnRenamed("node", "top"), "top", "left")
        layers = save(layers.union(inner.select("node", (F.coalesce("layer", F.lit(0)) + F.col("far")).alias("layer"))), "layers")
    layers = layers.select(F.col("node").alias(node), F.col("layer").cast("int").alias("layer"))
    return nodes.join(layers, node, "left").withColumn("layer", F.coalesce("layer", F.lit(0)))


def clean_plan(objects: DataFrame, edges: DataFrame, dialect: str) -> DataFrame:
    """Ordered list of drop statements for all user objects of a listing.

    ``edges`` names objects as ``schema.name``. Kinds come in the order of the
    dialect, within a kind an object comes after all that reference it. Kinds
    the dialect does not drop are left out.
    """
    kinds = CLEAN_ORDER[dialect]
    order = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")).cast("int")
    listed = user_objects(objects).withColumns(
        {"kind_order": order, "node": F.concat_ws(".", "schema", "name")}
    )
    listed = listed.filter("kind_order > 0")
    name = quote_ident(["schema", "name"], CLEAN_QUOTES.get(dialect, "double"))
    statement = F.concat(
        F.lit("DROP "), F.col("kind"), F.lit(" "), name, F.lit(CLEAN_SUFFIX.get(dialect, ""))
    )
    return (
        peel_layers(listed, edges)
        .select("kind_order", "layer", "kind", "schema", "name", statement.alias("statement"))
        .orderBy("kind_order", "layer", "schema", "name")
    )
