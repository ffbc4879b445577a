"""Leases: who held a key, from when to when, and who was granted it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.sequences import assign_sequence, next_position
from tidemark.session import save

MICROS = 1_000_000
PART_BITS = 12  # time slices of one part of a key


def _islands(df: DataFrame, keys: list[str], ttl: int) -> DataFrame:
    """Number the runs of spans ``(s, e)`` with gaps of at most ``ttl``."""
    order = W.partitionBy(*keys).orderBy("s")
    reached = F.max("e").over(order.rowsBetween(W.unboundedPreceding, -1))
    starts = F.coalesce(F.col("s") - reached > ttl, F.lit(True))
    return df.withColumn("_starts", starts.cast("int")).withColumn(
        "island", F.sum("_starts").over(order)
    )


def _spans(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n")
    )


def span_slices(events: DataFrame, key: str, ts: str, ttl_seconds: int) -> DataFrame:
    """Spans ``(key, s, e, n)`` in microseconds, one for each TTL-wide slice of time that has refreshes.

    All refreshes within one slice belong together, so they are aggregated per
    task before anything moves. Refreshes without a time count for nothing.
    """
    ttl = ttl_seconds * MICROS
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    times = events.select(F.col(key), at.alias("s")).filter("s IS NOT NULL")
    return (
        times.withColumn("slice", F.expr(f"(s - pmod(s, {ttl}L)) DIV {ttl}L"))
        .groupBy(key, "slice")
        .agg(F.min("s").alias("s"), F.max("s").alias("e"), F.count("*").alias("n"))
        .drop("slice")
    )


def merge_spans(spans: DataFrame, key: str, ttl_seconds: int) -> DataFrame:
    """Spans ``(key, s, e, n)`` with gaps of at most the TTL joined to one; they may overlap in any way.

    Spans are cut where a part of a key's time ends and join up inside parts of
    a key; only the first and last span of a part can touch another part, and
    only these meet in a window over the key.
    """
    ttl = ttl_seconds * MICROS
    width = ttl << PART_BITS
    first, last = (F.expr(f"({c} - pmod({c}, {width}L)) DIV {width}L") for c in ("s", "e"))
    pieces = spans.select(key, "s", "e", "n", first.alias("own"), F.explode(F.sequence(first, last)).alias("part")).select(
        key,
        "part",
        F.greatest("s", F.col("part") * width).alias("s"),
        F.least("e", (F.col("part") + 1) * width).alias("e"),
        F.when(F.col("part") == F.col("own"), F.col("n")).otherwise(0).alias("n"),
    )
    return _joined_parts(pieces, key, ttl)


def _joined_parts(pieces: DataFrame, key: str, ttl: int) -> DataFrame:
    spans = _spans(_islands(pieces, [key, "part"], ttl), [key, "part", "island"])
    last = F.max("island").over(W.partitionBy(key, "part"))
    inner = (F.col("island") > 1) & (F.col("island") < last)
    # An inner span is complete and keeps its own group in the second round.
    spans = spans.withColumn("inner", inner).select(
        key,
        "s",
        "e",
        "n",
        F.when(F.col("inner"), F.col("part")).alias("own_part"),
        F.when(F.col("inner"), F.col("island")).alias("own_island"),
    )
    own = [key, "own_part", "own_island"]
    return _spans(_islands(spans, own, ttl), [*own, "island"]).select(key, "s", "e", "n")


def as_sessions(spans: DataFrame, key: str, ttl_seconds: int, *more: str) -> DataFrame:
    """Spans with times and the end of the lease, which is one TTL after the last refresh."""
    return spans.select(
        key,
        F.timestamp_micros("s").alias("session_start"),
        F.timestamp_micros(F.col("e") + ttl_seconds * MICROS).alias("session_end"),
        F.col("n").alias("n_refreshes"),
        *more,
    )


def lease_sessions(events: DataFrame, key: str, ts: str, ttl_seconds: int) -> DataFrame:
    """Per key the spans in which each refresh came within the TTL of the last."""
    ttl = ttl_seconds * MICROS
    slices = span_slices(events, key, ts, ttl_seconds)
    pieces = slices.withColumn("part", F.shiftright(F.expr(f"(s - pmod(s, {ttl}L)) DIV {ttl}L"), PART_BITS))
    return as_sessions(_joined_parts(pieces, key, ttl), key, ttl_seconds)


def lease_grants(
    events: DataFrame,
    key: str,
    holder: str,
    ts: str,
    ttl_seconds: int,
    order: str,
    release: str = "release",
) -> DataFrame:
    """Requests that were granted the lease of their key.

    A request is granted if the key is free or has been held for strictly
    longer than the TTL; otherwise it is refused and changes nothing. A row
    with ``release`` frees the key if its holder holds it. Rows of a key are
    taken in the order of ``ts`` and then the unique ``order``.

    Rows without a key or a holder are left out.

    Keys of every size are solved by the same joins, see ``_grants_by_jumps``.
    """
    rows = events.select(
        F.col(key),
        F.col(holder),
        F.col(order),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("at"),
        F.col(release).alias("is_release"),
    ).filter(F.col(key).isNotNull() & F.col(holder).isNotNull())
    ttl = ttl_seconds * MICROS
    granted = _grants_by_jumps(rows, key, holder, order, ttl)
    return granted.select(key, holder, order, F.timestamp_micros("at").alias("granted_at"))


def _grants_by_jumps(rows: DataFrame, key: str, holder: str, order: str, ttl: int) -> DataFrame:
    """The same result for keys of any size.

    If a request is granted, the next grant of its key is known without what
    came before: the first request after the TTL has passed, or the first
    request after the holder's release if that comes earlier. These links form
    chains, and the grants are the chain from the first request of each key.
    Links are doubled in length each round, so rounds grow with the logarithm
    of the number of grants.
    """
    kind = F.col("kind")
    requests = rows.filter(~F.col("is_release"))
    probes = requests.withColumns({"at": F.col("at") + ttl, "kind": F.lit(1)})
    timeline = rows.withColumn("kind", F.lit(0)).unionByName(probes)
    # A probe follows the requests of its own instant: they come too early.
    timeline = assign_sequence(timeline, [key, "at", "kind", order], name="pos")
    is_request = (kind == 0) & ~F.col("is_release")
    timeline = save(
        next_position(timeline, [key], "pos", F.when(is_request, F.col("pos")), "next_request"),
        "leases",
    )
    freed = F.when((kind == 0) & F.col("is_release"), F.struct("pos", "next_request"))
    timeline = next_position(timeline, [key, holder], "pos", freed, "freed")

    here = F.when(is_request, F.struct("pos", "at", holder, "freed"))
    links = timeline.groupBy(key, order).agg(
        F.max(here).alias("here"),
        F.max(F.when(kind == 1, F.col("next_request"))).alias("expired"),
    )
    early = F.col("here.freed.pos") < F.coalesce("expired", F.lit(2**63 - 1))
    target = F.when(early, F.col("here.freed.next_request")).otherwise(F.col("expired"))
    links = save(
        links.filter("here IS NOT NULL").select(
            key, order, f"here.{holder}", "here.at", "here.pos", target.alias("target")
        ),
        "leases",
    )

    chain = [save(links.groupBy(key).agg(F.min("pos").alias("pos")).select("pos"), "leases")]
    jumps = links.select("pos", "target").filter("target IS NOT NULL")
    while True:
        seen = Observation()
        reached = reduce(DataFrame.unionAll, chain).join(jumps, "pos")
        reached = reached.select(F.col("target").alias("pos")).observe(seen, F.count("*").alias("n"))
        chain.append(save(reached, "leases"))
        if seen.get["n"] == 0:
            break
        further = jumps.select(F.col("pos").alias("target"), F.col("target").alias("further"))
        jumps = save(
            jumps.join(further, "target").select("pos", F.col("further").alias("target")), "leases"
        )
    granted = links.join(reduce(DataFrame.unionAll, chain), "pos", "left_semi")
    return granted.select(key, holder, order, "at")
