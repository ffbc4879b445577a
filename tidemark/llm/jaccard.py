"""Exact join of word-shingle sets by Jaccard similarity, using relations between sets.

Two ideas keep the work small (set-relation skipping):

- *Blocks.* The index list of a shingle is cut into blocks by set size and holds
  the position of the shingle in each set. Sets in blocks too far apart, or with
  too little left behind the position, are never compared.
- *Answers of a similar set.* One set of every block, its leader (the one whose
  shingles most sets have), is compared with all others. The answers of the
  others follow from those of the leader: two sets that link to it are in one
  component already, and two sets have in common at most what each shares with
  the leader, plus what each has beside the leader that occurs in any other set.
  Only pairs that this leaves open are compared themselves.

Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.native_words import bounded, digest, spare
from tidemark.llm.words import mix, release, shingle_sets
from tidemark.session import save

#: Shingles that a task holds before it hands them on.
FLUSH = 400_000


#: A set's key names its size within this factor in its last ten bits.
STEP = 1.015


def _keys(signs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Eight bytes for a set: 54 bits of its sign and size, and ten that tell about how large it is."""
    with np.errstate(over="ignore"):
        mixed = mix(signs + mix(sizes.astype(np.uint64)))
    level = np.minimum(np.floor(np.log(np.maximum(sizes, 1)) / math.log(STEP)), 1023).astype(np.uint64)
    return mixed >> np.uint64(10) << np.uint64(10) | level


def _least_sizes(keys: np.ndarray) -> np.ndarray:
    """The smallest size that sets with these keys can have."""
    return np.floor(STEP ** (keys & np.uint64(1023)).astype(np.float64) * (1 - 1e-9)).astype(np.int64)


def _blobs(shingles: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """One row per bucket: which sets have shingles in it, and six bytes of these shingles.

    With the number of the bucket that is more than 48 bits. A set is eight bytes
    and, for each 255 of its shingles, one that counts them.
    """
    sizes = np.array([len(s) for s in shingles], np.int64)
    tokens = np.concatenate(shingles)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens ^ np.uint64(0x5BD1E995)), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore"):
        keys = _keys(sums[ends] - sums[ends - sizes], sizes)
    _, kept = np.unique(keys, return_index=True)
    use = np.repeat(np.isin(np.arange(len(sizes)), kept), sizes)
    owner, tokens = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[use], tokens[use]
    bucket = ((tokens >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    owner, tokens, bucket = owner[order], tokens[order], bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = {"bucket": bucket[starts], "keys": [], "counts": [], "tokens": []}
    for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)]):
        own, counts = np.unique(owner[begin:end], return_counts=True)
        times = -(-counts // 255)
        bytes_ = np.full(times.sum(), 255, np.uint8)
        bytes_[np.cumsum(times) - 1] = counts - 255 * (times - 1)
        rows["keys"].append(np.repeat(keys[own], times).tobytes())
        rows["counts"].append(bytes_.tobytes())
        rows["tokens"].append(tokens[begin:end].view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
    return pa.RecordBatch.from_pydict(rows, pa.schema([("bucket", pa.int32()), *((k, pa.binary()) for k in list(rows)[1:])]))


def _members(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, signs = [], []
            for s in shingle_sets(batch.column("text"), width):
                sizes.append(len(s))
                signs.append(mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64))
            sizes, signs = np.array(sizes, np.int64), np.array(signs, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("digest"), pa.array(sizes.astype(np.int32)), pa.array(signs.view(np.int64)),
                    pa.array(_keys(signs, sizes).view(np.int64)),
                ],
                ["doc_id", "digest", "n", "sign", "key"],
            )
        release()

    return run


def _postings(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column("text"), width):
                if len(s):
                    held.append(s)
                    n += len(s)
                if n >= FLUSH:
                    yield _blobs(held, buckets)
                    held, n = [], 0
        if held:
            yield _blobs(held, buckets)
        release()

    return run


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _shared(table: pa.Table) -> pa.Table:
    """The shingles of a bucket that two or more sets have, by group of sets."""
    sets, ids = np.unique(_joined(table, "keys", np.uint64), return_inverse=True)
    owner = np.repeat(ids.astype(np.int32), _joined(table, "counts", np.uint8))
    tokens = np.zeros((len(owner), 8), np.uint8)
    tokens[:, :6] = _joined(table, "tokens", np.uint8).reshape(-1, 6)
    tokens[:, 6:] = np.array([table.column("bucket")[0].as_py() & 0xFFFF], np.uint16).view(np.uint8)
    tokens = tokens.reshape(-1).view(np.uint64)
    order = np.argsort(tokens)
    sorted_tokens = tokens[order]
    same = np.diff(sorted_tokens) == 0
    repeated = np.zeros(len(order), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    order = order[repeated]
    tokens, owner = tokens[order], owner[order]
    order = np.lexsort((owner, tokens))
    tokens, owner = tokens[order], owner[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (np.diff(tokens) != 0) | (np.diff(owner) != 0)
    tokens, owner = tokens[fresh], owner[fresh]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(tokens)), bool), np.diff(tokens) != 0]))
    df = np.diff(np.append(starts, len(tokens)))
    df = np.repeat(df, df).astype(np.int64)
    keep = df > 1
    tokens, owner, df = tokens[keep], owner[keep], df[keep]
    groups = int(table.column("groups")[0].as_py())
    group = ((sets[owner] >> np.uint64(10)) % np.uint64(groups)).astype(np.int32)
    order = np.lexsort((owner, group))
    group, owner, tokens, df = group[order], owner[order], tokens[order], df[order]
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    rows = {"part": group[starts], "keys": [], "counts": [], "tokens": [], "df": []}
    for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
        own, counts = np.unique(owner[begin:end], return_counts=True)
        rows["keys"].append(sets[own].tobytes())
        rows["counts"].append(counts.astype(np.int32).tobytes())
        rows["tokens"].append(tokens[begin:end].tobytes())
        rows["df"].append(np.minimum(df[begin:end], 2**31 - 1).astype(np.int32).tobytes())
    return pa.Table.from_pydict(rows, pa.schema([("part", pa.int32()), *((k, pa.binary()) for k in list(rows)[1:])]))


def _sets(table: pa.Table, percent: int) -> pa.Table:
    """The sets that may have enough shared shingles for a link, rarest shingles first."""
    keys = np.repeat(_joined(table, "keys", np.uint64), _joined(table, "counts", np.int32))
    tokens, df = _joined(table, "tokens", np.uint64), _joined(table, "df", np.int32)
    order = np.lexsort((tokens, df, keys))
    keys, tokens, df = keys[order], tokens[order].view(np.int64), df[order]
    starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
    ends = np.append(starts[1:], len(keys))
    keep = 100 * (ends - starts) >= percent * _least_sizes(keys[starts])
    total = np.add.reduceat(df.astype(np.float64), starts) if len(starts) else np.zeros(0)
    starts, ends, total = starts[keep], ends[keep], total[keep]
    return pa.table(
        {
            "total": pa.array(total, pa.float64()),
            "key": pa.array(keys[starts].view(np.int64), pa.int64()),
            "tokens": pa.array([tokens[b:e] for b, e in zip(starts.tolist(), ends.tolist())], pa.list_(pa.int64())),
        }
    )


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, both, linked``: the size of the intersection of each pair, counted exactly."""
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("tokens_b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    return (
        pairs.join(one, "a").join(two, "b")
        .select("a", "b", both.alias("both"), (F.col("n_a").cast("long") + F.col("n_b")).alias("n"))
        .select(
            "a", "b", "both",
            (100 * F.col("both") >= percent * (F.col("n") - F.col("both"))).alias("linked"),
        )
    )


def _fits(percent: int, n_a: str, n_b: str) -> Column:
    """Whether the sizes of two sets allow a link."""
    a, b = F.col(n_a).cast("long"), F.col(n_b).cast("long")
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _grouped(docs: DataFrame, width: int, percent: int, digests: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``docs`` with their sets, the sets, and the component of each set that links.

    The rows are ``doc_id, digest, n, sign``, where ``digest`` is null unless
    asked for. The sets are ``sign, n, doc, id``: doc is the smallest doc_id and
    id a number of the set itself, so texts under one doc_id, or under none, stay
    sets of their own. The components are ``node, component``, of such numbers.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (digest() if digests else F.lit(None).cast("binary")).alias("digest"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = save(docs.mapInArrow(_members(width), "doc_id long, digest binary, n int, sign long, key long"), "members")
    ids = members.where("n > 0").groupBy("sign", "n").agg(F.min("doc_id").alias("doc"), F.min("key").alias("key"))
    ids = save(ids.withColumn("id", F.monotonically_increasing_id()), "ids")

    postings = docs.select("text").mapInArrow(_postings(width, 2 * parts), "bucket int, keys binary, counts binary, tokens binary")
    shared = postings.withColumn("groups", F.lit(parts)).groupBy("bucket").applyInArrow(
        _shared, "part int, keys binary, counts binary, tokens binary, df binary"
    )
    sets = shared.groupBy("part").applyInArrow(lambda t: _sets(t, percent), "total double, key long, tokens array<long>")
    sets = sets.join(ids.select("key", "id", "n"), "key").where(100 * F.size("tokens").cast("long") >= percent * F.col("n").cast("long"))
    sets = save(sets.select("id", "n", (F.col("total") / F.col("n")).alias("weight"), "tokens"), "sets")

    # Any two sets that link share one of their first n - ceil(n * percent) + 1 shingles; those that
    # no other set has come first and are known to be n minus the number that is left.
    first = F.expr(f"n - (n * {percent}L + 99) div 100 + 1 - (n - size(tokens))").cast("int")
    block = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    entries = (
        sets.where(first > 0)
        .select("id", "n", "weight", F.size("tokens").alias("shared"), block.alias("own"), (F.col("n") - F.size("tokens")).alias("before"), F.posexplode(F.slice("tokens", 1, first)).alias("k", "token"))
        .select("id", "n", "weight", "shared", "token", "own", (F.col("before") + F.col("k")).alias("pos"), F.explode(F.array("own", F.col("own") - 1)).alias("block"))
    )
    counted = entries.groupBy("token", "block").agg(
        F.max(F.struct("weight", F.col("id").alias("leader"), F.col("n").alias("leader_n"))).alias("lead"),
        F.count("*").alias("rows"), F.max((F.col("own") == F.col("block")).cast("int")).alias("home"),
    ).where("rows > 1 and home = 1").select("token", "block", "lead.leader", "lead.leader_n")
    lists = save(entries.join(counted, ["token", "block"]), "lists")

    pair = [F.least("leader", "id").alias("a"), F.greatest("leader", "id").alias("b")]
    starred = lists.where(F.col("leader") != F.col("id")).where(_fits(percent, "n", "leader_n"))
    known = save(_links(starred.select(*pair).distinct(), sets, percent), "known")
    comps = components(known.where("linked").select("a", "b"))
    comps = save(comps, "components")

    # What the leaders' answers leave open: lists whose sets are in several components.
    own = lists.join(comps.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    own = save(own, "entries")
    mixed = own.groupBy("token", "block").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rows = own.join(mixed.select("token", "block"), ["token", "block"], "left_semi")
    rows = rows.select("*", *pair).join(known.select("a", "b", "both"), ["a", "b"], "left").drop("a", "b")
    rows = save(rows.withColumn("both", F.when(F.col("leader") == F.col("id"), F.col("shared")).otherwise(F.col("both"))), "open")
    main = rows.where("leader = id").select("token", "block", F.col("component").alias("main"))
    minor = rows.join(main, ["token", "block"]).where("component <> main")
    # Two sets have in common at most what the leader has with either, and of the rest what they share with any set.
    most = "least(both_x, both_y) + least(shared_x - both_x, shared_y - both_y)"
    side = lambda df, s: df.select("token", "block", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "own", "pos", "component", "shared", "both")))
    rest = (
        side(minor, "x").join(side(rows, "y"), ["token", "block"])
        .where("component_x <> component_y and (own_x = block or own_y = block)")
        .where(_fits(percent, "n_x", "n_y"))
        .where(F.expr(f"{100 + percent} * (1L + least(n_x - pos_x, n_y - pos_y) - 1) >= {percent}L * (n_x + n_y)"))
        .where(F.expr(f"coalesce({100 + percent} * ({most}) >= {percent}L * (n_x + n_y), true)"))
        .select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()
        .join(known.select("a", "b"), ["a", "b"], "left_anti")
    )
    rest = save(rest, "rest")
    more = _links(rest, sets, percent).where("linked").select(F.col("a"), F.col("b"))
    comps = save(components(known.where("linked").select("a", "b").union(more)), "components")

    return members, ids, comps


def linked_components(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The component of each document under links between similar word sets.

    Reads ``doc_id, text`` of ``docs`` and no other column. Words are runs without
    white space, lower-cased in A-Z; a set holds the distinct runs of ``width``
    words, or the whole sequence if it is shorter. Two documents link if
    100 * intersection >= ``percent`` * union. Returns ``doc_id, n_shingles,
    component_id`` with one row per row of ``docs``; component_id is the smallest
    doc_id reachable by links, the row's own included. Null and empty texts have
    no shingles and stand alone. Rows that repeat a doc_id are kept; a null doc_id
    counts for no minimum, and gives null where the component has no other.

    Plan: texts are cut into sets twice, once for their sizes and signatures and
    once for their shingles, which travel packed to the bucket of their hash.
    Buckets send back only shingles of two or more different sets; a set keeps
    going only if enough of its shingles came back. Equal sets count once from
    the first bucket on. All that follows works on sets that have a chance.
    """
    members, ids, comps = _grouped(docs, width, percent, False)
    # Sets that link to no other have the smallest of their own rows.
    linked = save(ids.join(comps.withColumnRenamed("node", "id"), "id").select("sign", "n", "doc", "component"), "linked")
    lowest = save(linked.groupBy("component").agg(F.min("doc").alias("low")), "lowest")
    lows = linked.join(bounded(lowest, lowest.count()), "component").select("sign", "n", "low", F.lit(True).alias("links"))
    groups = ids.join(lows, ["sign", "n"], "left").select("sign", "n", F.when(F.col("links"), F.col("low")).otherwise(F.col("doc")).alias("component_id"))
    return members.join(groups, ["sign", "n"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component of similar documents: that with the smallest doc_id.

    Of rows that repeat this doc_id the one with the smallest text stays, and one
    of those that repeat the text too. Rows without doc_id come after all others.
    Null and empty texts have no shingles and all stay. All columns are returned.

    Rows are told by doc_id and text, so a further text of a doc_id is decided
    for itself. Texts move only where several of them share the smallest doc_id
    of a component.
    """
    id_, own, sha = spare(docs, "id", "digest", "sha")
    members, ids, comps = _grouped(docs, width, percent, True)
    sets = ids.join(comps.withColumnRenamed("node", "id"), "id", "left").select("sign", "n", F.coalesce("component", "id").alias("component"))
    keys = members.join(sets, ["sign", "n"]).groupBy("component", "doc_id", "digest").agg(F.count("*").alias("times"))
    keys = save(keys, "keys")
    several = keys.groupBy("component").agg(F.min("doc_id").alias("low"), F.sum("times").alias("rows")).where("rows > 1")
    several = save(several.select("component", "low"), "several")
    keys = save(keys.join(bounded(several, several.count()), "component"), "several_rows")
    first = keys.where("doc_id <=> low").select("component", "doc_id", "digest")
    tied = save(first.groupBy("component").agg(F.count("*").alias("texts")).where("texts > 1").select("component"), "tied")
    tied = bounded(tied, tied.count())
    ties = save(first.join(tied, "component", "left_semi").select("component", F.col("doc_id").alias(id_), F.col("digest").alias(own)), "ties")
    marked = docs.withColumn(sha, digest())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(sha) == F.col(own))
    texts = marked.select("doc_id", F.col("text").cast("string").alias("text"), sha).join(bounded(ties, ties.count()), same)
    smallest = texts.groupBy("component").agg(F.min(F.struct("text", sha)).alias("least")).select("component", F.col(f"least.{sha}").alias("winner"))
    # A component of one doc_id and text is its own winner; of the tied ones the smallest text is.
    stays = first.join(tied, "component", "left_anti").select("component", F.col("digest").alias("winner")).unionByName(smallest)
    stays = save(stays, "stays")
    keys = keys.join(bounded(stays, stays.count()), "component")
    stay = (F.col("doc_id").eqNullSafe(F.col("low"))) & (F.col("digest") == F.col("winner"))
    keys = keys.select(F.col("doc_id").alias(id_), F.col("digest").alias(own), stay.alias("stays"), "times")
    gone = save(keys.where("times > 1 or not stays").select(id_, own, "stays"), "gone")
    repeated = save(gone.where("stays").select(id_, own), "repeated")
    n_repeated = repeated.count()
    others = marked.join(bounded(gone.drop("stays"), gone.count()), same, "left_anti")
    if n_repeated:
        again = marked.join(bounded(repeated, n_repeated), same, "left_semi").dropDuplicates(["doc_id", sha])
        others = others.unionByName(again)
    return others.drop(sha)
