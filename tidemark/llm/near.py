"""Similar word sets found by chosen paths, and their components.

A *node* is a group of sets that took the same path of selected minwise tokens.
Each of several independent trees sends every set along the token that its first
hash function selects. Nodes that are small are compared exhaustively on short
sketches. Others are met by their leader first; those that this leaves in more
than one component branch again by further coordinates, some of them twice. Two
similar sets take the same branch with a chance of their similarity, so that a
number of trees makes a miss as rare as wished.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import extended
from tidemark.llm.native_words import bounded, digest
from tidemark.llm.words import mix, release, shingle_sets
from tidemark.session import save

#: Independent trees; a link at the threshold is lost by all of them with a chance of (1 - 0.85)**8, 3e-7.
TREES = 8
#: Coordinates of a sketch, one byte each, for later branches and for estimates.
COORDINATES = 128
#: Sets of a node that are compared exhaustively in one task.
SMALL = 512
#: Rows of a node, and pairs to estimate, up to which those beside its largest component are compared with all.
ROOM, WORK = 1 << 16, 1 << 25
#: Branches of a node that is not small, by different coordinates, and how often nodes may branch.
BRANCHES, DEPTH = 2, 12
#: Pairs of a row confirmed before its node's sets meet, the most similar ones.
TOP = 4
#: Shingles of the sets that ask in one task; those of a node that has more are dealt to several.
HELD = 1 << 20
#: Pairs whose estimate lies so many standard deviations below the threshold are not confirmed.
SLACK = 3.5
#: Shingles hashed at once.
PIECE = 2048

FACTORS = mix(np.arange(1, TREES + COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """For each hash function the least value over a set, by which its token is selected."""
    low = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), PIECE):
            np.minimum(low, (FACTORS[:, None] * shingles[None, at : at + PIECE]).min(axis=1), out=low)
    return low


def _sign(shingles: np.ndarray) -> np.int64:
    return np.array([mix(shingles ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64)]).view(np.int64)[0]


def _members(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, signs, tokens, sketches = [], [], [], []
            for s in shingle_sets(batch.column("text"), width):
                low = minwise(s)
                sizes.append(len(s))
                signs.append(_sign(s))
                tokens.append(low[:TREES].view(np.int64).tolist())
                sketches.append(mix(low[TREES:]).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("digest"), pa.array(sizes, pa.int32()), pa.array(np.array(signs, np.int64)),
                    pa.array(tokens, pa.list_(pa.int64())), pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "digest", "n", "sign", "tokens", "sketch"],
            )
        release()

    return run


def _shingles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), width))
            for at in range(0, len(sets), 64):
                some = sets[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(at, 64), pa.array([len(s) for s in some], pa.int32()), pa.array([_sign(s) for s in some], pa.int64()),
                        pa.array([np.sort(s).view(np.int64) for s in some], pa.list_(pa.int64())),
                    ],
                    ["id", "n", "sign", "shingles"],
                )

    return run


def _equal_bytes(sketches: np.ndarray, one: np.ndarray, two: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """For each pair of rows the equal bytes of their sketches, or -1 if these or their sizes rule out a link."""
    share = percent / 100
    equal = (sketches[one] == sketches[two]).sum(axis=1)
    # Bytes of different tokens are equal with a chance of 1/256; this only raises the estimate.
    least = COORDINATES * share - SLACK * math.sqrt(COORDINATES * share * (1 - share))
    low, high = np.minimum(sizes[one], sizes[two]), np.maximum(sizes[one], sizes[two])
    return np.where((equal >= least) & (100 * low >= percent * high), equal, -1)


def _whole_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows in order of nodes of at most ``ROOM`` rows, first row and number of rows of each; only the last node of a batch is held for the next."""

    def whole(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held)
        nodes = table.column("node").to_numpy()
        starts = np.flatnonzero(np.diff(nodes, prepend=~nodes[:1]) != 0)
        return table, starts, np.diff(np.append(starts, len(nodes)))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column("node").to_numpy()
        last = int(np.flatnonzero(np.diff(nodes, prepend=~nodes[:1]) != 0)[-1])
        if last or (held and held[-1].column("node")[-1].as_py() != nodes[0]):
            yield whole([*held, batch.slice(0, last)] if last else held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield whole(held)


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(table), -1)
    return table.column("id").to_numpy(), sketches, table.column("n").to_numpy().astype(np.int64), table.column("component").to_numpy()


def _similar(sketches, sizes, comps, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each row of a node that asks, the rows of other components that it may link to, and their equal bytes.

    Rows of the largest component ask nothing; the others are compared with all.
    """
    _, code, n = np.unique(comps, return_inverse=True, return_counts=True)
    asks = np.flatnonzero(code != n.argmax()) if n.max() > 1 else np.arange(len(comps))
    for k in asks.tolist():
        others = np.flatnonzero(comps != comps[k])
        equal = _equal_bytes(sketches, np.full(len(others), k), others, sizes, percent)
        if (equal >= 0).any():
            yield k, others[equal >= 0], equal[equal >= 0]


def _likeliest(percent: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs across components that may link, the ``top`` most similar ones of each row; a node that has more gives a row without a pair."""
        for table, starts, n in _whole_nodes(batches):
            nodes, (ids, sketches, sizes, comps) = table.column("node").to_numpy(), _columns(table)
            two = starts[n == 2]  # most nodes are one pair
            two = two[(comps[two] != comps[two + 1]) & (_equal_bytes(sketches, two, two + 1, sizes, percent) >= 0)]
            ones, twos, more = [np.minimum(ids[two], ids[two + 1])], [np.maximum(ids[two], ids[two + 1])], []
            for at, size in zip(starts[n > 2].tolist(), n[n > 2].tolist()):
                part, cut = slice(at, at + size), False
                for k, others, equal in _similar(sketches[part], sizes[part], comps[part], percent):
                    others = at + others
                    if len(others) > top:
                        others, cut = others[np.lexsort((ids[others], -equal))[:top]], True
                    ones.append(np.minimum(ids[at + k], ids[others]))
                    twos.append(np.maximum(ids[at + k], ids[others]))
                if cut:
                    more.append(nodes[at])
            one, two = np.concatenate(ones), np.concatenate(twos)
            columns = [pa.array(one), pa.array(two), pa.nulls(len(one), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "node"])
            columns = [pa.nulls(len(more), pa.int64()), pa.nulls(len(more), pa.int64()), pa.array(more, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "node"])

    return run


def _open(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of nodes that may link across components, and whether they ask."""
        for table, starts, n in _whole_nodes(batches):
            _, sketches, sizes, comps = _columns(table)
            asks, met = np.zeros(len(table), bool), np.zeros(len(table), bool)
            for at, size in zip(starts.tolist(), n.tolist()):
                part = slice(at, at + size)
                for k, others, _ in _similar(sketches[part], sizes[part], comps[part], percent):
                    asks[at + k] = met[at + k] = True
                    met[at + others] = True
            yield from table.append_column("asks", pa.array(asks)).filter(pa.array(met)).to_batches()

    return run


class _Asking:
    """The sets of a node that ask, and the components that links have joined."""

    def __init__(self, percent: int):
        self.percent, self.parts, self.sets, self.joined = percent, [], [], {}

    def add(self, ids: np.ndarray, sketches: np.ndarray, comps: np.ndarray, sets: list[np.ndarray]) -> None:
        self.parts.append((ids, sketches, comps))
        self.sets += sets

    def _label(self, comp: int) -> int:
        while comp in self.joined:
            comp = self.joined[comp]
        return comp

    def links(self) -> Iterator[tuple[int, int]]:
        """Links among the sets that ask, as many as join components; after that others may come."""
        self.ids, self.sketches, self.labels = (np.concatenate(x) for x in zip(*self.parts))
        self.sizes = np.array(list(map(len, self.sets)))
        every = np.concatenate(self.sets)
        order = np.argsort(every, kind="stable")
        self.owner = np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        self.values, self.starts, self.counts = np.unique(every[order], return_index=True, return_counts=True)
        for k, one in enumerate(self.sets):
            yield from self.of(self.ids[k], self.sketches[k], self.labels[k], one, k)

    def of(self, id_: int, sketch: np.ndarray, comp: int, one: np.ndarray, before: int | None = None) -> Iterator[tuple[int, int]]:
        """Links of one set with those that ask, or with the first ``before`` of them."""
        label = self._label(int(comp))
        rows = np.flatnonzero(self.labels[:before] != label)
        if not len(rows):
            return
        sketches, sizes = np.concatenate([self.sketches[rows], sketch[None]]), np.append(self.sizes[rows], len(one))
        last = np.full(len(rows), len(rows))
        rows = rows[_equal_bytes(sketches, np.arange(len(rows)), last, sizes, self.percent) >= 0]
        if not len(rows):
            return
        at = np.minimum(np.searchsorted(self.values, one), len(self.values) - 1)
        at = at[self.values[at] == one]
        n = self.counts[at]
        held = self.owner[np.repeat(self.starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        both = np.bincount(held, minlength=len(self.sets))[rows]
        for k in rows[100 * both >= self.percent * (self.sizes[rows] + len(one) - both)].tolist():
            if self.labels[k] != label:
                yield min(int(self.ids[k]), int(id_)), max(int(self.ids[k]), int(id_))
                old, self.joined[label] = label, int(self.labels[k])
                label = self.joined[label]
                self.labels[self.labels == old] = label


def _links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links that join components of a node, by full sets; rows come by node, those that ask first, and only these are held."""
        node, asking, open_ = None, None, False
        for batch in batches:
            nodes, asks = batch.column("node").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            ids, sketches, _, comps = _columns(pa.Table.from_batches([batch]))
            lists, found = batch.column("shingles"), []
            values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for k in range(batch.num_rows):
                if nodes[k] != node:
                    if open_:
                        found += asking.links()
                    node, asking, open_ = nodes[k], _Asking(percent), False
                one = values[ends[k] : ends[k + 1]]
                if asks[k]:
                    asking.add(ids[k : k + 1], sketches[k : k + 1], comps[k : k + 1], [one.copy()])
                    open_ = True
                    continue
                if open_:
                    found += asking.links()
                    open_ = False
                if asking.sets:
                    found += asking.of(ids[k], sketches[k], comps[k], one)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])
        if open_ and (found := list(asking.links())):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])

    return run


def _full_sets(ids: DataFrame, docs: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """``id, n, shingles`` of the sets in ``ids``; only their texts are read again."""
    wanted = save(ids.distinct(), "wanted")
    wanted = save(sets.select("id", "doc", "digest", F.col("n").alias("size"), F.col("sign").alias("signature")).join(wanted, "id"), "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("own") == F.col("digest"))
    rows = docs.select("doc_id", "text", digest().alias("own")).join(bounded(wanted, wanted.count()), same).select("id", "text")
    full = rows.mapInArrow(_shingles(width), "id long, n int, sign long, shingles array<long>").dropDuplicates(["id"])
    return save(full.select("id", "n", "shingles"), "shingles")


def _confirmed(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b`` of the pairs that link, by their full sets."""
    full = _full_sets(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), docs, sets, width)
    one = full.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = full.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    met = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.col("n_a").cast("long") + F.col("n_b")).alias("all"))
    return save(met.where(100 * F.col("both") >= percent * (F.col("all") - F.col("both"))).select("a", "b"), "links")


def _joining(rows: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """``a, b``: links that join components in nodes, a node's sets being compared in its task; ``rows`` come in order of nodes."""
    rows = save(rows.mapInArrow(_open(percent), "node long, id long, n int, sketch binary, component long, asks boolean"), "open")
    full = _full_sets(rows.select("id"), docs, sets, width).select("id", "shingles")
    parts = rows.where("asks").groupBy("node").agg(F.ceil(F.sum("n") / HELD).cast("int").alias("parts"))
    dealt = rows.join(parts, "node").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asks = F.col("asks") & (F.pmod(F.xxhash64("id"), F.col("parts")) == F.col("part"))
    dealt = dealt.select(F.xxhash64("node", "part").alias("node"), "id", "n", "sketch", "component", asks.alias("asks")).join(full, "id")
    dealt = dealt.repartition("node").sortWithinPartitions("node", F.desc("asks"))
    return save(dealt.mapInArrow(_links(percent), "a long, b long"), "links")


def _with_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    rows = rows.drop("component")
    return rows.join(comps.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))


def _mixed(nodes: DataFrame) -> DataFrame:
    """The nodes whose rows are in more than one component."""
    return nodes.groupBy("node").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("node")


def _nodes(sets: DataFrame, docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Small nodes (``node, id``), and the components by links between leaders and members of all others."""
    spark = sets.sparkSession
    at = sets.select("id", F.posexplode("tokens").alias("tree", "token")).select(F.xxhash64("tree", "token").alias("node"), "id")
    small, links = [], spark.createDataFrame([], "a long, b long")
    comps = spark.createDataFrame([], "node long, component long")
    key = F.struct(F.xxhash64("id"), F.col("id"))
    for depth in range(DEPTH + 1):
        at = save(at, "nodes")
        sizes = at.groupBy("node").agg(F.count("*").alias("rows"), F.max(key).alias("leader")).where("rows > 1")
        sizes = save(sizes.select("node", "rows", F.col("leader.id").alias("leader")), "sizes")
        few = at.join(sizes.where(F.col("rows") <= SMALL).select("node"), "node", "left_semi")
        large = sizes.where(F.col("rows") > SMALL)
        n_large = large.count()
        small.append(few)
        if not n_large:
            break
        rows = save(at.join(bounded(large.select("node", "rows", "leader"), n_large), "node"), "large")
        pairs = rows.where("id <> leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
        pairs = save(pairs.join(links, ["a", "b"], "left_anti"), "pairs")
        found = _confirmed(pairs, docs, sets, width, percent)
        links, comps = links.union(found), save(extended(comps, found), "components")
        rows = save(_with_components(rows, comps), "large")
        # Only rows beside a node's largest component have anything to ask: they are compared with all if this is little work.
        asks = rows.groupBy("node", "component").agg(F.count("*").alias("own")).groupBy("node").agg(F.sum("own").alias("all"), F.max("own").alias("main"))
        asks = save(asks.where(F.col("all") > F.col("main")), "asks")
        little = (F.col("all") <= ROOM) & (F.col("all") * (F.col("all") - F.col("main")) <= WORK)
        asks = bounded(asks.select("node", little.alias("little")), asks.count())
        rows = save(rows.join(asks, "node"), "mixed")
        small.append(rows.where("little").select("node", "id"))
        rows = rows.where("not little")
        if rows.isEmpty():
            break
        if depth < DEPTH:
            # The node's own hash selects the coordinates; each row goes on to one child for each.
            coordinate = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.lit(COORDINATES)).cast("int")
            byte = lambda k: F.substring("sketch", coordinate(k) + 1, F.lit(1))
            children = F.explode(F.array(*(F.xxhash64("node", F.lit(k), byte(k)) for k in range(BRANCHES))))
            at = rows.join(sets.select("id", "sketch"), "id").select(children.alias("node"), "id")
        else:
            # What never got small is compared in blocks, each pair of blocks as a node: nothing is left out.
            blocks = F.greatest(F.lit(2), F.ceil(F.col("rows") / (SMALL // 2))).cast("int")
            own = F.pmod(F.xxhash64("id", F.lit(1)), blocks)
            other = F.explode(F.sequence(F.lit(0), blocks - 1))
            dealt = rows.select("node", "id", own.cast("int").alias("own"), other.alias("other"))
            small.append(dealt.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "id"))
    nodes = small[0]
    for more in small[1:]:
        nodes = nodes.unionByName(more)
    return save(nodes.distinct(), "small"), comps


def near_components(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """The component of each document under links between similar word sets, and whether it stays.

    Reads ``doc_id, text`` of ``docs`` and no other column. Words are runs without
    white space, lower-cased in A-Z; a set holds the distinct runs of ``width``
    words, or the whole sequence if it is shorter. Two documents link if
    100 * intersection >= ``percent`` * union of their full sets. Returns
    ``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``;
    component_id is the smallest doc_id reachable by links, the row's own
    included, and the row that has it is kept. Null and empty texts have no
    shingles and stand alone. Rows that repeat a doc_id are kept rows each; a null
    doc_id counts for no minimum and is kept only where the component has no
    other. An empty table gives no row.

    Equal sets count once from the start, so copies cost nothing more. Only hashes
    travel along the trees: eight bytes for a row of a node, and a sketch of
    ``COORDINATES`` bytes where a node is compared or branches. Full sets move
    only where sketches agree. In a node most pairs follow from a spanning forest
    of the likeliest links, ``TOP`` of a row. Where more may link across the
    components that this gives, the full sets meet in the node's task: it compares
    all pairs whose sketches agree and hands on no more links than join components,
    so tables grow with the rows of nodes and not with their pairs. Links found are exact; a link is missed
    with the chance named at ``TREES``, and 2e-4 for ``SLACK`` if it lies just at the threshold.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.select("doc_id", "text", digest().alias("digest")).mapInArrow(
        _members(width), "doc_id long, digest binary, n int, sign long, tokens array<long>, sketch binary"
    )
    rows = save(rows, "members")
    # The row that stands for a set is that of the smallest doc_id, and of its texts that with the smallest digest.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("first")
    sets = rows.where("n > 0").groupBy("sign", "n").agg(first, F.min("tokens").alias("tokens"), F.min("sketch").alias("sketch"))
    sets = sets.select("sign", "n", F.col("first.doc_id").alias("doc"), F.col("first.digest").alias("digest"), "tokens", "sketch")
    sets = save(sets.withColumn("id", F.monotonically_increasing_id()), "sets")

    nodes, comps = _nodes(sets, docs, width, percent)

    def in_order(nodes: DataFrame) -> DataFrame:
        at = save(_with_components(nodes, comps), "at")
        # A node within one component has no more to say.
        at = at.join(_mixed(at), "node", "left_semi").join(sets.select("id", "n", "sketch"), "id")
        return at.select("node", "id", "n", "sketch", "component").repartition("node").sortWithinPartitions("node")

    likely = save(in_order(nodes).mapInArrow(_likeliest(percent, TOP), "a long, b long, node long"), "likely")
    pairs = save(likely.where("a is not null").select("a", "b").distinct(), "pairs")
    comps = save(extended(comps, _confirmed(pairs, docs, sets, width, percent)), "components")
    # All pairs of other nodes that may link have been confirmed or refused.
    more = save(likely.where("a is null").select("node"), "more")
    rest = nodes.join(bounded(more, more.count()), "node", "left_semi")
    comps = save(extended(comps, _joining(in_order(rest), docs, sets, width, percent)), "components")

    linked = save(sets.join(comps.withColumnRenamed("node", "id"), "id").select("sign", "n", "doc", "component"), "linked")
    lowest = save(linked.groupBy("component").agg(F.min("doc").alias("low")), "lowest")
    lows = linked.join(bounded(lowest, lowest.count()), "component").select("sign", "n", "low", F.lit(True).alias("links"))
    groups = sets.select("sign", "n", "doc").join(lows, ["sign", "n"], "left")
    groups = groups.select("sign", "n", F.when(F.col("links"), F.col("low")).otherwise(F.col("doc")).alias("low"))
    component = F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n", "sign").join(groups, ["sign", "n"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
