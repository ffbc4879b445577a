"""Conversations whose messages fail the order of roles, repaired by the cheapest edits.

The edits of a conversation are paths through nodes (messages done, state of the
roles). Costs to the end come from a table of least costs, read from the last
message to the first. Arcs that keep a node's cost are optimal; among them the
least audit is found by prefix doubling: nodes are ranked by the least audits of
1, 2, 4, ... letters, each from the ranks of its halves, and every rank comes
with a pointer over as many arcs. The pointers then give the path itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.native_words import bounded
from tidemark.session import save

#: Messages of a conversation that one task solves at once; a longer one is solved in parts of so many.
PART = 16_384
#: Messages gathered before they are solved together.
ROWS = 8_192

#: Costs of the edits, and of a message that stays truncated.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after a system message, after one of the user, after one of the assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: By state, the state after a user or assistant message if one may follow (only one of both may).
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: States in which a conversation may end.
ENDS = (START, ASSISTANT)
#: Roles by the class of their first letter; class 0 is any other.
CLASSES = {"s": 1, "u": 2, "a": 3}
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAULTS = BLANK, DUPLICATE, CUT = 1, 2, 3
LETTERS = np.array(["", "D", "I", "K", "R"])
D, I, K, R = 1, 2, 3, 4  # in the order of their letters
FAR = 1 << 40
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def _kept_states() -> np.ndarray:
    """By state and class, the state after a message that is kept, or -1."""
    table = np.full((4, 4), -1)
    table[START, CLASSES["s"]] = SYSTEM
    for state in range(4):
        letter = "u" if NEXT[state] == USER else "a"
        table[state, CLASSES[letter]] = NEXT[state]
    return table


KEPT = _kept_states()
LEGAL = {(CLASSES[x], CLASSES[y]) for x, y in ("su", "ua", "au")}


class Solved:
    """Paths of many runs of messages, each a conversation or a part of one.

    ``kinds`` and ``faults`` hold the class and fault of each message, ``lengths``
    the messages of each run, ``exits`` the costs of what follows a run by state.
    Runs in ``last`` end their conversation, so messages may be inserted at their end.
    """

    def __init__(self, kinds: np.ndarray, faults: np.ndarray, lengths: np.ndarray, exits: np.ndarray, last: np.ndarray) -> None:
        n_runs = len(lengths)
        self.lengths = lengths
        first = np.cumsum(lengths) - lengths
        self.layer = first + np.arange(n_runs)  # a run of n messages has n + 1 layers of four nodes
        layers = int(lengths.sum()) + n_runs
        cost = np.full((layers, 4), FAR, np.int64)
        arcs = np.full((layers, 4, 5), FAR, np.int64)
        target = np.tile(np.arange(layers * 4).reshape(layers, 4, 1), (1, 1, 5))

        ends = self.layer + lengths
        cost[ends] = exits
        arcs[ends, :, 0] = exits
        target[:, :, I] = np.arange(layers)[:, None] * 4 + NEXT
        closing = ends[last]
        self._insert(cost, arcs, closing)
        order = np.argsort(-lengths, kind="stable")
        longest = lengths[order]
        for back in range(1, int(longest[0]) + 1 if n_runs else 1):
            runs = order[: np.searchsorted(-longest, -back, side="right")]
            at, row = self.layer[runs] + lengths[runs] - back, first[runs] + lengths[runs] - back
            after = cost[at + 1]
            kind, fault = kinds[row], faults[row]
            arcs[at, :, D] = after + DELETE
            target[at, :, D] = (at + 1)[:, None] * 4 + np.arange(4)
            stays = np.where((fault == BLANK) | (fault == DUPLICATE), FAR, np.where(fault == CUT, TRUNCATED, 0))[:, None]
            kept = KEPT[:, kind].T
            arcs[at, :, K] = np.where(kept < 0, FAR, np.take_along_axis(after, np.maximum(kept, 0), axis=1) + stays)
            target[at, :, K] = (at + 1)[:, None] * 4 + np.maximum(kept, 0)
            arcs[at, :, R] = after[:, NEXT] + REROLE + stays
            target[at, :, R] = (at + 1)[:, None] * 4 + NEXT
            cost[at] = arcs[at].min(axis=2)
            self._insert(cost, arcs, at)
        self.cost = cost

        # Optimal arcs keep the cost; the end of a run is an arc of length zero.
        optimal = (arcs == cost[:, :, None]).reshape(-1, 5)
        optimal[(cost >= FAR).ravel()] = [True, False, False, False, False]
        target = target.reshape(-1, 5)
        target[:, 0] = np.arange(len(target))
        labels = np.where(optimal, np.arange(5), 9)
        labels[optimal[:, 0], 1:] = 9
        nodes = np.arange(len(target))
        # Arcs of a node have different letters, so the rank of one letter selects the arc.
        chosen = labels.argmin(axis=1)
        self.label = labels[nodes, chosen]
        ranks, pointer = self.label.copy(), target[nodes, chosen]
        steps = (self.label > 0).astype(np.int64)
        self.pointers, self.steps = [pointer], steps
        while (self.label[pointer] > 0).any():
            _, ranks = np.unique(ranks * (int(ranks.max()) + 1) + ranks[pointer], return_inverse=True)
            steps = steps + steps[pointer]
            pointer = pointer[pointer]
            self.pointers.append(pointer)
            self.steps = steps
        self.ranks = ranks

    @staticmethod
    def _insert(cost: np.ndarray, arcs: np.ndarray, at: np.ndarray) -> None:
        """Inserted messages before the messages at layers ``at``; more than two in a row never help."""
        for _ in range(2):
            arcs[at, :, I] = cost[at][:, NEXT] + INSERT
            cost[at] = np.minimum(cost[at], arcs[at, :, I])

    def begins(self, state: np.ndarray) -> np.ndarray:
        """The node of each run before its first message, in ``state``."""
        return self.layer * 4 + state

    def ends(self, state: np.ndarray) -> np.ndarray:
        """The state in which the least path of each run leaves it."""
        return self.pointers[-1][self.begins(state)] % 4

    def paths(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All nodes of the least paths but their last, run by run, and the number of each run's."""
        begin = self.begins(state)
        n = self.steps[begin]
        node = np.repeat(begin, n)
        nth = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n)
        for k, pointer in enumerate(self.pointers):
            node = np.where(nth >> k & 1 == 1, pointer[node], node)
        return node, n


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of ``rows`` with planted faults, as a test of ``repair``.

    By crc32 of ``conv_id:turn`` modulo 20 a message is dropped (0), emptied (1),
    loses its ``.!?`` (2), is repeated (3) or gets the role user (4). A null role
    or text is one space, and so is a null in what is hashed.
    """
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    times = F.when(F.col("fate") == 0, 0).when(F.col("fate") == 3, 2).otherwise(1)
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (
        rows.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), fate.alias("fate"))
        .withColumn("times", F.explode(F.array_repeat(F.lit(1), times)))
        .select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))
    )


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
PARTS = (
    "part long, cost long, audit string, roles array<string>, texts array<string>, "
    "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long"
)


def _schema(conv_type: pa.DataType) -> pa.Schema:
    texts = pa.list_(pa.string())
    return pa.schema([
        ("conv_id", conv_type), ("part", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("roles", texts), ("texts", texts),
        *((name, pa.int64()) for name in (*COUNTS, "low", "high")),
    ])


class Runs:
    """Messages in order, as runs of one conversation each."""

    def __init__(self, table: pa.Table, starts: np.ndarray) -> None:
        self.turn = table.column("turn").to_pylist()
        self.role, self.text = table.column("role").to_pylist(), table.column("text").to_pylist()
        self.starts = starts
        self.lengths = np.diff(np.append(starts, table.num_rows))
        self.kinds = np.fromiter((CLASSES.get(r[:1], 0) for r in self.role), np.int64, table.num_rows)
        self.run = np.repeat(np.arange(len(starts)), self.lengths)
        flag = lambda name: table.column(name).to_numpy()
        again = flag("again") if "again" in table.column_names else self._again()
        self.faults = np.where(flag("blank"), BLANK, np.where(again, DUPLICATE, np.where(flag("cut"), CUT, 0)))

    def _again(self) -> np.ndarray:
        found, seen = np.zeros(len(self.role), bool), set()
        for k, key in enumerate(zip(self.run.tolist(), self.role, self.text)):
            found[k] = key in seen
            seen.add(key)
        return found

    def counts(self) -> list[dict[str, int | None]]:
        """What each run adds up to, without its neighbours."""
        n = len(self.starts)
        by_fault = [np.bincount(self.run[self.faults == f], minlength=n) for f in FAULTS]
        pairs = np.flatnonzero(self.run[1:] == self.run[:-1])
        wrong = np.array([(x, y) not in LEGAL for x, y in zip(self.kinds[pairs].tolist(), self.kinds[pairs + 1].tolist())], bool)
        illegal = np.bincount(self.run[pairs[wrong]] if len(pairs) else [], minlength=n)
        rows = []
        for k, (begin, length) in enumerate(zip(self.starts.tolist(), self.lengths.tolist())):
            turns = {t for t in self.turn[begin : begin + length] if t is not None}
            rows.append({
                "blank": int(by_fault[0][k]), "duplicate": int(by_fault[1][k]), "truncated": int(by_fault[2][k]), "illegal": int(illegal[k]),
                "turns": len(turns), "low": min(turns, default=None), "high": max(turns, default=None),
            })
        return rows

    def edits(self, solved: Solved, state: np.ndarray) -> list[tuple[str, list[str], list[str]]]:
        """The audit of each run and its messages after the edits."""
        nodes, n = solved.paths(state)
        labels, after = solved.label[nodes].tolist(), (solved.pointers[0][nodes] % 4).tolist()
        row = (nodes // 4 - np.repeat(solved.layer, n) + np.repeat(self.starts, n)).tolist()
        letters, out, at = "".join(LETTERS[labels]), [], 0
        for k in n.tolist():
            roles, texts = [], []
            for label, state_after, r in zip(labels[at : at + k], after[at : at + k], row[at : at + k]):
                if label == K:
                    roles.append(self.role[r])
                    texts.append(self.text[r])
                elif label == R:
                    roles.append(NAMES[state_after])
                    texts.append(self.text[r])
                elif label == I:
                    roles.append(NAMES[state_after])
                    texts.append("")
            out.append((letters[at : at + k], roles, texts))
            at += k
        return out


#: Costs of an end by state, before messages are inserted there.
LAST_EXITS = np.array([0 if state in ENDS else FAR for state in range(4)])


def _starts(ids: pa.ChunkedArray) -> np.ndarray:
    """Where runs of equal ids begin; null equals null."""
    codes = ids.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.flatnonzero(np.diff(codes, prepend=-1) != 0)


def _solve_whole(table: pa.Table) -> pa.RecordBatch:
    starts = _starts(table.column("conv_id"))
    runs = Runs(table, starts)
    n = len(starts)
    solved = Solved(runs.kinds, runs.faults, runs.lengths, np.tile(LAST_EXITS, (n, 1)), np.ones(n, bool))
    begin = np.full(n, START)
    costs = solved.cost.ravel()[solved.begins(begin)].tolist()
    ids = table.column("conv_id").take(pa.array(starts)).to_pylist()
    rows = [
        {"conv_id": c, "part": 0, "cost": cost, "audit": audit, "roles": roles, "texts": texts, **counts}
        for c, cost, (audit, roles, texts), counts in zip(ids, costs, runs.edits(solved, begin), runs.counts())
    ]
    return pa.RecordBatch.from_pylist(rows, _schema(table.schema.field("conv_id").type))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations that each lie within a partition, in order."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < ROWS:
            continue
        table = pa.Table.from_batches(held)
        end = int(_starts(table.column("conv_id"))[-1])  # the last conversation may go on
        if end:
            yield _solve_whole(table.slice(0, end))
        held = table.slice(end).combine_chunks().to_batches()
    if sum(b.num_rows for b in held):
        yield _solve_whole(pa.Table.from_batches(held))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Long conversations in order, cut into parts of ``PART`` messages, with the costs through each part."""
    place, nth = TaskContext.get().partitionId(), 0
    schema = None

    def part(table: pa.Table) -> pa.RecordBatch:
        runs = Runs(table, np.array([0]))
        n = len(runs.role)
        # One copy of the part for each state in which it may be left.
        exits = np.where(np.eye(4, dtype=bool), 0, FAR)
        solved = Solved(np.tile(runs.kinds, 4), np.tile(runs.faults, 4), np.full(4, n), exits, np.zeros(4, bool))
        through = np.array([solved.cost.ravel()[solved.begins(np.full(4, s))] for s in range(4)])
        counts = runs.counts()[0]
        row = {
            "conv_id": table.column("conv_id")[0].as_py(), "place": place, "nth": nth, "through": np.minimum(through, FAR).ravel().tolist(),
            "turn": runs.turn, "role": runs.role, "text": runs.text, "fault": runs.faults.tolist(),
            "first_kind": int(runs.kinds[0]), "last_kind": int(runs.kinds[-1]), "first_turn": runs.turn[0], "last_turn": runs.turn[-1], **counts,
        }
        return pa.RecordBatch.from_pylist([row], schema)

    held: pa.Table | None = None
    for batch in batches:
        schema = schema or _part_schema(batch.schema.field("conv_id").type)
        held = pa.Table.from_batches([*(held.to_batches() if held is not None else []), batch])
        while held.num_rows:
            starts = _starts(held.column("conv_id"))
            end = int(starts[1]) if len(starts) > 1 else held.num_rows
            if end < PART and len(starts) == 1:
                break  # it may go on
            yield part(held.slice(0, min(end, PART)))
            nth += 1
            held = held.slice(min(end, PART))
    if held is not None and held.num_rows:
        yield part(held)


#: Columns of a part of a long conversation after its conv_id.
LONG_PARTS = (
    "place long, nth long, through array<long>, turn array<long>, role array<string>, text array<string>, fault array<long>, "
    "first_kind long, last_kind long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, "
    "turns long, low long, high long"
)


def _part_schema(conv_type: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([("conv_id", conv_type), *((n, kinds[k]) for n, k in (c.split() for c in LONG_PARTS.split(", ")))])


def _ordered(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: (r["place"], r["nth"]))


def _costs_after(table: pa.Table) -> pa.Table:
    """For each part of a conversation its number and what all that follows it costs, by state."""
    rows = _ordered(table)
    exits = [LAST_EXITS]
    closed = LAST_EXITS
    for _ in range(2):  # messages inserted at the end
        closed = np.minimum(closed, closed[NEXT] + INSERT)
    after = closed
    for row in reversed(rows[1:]):
        through = np.array(row["through"]).reshape(4, 4)
        after = np.minimum((through + after[None, :]).min(axis=1), FAR)
        exits.append(after)
    out = []
    for k, (row, costs) in enumerate(zip(rows, reversed(exits))):
        before = rows[k - 1] if k else None
        joins = before is not None and (before["last_kind"], row["first_kind"]) not in LEGAL
        same = before is not None and before["last_turn"] is not None and before["last_turn"] == row["first_turn"]
        out.append({
            "conv_id": row["conv_id"], "place": row["place"], "nth": row["nth"], "part": k, "last": k == len(rows) - 1,
            "exits": costs.tolist(), "illegal_before": int(joins), "turns_before": int(same),
        })
    schema = [("conv_id", table.schema.field("conv_id").type), ("place", pa.int64()), ("nth", pa.int64()), ("part", pa.int64())]
    schema += [("last", pa.bool_()), ("exits", pa.list_(pa.int64())), ("illegal_before", pa.int64()), ("turns_before", pa.int64())]
    return pa.Table.from_pylist(out, pa.schema(schema))


def _solve_part(row: dict) -> tuple[Runs, Solved]:
    n = len(row["role"])
    faults = np.array(row["fault"])
    table = pa.table({
        "turn": pa.array(row["turn"], pa.int64()), "role": row["role"], "text": row["text"],
        "blank": faults == BLANK, "again": faults == DUPLICATE, "cut": faults == CUT,
    })
    runs = Runs(table, np.array([0]))
    return runs, Solved(runs.kinds, runs.faults, np.array([n]), np.array([row["exits"]]), np.array([row["last"]]))


def _state_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which a part is left, for each in which it may be entered."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            _, solved = _solve_part(row)
            leads = [int(solved.ends(np.array([s]))[0]) for s in range(4)]
            ids = batch.schema.field("conv_id")
            yield pa.RecordBatch.from_pylist(
                [{"conv_id": row["conv_id"], "part": row["part"], "leads": leads}], pa.schema([ids, ("part", pa.int64()), ("leads", pa.list_(pa.int64()))])
            )


def _states(table: pa.Table) -> pa.Table:
    """The state in which each part of a conversation is entered."""
    rows, state, out = sorted(table.to_pylist(), key=lambda r: r["part"]), START, []
    for row in rows:
        out.append({"conv_id": row["conv_id"], "part": row["part"], "state": state})
        state = row["leads"][state]
    return pa.Table.from_pylist(out, pa.schema([table.schema.field("conv_id"), ("part", pa.int64()), ("state", pa.int64())]))


def _edit_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            runs, solved = _solve_part(row)
            state = np.array([row["state"]])
            audit, roles, texts = runs.edits(solved, state)[0]
            cost = int(solved.cost.ravel()[solved.begins(state)][0]) if row["part"] == 0 else 0
            found = {name: row[name] for name in ("conv_id", "part", "low", "high", *COUNTS)}
            found |= {"illegal": row["illegal"] + row["illegal_before"], "turns": row["turns"] - row["turns_before"]}
            yield pa.RecordBatch.from_pylist([found | {"cost": cost, "audit": audit, "roles": roles, "texts": texts}], _schema(batch.schema.field("conv_id").type))


def repair(rows: DataFrame) -> DataFrame:
    """The repaired messages of each conversation of ``rows`` (``conv_id, turn, role, text``).

    Returns ``conv_id, part, cost, audit, roles, texts`` and what was counted in
    the messages as given: ``blank, duplicate, truncated, illegal, turns, low,
    high``. A conversation of up to ``PART`` messages is one row; a longer one
    is one row for each part, whose audits and messages follow each other and
    whose costs and counts add up.

    Messages are taken by turn, nulls first; those of one turn by role and text,
    so repeated rows stand together. A null role or text is one space; null
    conv_ids are one conversation. The first fault of a message counts: blank
    (white space only), duplicate (role and text of an earlier one), truncated
    (not ended by ``.!?``). Blank and duplicate ones are deleted (2); others may
    stay (0), become the user's or the assistant's (1) or go (2), and cost 5 more
    if they stay truncated; empty ones may be put in anywhere (5). Roles must read
    ``(s?(ua)+)?`` by first letters; letters other than s, u, a fit nowhere. Of
    the cheapest edits those with the least audit are taken. Other columns are
    not read; a conversation without rows, or an empty table, gives no row.

    Conversations of usual length meet in one shuffle and are solved many at a
    time. Longer ones are sorted over all tasks; each part is summed up by sixteen
    costs, and only these, about 200 bytes for a part, meet in one task for a
    conversation, which says what follows each part and where its path enters it.
    """
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), said("role"), said("text"))
    bare = F.expr(f"trim(BOTH '{SPACES}' FROM text)")
    rows = rows.withColumn("blank", bare == "").withColumn("cut", ~F.right(bare, F.lit(1)).isin(".", "!", "?"))
    ids = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    long = rows.groupBy(F.col("conv_id").alias("long_id")).agg(F.count("*").alias("n")).where(F.col("n") > PART)
    long = save(long.select("long_id"), "long")
    n_long = long.count()
    if not n_long:
        return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_whole, f"{ids}, {PARTS}")
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = rows.join(bounded(long, n_long), same, "left_anti")
    short = short.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_whole, f"{ids}, {PARTS}")

    # Repeats are counted before they move; a message is a duplicate unless its turn is the first with its words.
    distinct = save(rows.join(bounded(long, n_long), same, "left_semi").groupBy(*rows.columns).agg(F.count("*").alias("times")), "distinct")
    key = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    firsts = distinct.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t")).agg(F.min(key).alias("first"))
    flagged = distinct.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t")))
    flagged = flagged.select("*", (key > F.col("first")).alias("seen")).drop("c", "r", "t", "first")
    # Sorted first, so that a message on very many rows is not one task's to sort; all but its first are duplicates.
    sorted_ = flagged.repartitionByRange(*order).sortWithinPartitions(*order)
    some = sorted_.select("*", F.explode(F.expr(f"sequence(0L, (times - 1) div {PART})")).alias("block"))
    each = some.select("*", F.explode(F.expr(f"sequence(block * {PART}L, least(times, (block + 1) * {PART}L) - 1)")).alias("copy"))
    each = each.select("conv_id", "turn", "role", "text", "blank", "cut", (F.col("seen") | (F.col("copy") > 0)).alias("again"))
    parts = save(each.mapInArrow(_cut, f"{ids}, {LONG_PARTS}"), "parts")
    sums = parts.select("conv_id", "place", "nth", "through", "first_kind", "last_kind", "first_turn", "last_turn")
    after = sums.groupBy("conv_id").applyInArrow(
        _costs_after, f"{ids}, place long, nth long, part long, last boolean, exits array<long>, illegal_before long, turns_before long"
    )
    after = save(after, "after").drop("conv_id")
    parts = save(parts.join(after, ["place", "nth"]), "parts")
    leads = save(parts.mapInArrow(_state_maps, f"{ids}, part long, leads array<long>"), "leads")
    states = save(leads.groupBy("conv_id").applyInArrow(_states, f"{ids}, part long, state long"), "states")
    entered = states.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "state")
    ready = parts.join(entered, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).drop("c", "p")
    return short.unionByName(ready.mapInArrow(_edit_parts, f"{ids}, {PARTS}"))


def messages(parts: DataFrame) -> DataFrame:
    """``conv_id, part, position, role, text``: the repaired messages of ``repair``, one row each."""
    return parts.select("conv_id", "part", F.posexplode(F.arrays_zip("roles", "texts")).alias("position", "m")).select(
        "conv_id", "part", "position", F.col("m.roles").alias("role"), F.col("m.texts").alias("text")
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of long conversations, whose parts come in order and are never held together."""
    key, audit, digest, begun, schema = None, [], hashlib.sha256(), False, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv_id": key[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema)

    for batch in batches:
        schema = schema or pa.schema([batch.schema.field("conv_id"), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for k in range(batch.num_rows):
            this = (batch.column("conv_id")[k].as_py(),)
            if this != key:
                if key is not None:
                    yield row()
                key, audit, digest, begun = this, [], hashlib.sha256(), False
            audit.append(batch.column("audit")[k].as_py())
            for role, text in zip(batch.column("roles")[k].as_py(), batch.column("texts")[k].as_py()):
                digest.update(f"{chr(10) * begun}{role}:{text}".encode())
                begun = True
    if key is not None:
        yield row()


def report(given: DataFrame, parts: DataFrame) -> DataFrame:
    """One row for every conv_id of ``given``, with what ``repair`` found in ``parts`` and the digest of its repair.

    Columns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``; the digest is that of ``role:text`` joined by line ends.
    A conversation without messages has zeros, an empty audit and the digest of
    an empty text. The digest of a conversation of several parts is one running
    sum, so its parts pass through one task in order, one at a time.
    """
    parts = save(parts, "repaired")
    totals = parts.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("cost", *COUNTS)), F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n_parts"),
        F.first(F.when(F.col("part") == 0, F.col("audit")), ignorenulls=True).alias("audit"),
        F.first(
            F.when(F.col("part") == 0, F.sha2(F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda m: F.concat(m.roles, F.lit(":"), m.texts)), "\n"), 256)),
            ignorenulls=True,
        ).alias("repaired_sha256"),
    )
    several = parts.where("part > 0").select(F.col("conv_id").alias("long_id")).distinct()
    several = save(several, "several")
    n_several = several.count()
    if n_several:
        same = F.col("conv_id").eqNullSafe(F.col("long_id"))
        pieces = parts.join(bounded(several, n_several), same, "left_semi").select("conv_id", "part", "audit", "roles", "texts")
        ids = f"conv_id {parts.schema['conv_id'].dataType.simpleString()}"
        joined = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_joined, f"{ids}, audit string, repaired_sha256 string")
        joined = joined.select(F.col("conv_id").alias("long_id"), F.col("audit").alias("long_audit"), F.col("repaired_sha256").alias("long_sha"))
        totals = totals.join(joined, same, "left")
        totals = totals.withColumn("audit", F.coalesce("long_audit", "audit")).withColumn("repaired_sha256", F.coalesce("long_sha", "repaired_sha256"))
    totals = totals.withColumnRenamed("conv_id", "found_id")
    number = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    return given.select("conv_id").distinct().join(totals, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        *(number(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
