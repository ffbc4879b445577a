"""Placement of rows on shards by a lookup table filled from permutations."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS, SLOTS = 16, 1613


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """The number of the shard that holds each slot.

    ``slots`` is a prime, best a hundred times the number of shards, so every
    step size visits all slots. Each shard prefers the slots in the order of its
    own permutation, (offset + j * step) modulo ``slots``; the shards take turns,
    and each claims the first slot of its order that is free. Shares differ by
    one slot at most, and few slots change their shard when one comes or goes.
    """
    if slots < len(shards) or not shards or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime and at least the number of shards, which must be one or more")
    offset = [_number(f"{s}/offset") % slots for s in shards]
    step = [_number(f"{s}/step") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    table, claimed = [-1] * slots, 0
    while True:
        for k in range(len(shards)):
            while table[offset[k]] >= 0:
                offset[k] = (offset[k] + step[k]) % slots
            table[offset[k]] = k
            claimed += 1
            if claimed == slots:
                return table


def place(docs: DataFrame, key: Column, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``; a null key is placed as the empty text.

    The slot is 32 bits of the key's MD5 modulo ``slots``. The table has
    ``slots`` rows whatever the size of ``docs``, so it is broadcast and the rows
    do not move. Equal keys share a shard. Own columns of these names are
    replaced; an empty table stays empty.
    """
    held = F.from_json(F.lit(str([shards[k] for k in lookup_table(shards, slots)])), "array<string>")
    table = docs.sparkSession.range(1).select(F.posexplode(held).alias("slot", "shard"))
    hashed = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    rows = docs.drop("slot", "shard").withColumn("slot", (hashed % slots).cast("int"))
    return rows.join(F.broadcast(table), "slot").select(*rows.columns, "shard")


SQL = f"""
WITH RECURSIVE names AS (SELECT i, 'shard-' || i AS name FROM range({SHARDS}) r(i)),
p AS (SELECT i, ('0x' || substr(md5(name || '/offset'), 1, 8))::BIGINT % {SLOTS} AS start, ('0x' || substr(md5(name || '/step'), 1, 8))::BIGINT % {SLOTS - 1} + 1 AS step FROM names),
pref AS (SELECT i, list_transform(range({SLOTS}), lambda j: (start + j * step) % {SLOTS} + 1) AS wish FROM p),
fill(turn, held, slot) AS (
  SELECT 0, list_transform(range({SLOTS}), lambda x: -1), 0::BIGINT
  UNION ALL
  SELECT turn + 1, list_concat(list_append(held[:slot - 1], turn % {SHARDS}), held[slot + 1:]), slot
  FROM (SELECT turn, held, list_filter(wish, lambda s: held[s] < 0)[1] AS slot FROM fill JOIN pref ON pref.i = turn % {SHARDS} WHERE turn < {SLOTS})),
slots AS (SELECT slot - 1 AS slot, 'shard-' || (turn - 1) % {SHARDS} AS shard FROM fill WHERE turn > 0)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, shard FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT % {SLOTS} AS slot FROM documents) JOIN slots USING (slot)"""
