"""Sharding by a permutation-filled lookup table.

The table has a prime number of slots. Each shard visits the slots in a preference order of its own, offset + j * skip;
shards take turns, and in its turn a shard claims the first slot of its order that is free. Each shard thus gets as many
slots as any other, give or take one, and when a shard comes or goes few other slots change hands. A key's slot is its
hash modulo the slots, so that placing a row is one lookup in the broadcast table, whose size is the parameter `slots`.

Defined cases: a null key is the empty string; repeated keys share a shard; equal shard names are refused; an empty
table gives no rows; columns of rows keep their names, whatever these are, and where one is called like a result column,
that column's name gets a trailing underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import beside, free, table

SHARDS, SLOTS = 64, 8191


def _md5_number(text: str, first: int) -> int:
    import hashlib

    return int(hashlib.md5(text.encode()).hexdigest()[first : first + 12], 16)


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The number of the shard that holds each slot."""
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be prime")
    if not names or len(set(names)) != len(names) or len(names) > slots:
        raise ValueError("shards need distinct names, and a slot each")
    start = [_md5_number(n, 0) % slots for n in names]
    skip = [_md5_number(n, 12) % (slots - 1) + 1 for n in names]
    held, turn, left = [-1] * slots, [0] * len(names), slots
    while left:
        for shard in range(len(names)):
            while held[(start[shard] + turn[shard] * skip[shard]) % slots] >= 0:
                turn[shard] += 1
            held[(start[shard] + turn[shard] * skip[shard]) % slots] = shard
            left -= 1
            if not left:
                break
    return held


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """A key's slot: 60 bits of its MD5 modulo the slots."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(rows: DataFrame, key: Column, names: list[str], slots: int = SLOTS, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """rows plus slot_col long and shard_col int."""
    held = rows.sparkSession.createDataFrame(list(enumerate(lookup_table(names, slots))), "at long, held int")
    placed = beside(rows, slot_of(key, slots).alias("s")).join(F.broadcast(held), F.col("s") == F.col("at"))
    return placed.select("row.*", F.col("s").alias(free(slot_col, rows.columns)), F.col("held").alias(free(shard_col, rows.columns)))


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:04d}" for k in range(n)]


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return place(docs, F.col("doc_id"), shard_names()).select("doc_id", "slot", F.col("shard").cast("long").alias("shard"))


QUERIES = {"op2_permutation_table_sharding": op2}

_HEX = "('0x' || substr(md5({0}), {1}, {2}))::BIGINT"

#: Turns are a recursion whose state is the table so far and each shard's next preference.
ORACLE = {
    "op2_permutation_table_sharding": f"""
WITH RECURSIVE shards AS (
  SELECT s, {_HEX.format("'shard-' || lpad(s::VARCHAR, 4, '0')", 1, 12)} % {SLOTS} AS start,
         {_HEX.format("'shard-' || lpad(s::VARCHAR, 4, '0')", 13, 12)} % {SLOTS - 1} + 1 AS skip
  FROM range({SHARDS}) AS r(s)),
orders AS (SELECT list(start ORDER BY s) AS starts, list(skip ORDER BY s) AS skips FROM shards),
turns AS (
  SELECT 0::BIGINT AS turn, NULL::BIGINT AS slot, bitstring('0', {SLOTS}) AS taken
  UNION ALL
  SELECT turn + 1, pick, set_bit(taken, pick::INTEGER, 1)
  FROM (SELECT turn, taken, list_filter(list_transform(range({SLOTS}), lambda j: (starts[turn % {SHARDS} + 1] + j * skips[turn % {SHARDS} + 1]) % {SLOTS}),
                                        lambda x: get_bit(taken, x::INTEGER) = 0)[1] AS pick
        FROM turns, orders WHERE turn < {SLOTS}))
SELECT d.doc_id, t.slot, (t.turn - 1) % {SHARDS} AS shard
FROM (SELECT doc_id, {_HEX.format("coalesce(doc_id::VARCHAR, '')", 1, 15)} % {SLOTS} AS slot FROM documents) d
JOIN turns t ON t.slot = d.slot AND t.turn > 0"""
}
