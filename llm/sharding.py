"""Placement of rows in shards through a lookup table filled by permutations."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS = 64
SLOTS = 65_537


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number that owns each slot.

    Every shard prefers the slots in the order offset, offset + skip, offset + 2 skip,
    ..., which is a permutation because the number of slots is prime. The shards take
    turns; each claims the first slot of its order that is still free. Shares differ
    by one slot at most, and few slots move when a shard comes or goes.
    """
    if not names or len(set(names)) < len(names) or len(names) > slots:
        raise ValueError("one to as many as slots different names")
    if slots < 2 or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is not prime")
    offset, skip = [], []
    for name in names:
        digest = hashlib.md5(name.encode()).digest()
        offset.append(int.from_bytes(digest[:8], "big") % slots)
        skip.append(int.from_bytes(digest[8:], "big") % (slots - 1) + 1)
    owner, place, left = [-1] * slots, offset[:], slots
    while True:
        for shard in range(len(names)):
            at = place[shard]
            while owner[at] >= 0:
                at = (at + skip[shard]) % slots
            owner[at] = shard
            place[shard] = (at + skip[shard]) % slots
            left -= 1
            if not left:
                return owner


def slot_of(key: Column, spare: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; a null key is placed by ``spare``, so nulls spread."""
    text = F.coalesce(key.cast("string"), F.concat(F.lit("null:"), F.coalesce(spare, F.lit(""))))
    first = F.substring(F.md5(text.cast("binary")), 1, 12)
    return F.pmod(F.conv(first, 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(
    df: DataFrame, key: str = "doc_id", spare: str = "text",
    shards: int = SHARDS, slots: int = SLOTS,
) -> DataFrame:
    """Each row with ``slot`` and ``shard``, by its key alone.

    The table has ``slots`` rows of 8 bytes, whatever the size of ``df``, and is
    broadcast. No row is shuffled, so hot keys and sources need no care. Equal keys
    share a shard. Rows with a null key are placed by their spare column. Columns named
    slot or shard are replaced. An empty table stays empty.
    """
    names = [f"shard-{i}" for i in range(shards)]
    owner = lookup_table(names, slots)
    rows = [(i, s) for i, s in enumerate(owner)]
    table = df.sparkSession.createDataFrame(rows, "_slot int, shard int")
    kept = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    named = df.select(*(f"`{c}`" for c in kept))
    named = named.withColumn("slot", slot_of(F.col(f"`{key}`"), F.col(f"`{spare}`"), slots))
    out = named.join(F.broadcast(table), F.col("slot") == F.col("_slot"))
    return out.select(*(f"`{c}`" for c in kept), "slot", "shard")


def write_shards(placed: DataFrame, path: str, parts: int = 4) -> None:
    """One folder for each shard with at most ``parts`` files in it.

    Rows of a shard are dealt over ``parts`` tasks by slot, so a shard is never one
    task's work.
    """
    spread = F.pmod(F.col("slot"), F.lit(parts))
    placed.repartition("shard", spread).write.partitionBy("shard").parquet(path)
