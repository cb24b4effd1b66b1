"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized
table; shards take turns, each claiming its next free preference, until the
table is full. Placement is one hash and one look into the broadcast table, and
when a shard is added or leaves, few keys move.
"""

from __future__ import annotations

from collections.abc import Sequence

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the table: the bound of the broadcast. Must be prime.
TABLE_SIZE = 65_537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard index of each slot. The order of the names does not matter.

    Any two shards hold numbers of slots that differ by one at most.
    """
    names = sorted(shards)
    if not names or len(set(names)) != len(names):
        raise ValueError("shards need distinct names, at least one")
    if not is_prime(size) or size < len(names):
        raise ValueError("the table size must be a prime, not under the number of shards")
    starts = [xxhash.xxh64_intdigest(n, 1) % size for n in names]
    steps = [xxhash.xxh64_intdigest(n, 2) % (size - 1) + 1 if size > 2 else 1 for n in names]
    table, tried, filled = [-1] * size, [0] * len(names), 0
    while filled < size:
        for i in range(len(names)):
            if filled == size:
                break
            # a step that the prime size does not divide visits every slot
            slot = (starts[i] + tried[i] * steps[i]) % size
            while table[slot] >= 0:
                tried[i] += 1
                slot = (starts[i] + tried[i] * steps[i]) % size
            table[slot], tried[i], filled = i, tried[i] + 1, filled + 1
    return table


def place(rows: DataFrame, key: str, shards: Sequence[str],
          size: int = TABLE_SIZE) -> DataFrame:
    """(row, slot, shard): each row with its slot and the name of its shard.

    The slot depends on the key's text alone; a null key has the slot of the
    hash of nothing, so all null keys share a shard. `row` is the whole input
    row, so extra columns of any name pass through. No shuffle.
    """
    spark = rows.sparkSession
    names, table = sorted(shards), fill_table(shards, size)
    lookup = spark.createDataFrame([(slot, names[i]) for slot, i in enumerate(table)],
                                   "slot int, shard string")
    slots = rows.select(F.struct("*").alias("row")).withColumn(
        "slot", F.pmod(F.xxhash64(F.col(f"row.`{key}`").cast("string")), F.lit(size)).cast("int"))
    return slots.join(F.broadcast(lookup), "slot").select("row", "slot", "shard")
