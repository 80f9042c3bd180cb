"""Placing rows on shards through a permutation-filled lookup table.

Every shard has its own permutation of the slots of a table of prime size,
given by an offset and a skip. The shards take turns, each claiming the first
slot of its permutation that is still free, until the table is full. All
shards end up with nearly the same number of slots, and adding or removing one
moves few slots between the others. A row is placed by hashing its key to a
slot: one probe of a broadcast table whose size is a parameter.

Defined results: a null key is placed like an empty one; an empty table gives
an empty result; equal keys share a shard. Columns of the input are not
looked at beyond the key, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime, about a thousand times the shards it is meant for.
TABLE_SIZE = 65537
#: The table is broadcast, so its size is bounded: 2**20 rows of 12 bytes.
LARGEST_TABLE = 1 << 20


def shard_names(count: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(
    shards: Sequence[str], size: int = TABLE_SIZE, weights: Sequence[float] | None = None
) -> list[int]:
    """The shard (its place in ``shards``) of each slot.

    A shard of weight w, the largest being 1, gets a turn in a share w of the
    rounds.
    """
    if not _is_prime(size) or not len(set(shards)) == len(shards) <= size <= LARGEST_TABLE:
        raise ValueError("the size must be a prime between the number of distinct shards and 2**20")
    if not shards:
        raise ValueError("no shards")
    weights = list(weights or [1.0] * len(shards))
    if len(weights) != len(shards) or min(weights) <= 0:
        raise ValueError("one positive weight for each shard")
    heaviest = max(weights)
    place, skip = [], []
    for name in shards:
        seed = hashlib.blake2b(name.encode(), digest_size=16).digest()
        place.append(int.from_bytes(seed[:8], "big") % size)
        skip.append(int.from_bytes(seed[8:], "big") % (size - 1) + 1)
    table, free, turns = [-1] * size, size, [0.0] * len(shards)
    while free:
        for shard, weight in enumerate(weights):
            turns[shard] += weight / heaviest
            if turns[shard] < 1 or not free:
                continue
            turns[shard] -= 1
            slot = place[shard]
            while table[slot] >= 0:
                slot = (slot + skip[shard]) % size
            table[slot] = shard
            place[shard] = (slot + skip[shard]) % size
            free -= 1
    return table


def slot_of(key: Column, size: int) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size))


def place(
    df: DataFrame,
    key: str,
    shards: Sequence[str],
    size: int = TABLE_SIZE,
    weights: Sequence[float] | None = None,
) -> DataFrame:
    """(key, slot, shard) of every row; ``shard`` counts from 0 in ``shards``."""
    table = fill_table(shards, size, weights)
    lookup = df.sparkSession.createDataFrame(
        pa.table({"slot": pa.array(range(size), pa.int64()), "shard": pa.array(table, pa.int32())})
    )
    keys = df.select(F.col(key)).withColumn("slot", slot_of(F.col(key), size))
    return keys.join(F.broadcast(lookup), "slot").select(key, "slot", "shard")
