"""Shard placement by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a prime-sized
table (offset and skip from a digest of its name); the shards take turns, each
claiming its next free slot, until the table is full. A key is placed by its
digest modulo the table size. Adding or removing a shard moves few keys, and
the shares of any two shards differ by at most one slot.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots; a prime, at least a hundred times the number of shards.
TABLE_SIZE = 8191
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(names: list[str], size: int = TABLE_SIZE) -> list[int]:
    """For each slot, the index of the shard that claimed it."""
    if not names:
        raise ValueError("there must be a shard")
    if len(set(names)) != len(names):
        raise ValueError("shard names must differ")
    if not is_prime(size) or size < len(names):
        raise ValueError("the table size must be a prime, no smaller than the number of shards")

    def digest(name: str, salt: str) -> int:
        return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)

    at = [digest(n, "offset") % size for n in names]
    skip = [digest(n, "skip") % (size - 1) + 1 for n in names]
    owner = [-1] * size
    free = size
    while free:
        for k in range(len(names)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % size
            owner[at[k]] = k
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """60 bits of the key's MD5 modulo the table size."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("bigint"), F.lit(size))


def place(docs: DataFrame, key: Column, names: list[str] | None = None, size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with ``shard_slot`` and ``shard``, without a shuffle.

    The table of ``size`` rows is broadcast; its size is a parameter and does
    not depend on the data. A null key is placed as the empty text. Columns
    of ``docs`` named ``shard_slot`` or ``shard`` are replaced. An empty
    ``docs`` gives no rows.
    """
    names = names or [f"shard-{k:05d}" for k in range(SHARDS)]
    owner = lookup_table(names, size)
    slots = docs.sparkSession.createDataFrame(list(enumerate(owner)), "shard_slot long, shard int")
    keyed = docs.drop("shard_slot", "shard").withColumn("shard_slot", slot_of(F.coalesce(key.cast("string"), F.lit("")), size))
    return keyed.join(F.broadcast(slots), "shard_slot", "left")
