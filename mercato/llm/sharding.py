"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order of the slots of a prime-sized
table (a start and a step derived from its name).  Shards take turns: each
claims its most preferred slot that is still free, until the table is full.
Slots per shard differ by one at most, and adding or removing a shard moves
few other slots.  The table has ``size`` rows of two integers whatever the
data, so it is broadcast and placing a row is one hash and one lookup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

PRODUCTION_SIZE = 65537
PRODUCTION_SHARDS = tuple(f"shard-{i:03d}" for i in range(128))
LARGEST_SIZE = 655373  # the broadcast bound: at most this many (slot, shard) rows


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: Sequence[str], size: int = PRODUCTION_SIZE) -> np.ndarray:
    """Index of the shard that owns each slot."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shard names must be distinct and at least one")
    if not _is_prime(size) or size > LARGEST_SIZE or size < len(shards):
        raise ValueError(f"size must be a prime from the number of shards to {LARGEST_SIZE}")
    # a shard's order of preference is start, start + step, ... modulo the size: its next choice is all that is kept
    choice, step = [], []
    for s in shards:
        d = hashlib.sha256(s.encode()).digest()
        choice.append(int.from_bytes(d[:8], "big") % size)
        step.append(int.from_bytes(d[8:16], "big") % (size - 1 or 1) + 1)
    owner, left = [-1] * size, size
    while left:
        for i in range(min(len(shards), left)):
            at = choice[i]
            while owner[at] >= 0:
                at = (at + step[i]) % size
            owner[at], choice[i] = i, at
            left -= 1
    return np.array(owner, np.int32)


def place(df: DataFrame, key_cols: Sequence[str], shards: Sequence[str] = PRODUCTION_SHARDS,
          size: int = PRODUCTION_SIZE, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with the slot and shard of each row's key; every row keeps all its columns.

    The slot is a hash of the key columns modulo the table size; nulls hash
    like any value (each null key has one fixed slot), and rows of equal keys
    share a shard.  Columns named like ``slot_col`` or ``shard_col`` are
    replaced.  An empty table stays empty.
    """
    spark = df.sparkSession
    owner = lookup_table(shards, size)
    slots = spark.createDataFrame([(i, shards[o]) for i, o in enumerate(owner.tolist())], "slot int, shard string")
    slot = F.pmod(F.xxhash64(*[F.col(c) for c in key_cols]), F.lit(size)).cast("int")
    # the row stands as one value beside the slot, so no name of its columns can clash
    out = df.select(slot.alias("slot"), F.struct(*df.columns).alias("row")).join(F.broadcast(slots), "slot")
    rest = [F.col("row")[c].alias(c) for c in df.columns if c not in (slot_col, shard_col)]
    return out.select(*rest, F.col("slot").alias(slot_col), F.col("shard").alias(shard_col))


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8, shard_col: str = "shard") -> None:
    """Write one folder per shard; a shard's rows are salted over ``files_per_shard`` tasks."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in placed.columns if c != shard_col]), F.lit(files_per_shard))
    placed.repartition(F.col(shard_col), salt).write.partitionBy(shard_col).parquet(path)
