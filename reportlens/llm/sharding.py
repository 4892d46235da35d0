"""Sharding by a permutation-filled lookup table.

Every shard has its own order of the slots of a table whose size is a prime. Shards take turns, each claims the first
slot of its order that is free, until none is free. A row goes to the shard of the slot its key hashes to. Shards get
equal parts to within one slot (weights: turns in proportion), and if a shard comes or goes, few other slots change hands.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> np.ndarray:
    """The number of the shard that owns each slot. ``slots`` is a prime above
    the number of shards; a shard of weight w has w turns a round."""
    if not shards or len(set(shards)) < len(shards) or not _is_prime(slots) or slots < len(shards):
        raise ValueError("distinct shard names and a prime number of slots, not fewer than shards, are needed")
    turns = weights or [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 1:
        raise ValueError("a weight of at least 1 for each shard is needed")
    owner = np.full(slots, -1, np.int32)
    offset, skip, reached = [], [], [0] * len(shards)
    for name in shards:
        h = hashlib.md5(name.encode()).digest()
        offset.append(int.from_bytes(h[:8], "big") % slots)
        skip.append(int.from_bytes(h[8:], "big") % (slots - 1) + 1)
    free = slots
    while True:
        for k, times in enumerate(turns):
            for _ in range(times):
                at = (offset[k] + reached[k] * skip[k]) % slots
                while owner[at] >= 0:
                    reached[k] += 1
                    at = (offset[k] + reached[k] * skip[k]) % slots
                owner[at] = k
                reached[k] += 1
                free -= 1
                if not free:
                    return owner


def slot_of(key, slots: int):
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo ``slots``. A null key hashes as the empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots)).cast("int")


def lookup_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    owner = lookup_table(shards, slots, weights)
    names = [shards[k] for k in owner]
    return spark.createDataFrame(list(zip(range(slots), owner.tolist(), names)), "slot int, shard int, shard_name string")


def assign_shards(rows: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """``rows`` with slot, shard (its number) and shard_name; columns of these
    names are replaced. No row moves: the table, of ``slots`` small rows
    whatever the data, is broadcast. Rows with equal keys, null among them,
    meet in one shard; an empty table stays empty."""
    rows = rows.drop("slot", "shard", "shard_name").withColumn("slot", slot_of(F.col(key), slots))
    return rows.join(F.broadcast(lookup_frame(rows.sparkSession, shards, slots, weights)), "slot", "left")


def write_shards(assigned: DataFrame, path: str, files: int = 8, rows_per_file: int = 1_000_000) -> None:
    """Write a folder per shard. A shard is dealt over ``files`` tasks by a hash
    of the row, so that no task holds a whole shard."""
    spread = F.pmod(F.xxhash64(*[c for c in assigned.columns if c not in ("slot", "shard", "shard_name")]), F.lit(files))
    (assigned.repartition("shard_name", spread).write.option("maxRecordsPerFile", rows_per_file)
     .partitionBy("shard_name").parquet(path))
