"""Sharding by a permutation-filled lookup table (operator 10).

Every shard has its own preference order over the slots of a table of prime
size: ``(offset + i * skip) mod size``, with offset and skip hashed from its
name.  The shards take turns; each claims the first slot of its order that is
still free, until the table is full.  All shards get the same number of slots
give or take one, and removing a shard moves few rows of the others.

The table depends on the shard names alone and has ``table_size`` rows (at most
MAX_TABLE), so it is broadcast; a row's place is one hash and one lookup, and
rows are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import documents, pick, without
from cohortlens.schema import safe_col

MAX_TABLE = 1_000_003
TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(name: str, salt: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, salt=salt).digest(), "big")


def lookup_table(shards: Sequence[str], table_size: int = TABLE_SIZE) -> np.ndarray:
    """Slot → index into ``shards``.  Raises on no shards, repeated names, a size that is not prime or too large."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct and at least one")
    if not _is_prime(table_size) or not len(shards) <= table_size <= MAX_TABLE:
        raise ValueError(f"table_size must be a prime from the number of shards to {MAX_TABLE}")
    at = [_hash(s, b"offset") % table_size for s in shards]
    skip = [_hash(s, b"skip") % (table_size - 1) + 1 for s in shards]
    owner = [-1] * table_size
    free = table_size
    while free:
        for i in range(len(shards)):
            slot = at[i]
            while owner[slot] >= 0:
                slot = (slot + skip[i]) % table_size
            owner[slot] = i
            at[i] = (slot + skip[i]) % table_size
            free -= 1
            if not free:
                break
    return np.array(owner, dtype=np.int32)


def place(docs: DataFrame, key: str, shards: Sequence[str] = SHARDS, table_size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with ``slot`` (int) and ``shard`` (string); input columns of those names are replaced.

    Equal keys share a shard.  A null key is placed by the hash of the whole
    row instead, so many null keys spread over all shards.  Every row is kept,
    repeated rows too; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    owner = lookup_table(shards, table_size)
    table = spark.createDataFrame(
        [(slot, shards[i]) for slot, i in enumerate(owner.tolist())], "slot int, shard string"
    )
    whole_row = F.xxhash64(*[safe_col(c).cast("string") for c in docs.columns])
    code = F.when(safe_col(key).isNotNull(), F.xxhash64(safe_col(key))).otherwise(whole_row)
    slot = F.pmod(code, F.lit(table_size)).cast("int")
    kept = without(docs, ("slot", "shard")).columns
    return docs.select(*[safe_col(c) for c in kept], slot.alias("slot")).join(F.broadcast(table), "slot").select(
        *[safe_col(c) for c in kept], "slot", "shard"
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard, by doc_id."""
    return place(pick(documents(spark, sf_dir), doc_id="doc_id", text="text"), "doc_id").select("doc_id", "slot", "shard")
