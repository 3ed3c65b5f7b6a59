"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size (an offset and a skip
from hashes of its name, so the order is a permutation). The shards take turns, each claiming the
next free slot it prefers, until the table is full: slots per shard differ by at most one, and
adding or removing a shard moves few slots. The table has ``table_size`` rows whatever the data's
size, so it is broadcast, and a row is placed by one hash and one lookup without any shuffle.

The key is the id as text; a null id is keyed by the digest of the text (null as empty), so rows
without an id spread over all shards. Equal keys, so also repeated rows, share a shard. An empty
table gives an empty result. Helper columns can't clash: the row is carried as one struct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, with_row

TABLE_SIZE = 65537  # prime; about a thousand slots for each of 64 shards
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of the shard that claimed it."""
    if not shards or size < len(shards) or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("a prime table size of at least the number of shards is needed")
    at = [_hash(s, "offset") % size for s in shards]
    skip = [_hash(s, "skip") % (size - 1) + 1 for s in shards]
    owner, free = [-1] * size, size
    while free:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            owner[at[i]] = i
            free -= 1
            if not free:
                break
    return owner


def document_key(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("string"), F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))


def place(df: DataFrame, key: Column, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """``row`` (the columns of ``df``), slot, shard."""
    names = list(shards)
    slots = df.sparkSession.createDataFrame(
        [(i, names[s]) for i, s in enumerate(lookup_table(names, size))], "slot int, shard string")
    rows = df.select(with_row(df).alias("row"), F.pmod(F.xxhash64(key), F.lit(size)).cast("int").alias("slot"))
    return rows.join(F.broadcast(slots), "slot").select("row", "slot", "shard")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return place(docs, document_key(docs)).select("row.doc_id", "slot", "shard")
