"""Placement by a permutation-filled lookup table.

Each shard has its own order of all slots of a table of prime size (an offset and a skip from md5 of its name).  Shards take
turns; on its turn a shard claims the first slot of its order that is still free.  Every shard gets the same number of
slots to within one, and adding or removing a shard moves few slots.  The table has `slots` entries whatever the data, so
it is broadcast, and a row's shard is one look-up at md5(key) modulo `slots`.

Defined cases: a null key is placed like the empty string; equal keys go to one shard; an empty table gives no row; other
columns are kept, but those named slot or shard are replaced.  Rows of one shard go to its files by a hash of key and text, so that a
shard with most rows, or a key with many texts, is many tasks' work.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import ranges
from larder.session import materialize

SLOTS = 4099
FILE_BYTES = 128 << 20  # of text in a file of a shard


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (its index) of each slot."""
    if not _prime(slots) or not 0 < len(shards) <= slots:
        raise ValueError("slots must be a prime and at least the number of shards")
    at = [_number(f"{s}|offset") % slots for s in shards]
    skip = [_number(f"{s}|skip") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(docs: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """`docs` with the slot and the shard of each row."""
    table = lookup_table(shards, slots)
    seats = docs.sparkSession.createDataFrame([(i, shards[s]) for i, s in enumerate(table)], "slot long, shard string")
    placed = docs.drop("shard").withColumn("slot", slot_of(docs[key], slots))
    return placed.join(F.broadcast(seats), "slot").select(*[c for c in placed.columns if c != "slot"], "slot", "shard")


def write(docs: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """The written table of whole rows with slot and shard, a folder a shard."""
    files = ranges.bucket_count(docs, file_bytes, 2 * len(shards))
    placed = place(docs, shards, key, slots)
    part = F.pmod(F.xxhash64(key, "text"), F.lit(-(-files // len(shards))))
    return materialize(placed.repartition(files, F.col("shard"), part), ("shard",)).select(*placed.columns)
