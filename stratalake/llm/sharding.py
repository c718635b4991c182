"""Placement of rows on shards by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own, ``offset + k * skip``
modulo the size. Shards take turns, each claiming the first slot of its order that is free, until
the table is full: shares differ by one slot, and few slots change owner when shards come or go.
The table's size is a parameter; it is filled once on the driver and broadcast, and placing a row
is one look-up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 256
#: Slots: prime, and some hundred times the shards, for shares within a hundredth of each other.
SLOTS = 65_537


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(n)]


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, purpose: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{purpose}:{name}".encode()).digest()[:8], "big")


def fill(shards: Sequence[str], slots: int = SLOTS, turns: Sequence[int] | None = None) -> list[int]:
    """Owner (position in ``shards``) of every slot; ``turns`` are claims per round, 1 if not given."""
    if not _is_prime(slots):
        raise ValueError(f"{slots} slots: not a prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one and at most as many as slots")
    turns = list(turns or [1] * len(shards))
    if len(turns) != len(shards) or min(turns) < 0 or max(turns) == 0:
        raise ValueError("turns must be one non-negative number per shard, some positive")
    at = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    owner = [-1] * slots
    free = slots
    while free:
        for shard, claims in enumerate(turns):
            for _ in range(min(claims, free)):
                while owner[at[shard]] >= 0:
                    at[shard] = (at[shard] + skip[shard]) % slots
                owner[at[shard]] = shard
                free -= 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key's text: 60 bits of its MD5 modulo the table's size."""
    return (F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long") % slots).cast(
        "int"
    )


def _lookup(spark: SparkSession, shards: Sequence[str], owner: Sequence[int]) -> DataFrame:
    """``slot, shard``: one row per slot, from a literal."""
    names = F.split(F.lit("\n".join(shards)), "\n")
    owners = F.split(F.lit(",".join(map(str, owner))), ",")
    return (
        spark.range(1)
        .select(names.alias("names"), F.posexplode(owners).alias("slot", "owner"))
        .select("slot", F.col("names")[F.col("owner").cast("int")].alias("shard"))
    )


def place(
    rows: DataFrame,
    key: str,
    shards: Sequence[str] | None = None,
    slots: int = SLOTS,
    turns: Sequence[int] | None = None,
) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``; columns of these names are replaced.

    Equal keys share a slot. Rows whose key is NULL have nothing to keep them together and are
    spread by all their columns. Nothing is shuffled, whatever the keys' frequencies.
    """
    shards = shard_names() if shards is None else list(shards)
    rows = rows.drop("slot", "shard")
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    placed = rows.withColumn("slot", slot_of(F.coalesce(F.col(f"`{key}`").cast("string"), rest), slots))
    return placed.join(F.broadcast(_lookup(rows.sparkSession, shards, fill(shards, slots, turns))), "slot")


def write_shards(placed: DataFrame, path: str, files: int = 4) -> None:
    """Write one folder per shard, each dealt over so many tasks, so that a full shard isn't one task's."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.lit(files))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)
