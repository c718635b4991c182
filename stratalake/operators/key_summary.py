"""Which partitions may hold some keys, from a small summary instead of the partitions.

Per partition the hashes of its keys fall into blocks of 32,768 bits; a block is a row with a Bloom
bitmap and the smallest and largest of its keys. The number of blocks follows the number of keys, so a
summary costs some bits a key whatever the size of keys and rows. Keys to be found are gathered by
block, in lists of bounded length, and meet the summaries of that block: no key is missed, and a key
that a partition does not hold passes by chance about once in 70,000 times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.incremental import upsert
from stratalake.sources.derived import PART, DerivedTable, listed
from stratalake.sources.partitioned import PartitionedTable

BLOCK_BITS = 32_768
BITS_PER_KEY = 24
PROBES = 12
#: Keys of a list that meets a block's bitmap.
LISTED = 500


def _hashes(keys: Sequence[str]) -> tuple[Column, Column, Column]:
    """A hash that names the block, and two that place the probes in it."""
    columns = [F.col(f"`{k}`") for k in keys]
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *columns)


def _block(h: Column, level: Column) -> Column:
    """One of 2**level blocks."""
    return F.pmod(h, F.pow(F.lit(2), level).cast("long"))


def _place(first: Column, step: Column, probe: Column) -> Column:
    return F.pmod(F.pmod(first, F.lit(BLOCK_BITS)) + probe * F.pmod(step, F.lit(BLOCK_BITS)), F.lit(BLOCK_BITS))


def summarize(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``part, level, block, low, high, bitmap``: a row per block of every partition of ``rows``."""
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") * BITS_PER_KEY / BLOCK_BITS))).cast("int")
    sizes = rows.groupBy(PART).agg(F.count("*").alias("n")).select(F.col(PART).alias("of"), level.alias("level"))
    h, first, step = _hashes(keys)
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    hashed = rows.select(PART, key.alias("key"), h.alias("h"), first.alias("first"), step.alias("step"))
    # A row per partition: the level it needs.
    placed = hashed.join(sizes, F.col(PART).eqNullSafe(F.col("of"))).select(
        PART, "level", _block(F.col("h"), F.col("level")).alias("block"), "key", "first", "step"
    )
    probes = F.explode(F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: _place(F.col("first"), F.col("step"), i)))
    return (
        placed.select(PART, "level", "block", "key", probes.alias("place"))
        .groupBy(PART, "level", "block")
        .agg(
            F.min("key").alias("low"),
            F.max("key").alias("high"),
            F.expr("bitmap_construct_agg(place)").alias("bitmap"),
        )
    )


def _has(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.get(F.array(*[byte.bitwiseAND(1 << b) != 0 for b in range(8)]), (place % 8).cast("int"))


def may_hold(summary: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> list[str | None]:
    """Partitions whose summary may hold one of the wanted keys; one row per partition comes to the driver."""
    h, first, step = _hashes(keys)
    key = F.struct(*[F.col(f"`{k}`") for k in keys]).alias("key")
    hashed = wanted.select(key, h.alias("h"), first.alias("first"), step.alias("step")).distinct()
    n, levels = hashed.count(), [r[0] for r in summary.select("level").distinct().collect()]
    if not n or not levels:
        return []
    # The keys once for every number of blocks in use, in lists of some hundreds.
    spread = F.explode(F.array(*[F.lit(level) for level in levels])).alias("level")
    lists = F.greatest(F.lit(1), F.ceil(F.lit(n / LISTED) / F.pow(F.lit(2), F.col("level")))).cast("long")
    gathered = (
        hashed.select("*", spread)
        .withColumns({"block": _block(F.col("h"), F.col("level")), "list": F.pmod(F.col("step"), lists)})
        .groupBy("level", "block", "list")
        .agg(F.collect_list(F.struct("key", "first", "step")).alias("keys"))
    )
    probes = F.sequence(F.lit(0), F.lit(PROBES - 1))

    def held(k: Column) -> Column:
        inside = (k["key"] >= F.col("low")) & (k["key"] <= F.col("high"))
        return inside & F.forall(probes, lambda i: _has(F.col("bitmap"), _place(k["first"], k["step"], i)))

    found = summary.join(gathered, ["level", "block"]).where(F.exists("keys", held))
    return [r[0] for r in found.select(PART).distinct().collect()]


class SummarizedTable:
    """A partitioned table with a key summary beside it.

    The summary is an ordinary table, a partition of it per partition of the table, renewed with each
    load for the partitions that the load wrote. A partition without a summary of its present rows
    (the job died before) counts as one that may hold any key, and gets its summary with the next load.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partition: str, schema: T.StructType):
        self.keys, self.partition, self.schema = list(keys), partition, schema
        self.table = PartitionedTable(spark, f"{path}/rows", partition)
        self.summary = DerivedTable(self.table, f"{path}/key_summary", lambda rows: summarize(rows, self.keys))

    def read(self) -> DataFrame:
        return self.table.read(self.schema)

    def candidates(self, wanted: DataFrame) -> list[str | None]:
        """Partitions that may hold the keys of ``wanted``; no row of the table is read."""
        summary, stale = self.summary.current(self.schema)
        return sorted({*may_hold(summary, wanted, self.keys), *stale}, key=lambda p: (p is not None, p))

    def of(self, parts: Sequence[str | None]) -> DataFrame:
        """The rows of some partitions: the values prune the scan as literals."""
        return self.read().where(listed(self.partition, parts, self.schema[self.partition].dataType))

    def replace(self, rows: DataFrame, emptied: Sequence = ()) -> list[str | None]:
        """Replace partitions and renew their summaries; returns which have another load than before."""
        before = self.table.loads()
        stale = self.summary.current(self.schema)[1]
        self.table.replace(rows, emptied)
        after = self.table.loads()
        changed = [p for p in {*before, *after} if before.get(p) != after.get(p)]
        self.summary.refresh(self.schema, [*changed, *[p for p in stale if p not in changed]])
        return changed

    def upsert(self, delta: DataFrame, newest_first: Sequence[Column]) -> list[str | None]:
        """Keep the newest row per key of table and delta; returns the partitions that were read.

        Read are the partitions whose summary may hold a key of the delta (its keys, to see where they
        really are) and those the delta goes to; rewritten are only those that do hold one, and those it
        goes to. So a key may move between partitions, and cost follows the delta, not the table.
        """
        candidates = self.candidates(delta)
        wanted = delta.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(self.keys)]).distinct()
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(self.keys)]
        holding = self.of(candidates).join(wanted, same, "left_semi").select(self.partition)
        kind = self.schema[self.partition].dataType
        touched = [r[0] for r in holding.union(delta.select(self.partition)).distinct().collect()]
        found = F.col(self.partition).isin([F.lit(v).cast(kind) for v in touched if v is not None])
        found = F.coalesce(found, F.lit(False)) | F.col(self.partition).isNull() if None in touched else found
        self.replace(upsert(self.read().where(found), delta.select(*self.schema.names), self.keys, newest_first), touched)
        goes_to = [None if v is None else str(v) for v in touched]
        return sorted({*candidates, *goes_to}, key=lambda p: (p is not None, p))
