"""Repeated keys without a shuffle of the keys.

A first pass sends four bytes a row: each task hashes its keys, sorts the hashes into ranges and packs
what is left of a hash within its range into one array per range; per range the arrays of all tasks
are merged, and hashes met twice are kept. A second pass reads the keys again and compares as values
only those with such a hash, which for a clean key are none but a few that collide. A key that holds a
third of the rows is one entry per task in the first pass and counted beside the rows in the second.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.session import estimated_bytes, materialized

#: Bytes of input for which there is one range of hashes.
INPUT_PER_RANGE = 256 << 20
#: Hashes that a task holds before it packs them.
HELD = 1 << 22
#: Repeated hashes that are broadcast to the second pass; more are joined by a shuffle.
BROADCAST_HASHES = 1_000_000


def _present(columns: Sequence[str]) -> Column:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(f"`{c}`").isNotNull()
    return present


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def _packed(hashes: np.ndarray, bits: int) -> pa.RecordBatch:
    """Per range of hashes: what is left of each different hash, and of those met twice."""
    different, times = np.unique(hashes.view(np.uint64), return_counts=True)
    range_of = (different >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(different), np.int64)
    rest = ((different >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(range_of)) + 1, [len(different)])) if len(different) else [0]
    parts = list(zip(edges[:-1], edges[1:]))
    columns = [
        pa.array([int(range_of[a]) for a, _ in parts], pa.int64()),
        pa.array([rest[a:b].tobytes() for a, b in parts], pa.binary()),
        pa.array([rest[a:b][times[a:b] > 1].tobytes() for a, b in parts], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "once", "twice"])


def _merged(table: pa.Table) -> pa.Table:
    """Of one range, the hashes that two tasks have, or one task twice."""
    read = lambda name: np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint32)
    once = np.sort(read("once"))
    repeated = np.union1d(once[1:][once[1:] == once[:-1]], read("twice")).astype(np.int64)
    part = np.full(len(repeated), table.column("part")[0].as_py(), np.int64)
    return pa.table({"part": pa.array(part), "rest": pa.array(repeated)})


def suspects(rows: DataFrame, columns: Sequence[str], bits: int | None = None) -> DataFrame:
    """``part, rest`` of the hashes that occur more than once among keys without NULL; 2**bits ranges."""
    if bits is None:
        spark = rows.sparkSession
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(rows) // INPUT_PER_RANGE)
        bits = min(24, max(1, (ranges - 1).bit_length()))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            n += batch.num_rows
            if n >= HELD:
                yield _packed(np.concatenate(held), bits)
                held, n = [], 0
        if n:
            yield _packed(np.concatenate(held), bits)

    hashes = rows.where(_present(columns)).select(_hash(columns).alias("h"))
    packed = hashes.mapInArrow(of_batches, "part long, once binary, twice binary")
    found = packed.groupBy("part").applyInArrow(_merged, "part long, rest long")
    return found.withColumn("bits", F.lit(bits))


def repeated_keys(rows: DataFrame, columns: Sequence[str], bits: int | None = None) -> DataFrame:
    """``columns, n``: every key that occurs in more than one row, and in how many.

    Keys are compared as values, so the result is exact whatever collides. Rows with a NULL in one
    of the columns have no key. The rows are read twice.
    """
    found = materialized(suspects(rows, columns, bits))
    first = found.first()
    keys = rows.where(_present(columns)).select(*[F.col(f"`{c}`") for c in columns])
    if first is None:
        return keys.limit(0).withColumn("n", F.lit(0).cast("long"))
    bits = first.bits
    h = _hash(columns)
    # Names that the columns do not have.
    part, rest = ("_" * max(map(len, columns)) + name for name in ("_part", "_rest"))
    placed = keys.withColumns(
        {
            part: F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long"),
            rest: F.shiftrightunsigned(h, 32 - bits).bitwiseAND(F.lit(0xFFFFFFFF)),
        }
    )
    wanted = found.select(F.col("part").alias(part), F.col("rest").alias(rest))
    wanted = F.broadcast(wanted) if found.count() <= BROADCAST_HASHES else wanted
    candidates = placed.join(wanted, [part, rest], "left_semi").drop(part, rest)
    return candidates.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("n")).where("n > 1")
