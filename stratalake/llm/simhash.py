"""SimHash near-duplicates: fingerprints, BK-trees over shards of them, connected components.

Shards: two fingerprints at distance ``radius`` or less agree on all but ``radius`` of ``BLOCKS``
blocks of eight bits. One shard per choice of agreeing blocks and their value holds every such
pair in at least one shard, and at most ``2 ** (8 * radius)`` different fingerprints: the bound of
a shard's tree, whatever the corpus. Trees are built where their shard is gathered rather than
broadcast, since a broadcast would take the fingerprints of all documents through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import KEY, free_name, row_key, saved, with_marks
from stratalake.llm.components import components

SHINGLE = 3
RADIUS = 2
BLOCKS = 8
SEED = 42
#: Shingle hashes whose bits are counted at once.
COUNTED = 1 << 14


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of UTF-8 bytes: A-Z lowered, words between white space, word shingles.

    A text of fewer words is one shingle; one without words, or None, has fingerprint 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    spans = zip(starts[: len(last)].tolist(), last.tolist())
    digest, ones, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(last)
    for at in range(0, total, COUNTED):
        size = min(COUNTED, total - at)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in (next(spans) for _ in range(size))), np.uint64, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (signed long) for every row of ``documents``."""
    schema = T.StructType([documents.schema["doc_id"], T.StructField("fp", T.LongType(), False)])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = pa.array((fingerprint(t.as_py(), shingle) for t in texts), pa.int64(), size=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps], ["doc_id", "fp"])

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(of_batches, schema)


class BKTree:
    """Integers under Hamming distance; a child hangs at the key of its distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while (key := (node[0] ^ value).bit_count()) in node[1]:
            node = node[1][key]
        node[1][key] = (value, {})

    def within(self, value: int, radius: int) -> list[int]:
        """Members at most ``radius`` from the value, following only edges that can lead to one."""
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            member, children = open_nodes.pop()
            distance = (member ^ value).bit_count()
            if distance <= radius:
                found.append(member)
            if len(children) <= 2 * radius:
                open_nodes.extend(c for key, c in children.items() if abs(key - distance) <= radius)
            else:
                open_nodes.extend(
                    children[key] for key in range(distance - radius, distance + radius + 1) if key in children
                )
        return found


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what lies within the radius of one another in a shard: fewer than members.

    ``members`` are unsigned. Each is searched in the tree of those before it and joined to the
    groups of what it finds, so a group of m near fingerprints gives m - 1 links, not all pairs.
    """
    tree, leader, links = BKTree(), {}, []

    def top(x: int) -> int:
        while leader[x] != x:
            leader[x] = leader[leader[x]]
            x = leader[x]
        return x

    for member in members:
        leader[member] = member
        for near in tree.within(member, radius):
            if (a := top(near)) != (b := top(member)):
                leader[b] = a
                links.append((near, member))
        tree.add(member)
    return links


def _block_masks(radius: int) -> list[int]:
    width = 64 // BLOCKS
    block = (1 << width) - 1
    masks = [
        sum(block << (width * k) for k in chosen) for chosen in combinations(range(BLOCKS), BLOCKS - radius)
    ]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links_within(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links between different values of ``fp`` that connect all within the radius."""
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"radius must be 0 to {BLOCKS - 1}")
    shards = F.array(
        *[
            F.struct(F.lit(k).cast("short").alias("shard"), F.col("fp").bitwiseAND(F.lit(m)).alias("agreed"))
            for k, m in enumerate(_block_masks(radius))
        ]
    )
    dealt = (
        fps.select("fp", F.explode(shards).alias("s"))
        .select("s.shard", "s.agreed", "fp")
        .repartition("shard", "agreed")
        .sortWithinPartitions("shard", "agreed")
    )

    def of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; a shard that goes on in the next batch is carried over."""
        carried = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(3)]
            if carried is not None:
                columns = [np.concatenate(pair) for pair in zip(carried, columns)]
            shard, agreed, fp = columns
            edges = np.flatnonzero((shard[1:] != shard[:-1]) | (agreed[1:] != agreed[:-1])) + 1
            begins, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(fp)]))
            carried = [c[begins[-1] :] for c in columns]
            yield from linked(fp, begins[:-1], ends[:-1])
        if carried is not None:
            yield from linked(carried[2], np.array([0]), np.array([len(carried[2])]))

    def linked(fp: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        links = []
        for k in np.flatnonzero(ends - begins > 1).tolist():
            links += shard_links(fp[begins[k] : ends[k]].view(np.uint64).tolist(), radius)
        if links:
            ab = np.array(links, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])

    return dealt.mapInArrow(of_shards, "a long, b long")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, root, component_id`` for every row of ``documents``.

    Rows link when their fingerprints differ in ``radius`` bits or fewer; ``root`` names the group
    by its smallest fingerprint, ``component_id`` by its smallest doc_id (NULL if none has one).
    Exact copies, repeated rows and all texts without words share a fingerprint. Equal fingerprints
    are reduced to one row before anything is compared, so a third of all rows may be copies.
    """
    rows = saved(fingerprints(documents, shingle))
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("lowest")))
    linked = components(links_within(distinct.select("fp"), radius))
    rooted = distinct.join(linked, distinct.fp == linked.node, "left").select(
        "fp", "lowest", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    groups = rooted.select("fp", "root").join(named, "root")
    return rows.join(groups, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of every group of near-duplicates, with all its columns: the one with the smallest id.

    Rows without an id stay only where no row of the group has one. Of repeated rows (same id and
    text) one stays.
    """
    keyed = documents.select(row_key(documents).alias("doc_id"), "text")
    stays, key = (free_name(name, documents.columns) for name in ("__stays", KEY))
    found = near_duplicates(keyed, shingle, radius)
    marks = saved(
        found.groupBy(F.col("doc_id").alias(KEY))
        .agg(F.max(F.col("doc_id") == F.col("component_id")).alias(stays), F.count("*").alias("n"))
        .where(f"NOT {stays} OR n > 1")
        .select(KEY, stays)
    )
    marked = with_marks(documents, marks)
    kept = marked.where(f"{stays} IS NULL").drop(stays)
    if marks.where(stays).isEmpty():
        return kept
    repeated = marked.where(stays).drop(stays).withColumn(key, row_key(documents))
    return kept.unionByName(repeated.dropDuplicates([key]).drop(key))
