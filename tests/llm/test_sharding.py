import hashlib
from collections import Counter

import pytest
from llm_texts import awkward, documents

from stratalake.llm.sharding import SLOTS, fill, place, shard_names, slot_of, write_shards


def brute(shards, slots):
    """Each shard's whole preference order, claimed in turn."""
    digest = lambda name, what: int.from_bytes(hashlib.sha256(f"{what}:{name}".encode()).digest()[:8], "big")
    orders = []
    for s in shards:
        offset, skip = digest(s, "offset") % slots, digest(s, "skip") % (slots - 1) + 1
        orders.append(iter([(offset + k * skip) % slots for k in range(slots)]))
    owner = {}
    while True:
        for number, order in enumerate(orders):
            owner[next(slot for slot in order if slot not in owner)] = number
            if len(owner) == slots:
                return [owner[k] for k in range(slots)]


def test_fill_is_the_plain_one():
    for n, slots in ((1, 2), (3, 7), (5, 101), (16, 499)):
        assert fill(shard_names(n), slots) == brute(shard_names(n), slots)


def test_shares_and_moves():
    owner = fill(shard_names())
    counts = Counter(owner).values()
    assert len(owner) == SLOTS and max(counts) - min(counts) <= 1
    fewer = fill(shard_names()[:-1])
    kept = [a == b for a, b in zip(owner, fewer) if a != 255]
    assert sum(kept) / len(kept) > 0.9
    weighted = Counter(fill(["a", "b"], 10007, [1, 3]))
    assert abs(weighted[1] / weighted[0] - 3) < 0.01


def test_wrong_parameters():
    for shards, slots, turns in ((["a"], 10, None), ([], 7, None), (["a", "a"], 7, None), (["a", "b"], 7, [0, 0])):
        with pytest.raises(ValueError):
            fill(shards, slots, turns)


def test_place(spark):
    rows = awkward()
    owner = fill(shard_names(8), 101)
    got = place(documents(spark, rows), "doc_id", shard_names(8), 101).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % 101
            assert (r.slot, r.shard) == (slot, shard_names(8)[owner[slot]])
        assert r.shard is not None
    assert place(documents(spark, []), "doc_id").count() == 0


def test_rows_without_key_are_spread(spark):
    rows = documents(spark, [(None, f"text {k}") for k in range(200)])
    assert place(rows, "doc_id").select("slot").distinct().count() > 150


def test_no_shuffle(spark):
    plan = place(documents(spark, [(1, "x")]), "doc_id")._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_written_shards(spark, tmp_path):
    rows = documents(spark, [(k, f"t{k}") for k in range(50)])
    write_shards(place(rows, "doc_id", shard_names(4), 101), f"{tmp_path}/shards", 2)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 50 and back.select("shard").distinct().count() == 4


def test_slot_is_a_number_below(spark):
    from pyspark.sql import functions as F

    assert spark.range(1000).where(~slot_of(F.col("id")).between(0, SLOTS - 1)).count() == 0
