import random

import numpy as np
import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from stratalake.operators import uniqueness
from stratalake.operators.uniqueness import _merged, _packed, repeated_keys, suspects


def plain(data, width):
    counts = {}
    for key in (r[:width] for r in data):
        if None not in key:
            counts[key] = counts.get(key, 0) + 1
    return sorted(((*k, n) for k, n in counts.items() if n > 1), key=str)


@pytest.mark.parametrize("bits", [0, 1, 5, None])
def test_planted_duplicates(spark, bits):
    rng = random.Random(bits)
    data = [(f"key {k}", k % 7, "x") for k in range(4000)]
    data += rng.sample(data, 30) + [("hot", 1, "x")] * 2000 + [(None, 1, "x"), ("y", None, "x")] * 5
    rng.shuffle(data)
    frame = spark.createDataFrame(data, "name string, no int, part string").repartition(7)
    assert rows(repeated_keys(frame, ["name", "no"], bits)) == plain(data, 2)
    assert rows(repeated_keys(frame, ["name"], bits)) == plain([(r[0],) for r in data], 1)


def test_colliding_hashes_are_no_duplicates(spark, monkeypatch):
    monkeypatch.setattr(uniqueness, "_hash", lambda columns: F.xxhash64(F.col(columns[0]) % 5))
    frame = spark.range(1000)
    assert suspects(frame, ["id"], 3).count() == 5
    assert rows(repeated_keys(frame, ["id"], 3)) == []
    assert rows(repeated_keys(frame.union(spark.range(3)), ["id"], 3)) == [(0, 2), (1, 2), (2, 2)]


def test_many_repeated_hashes_are_joined(spark, monkeypatch):
    monkeypatch.setattr(uniqueness, "BROADCAST_HASHES", 3)
    frame = spark.range(300).union(spark.range(100, 200))
    assert rows(repeated_keys(frame, ["id"])) == sorted([(k, 2) for k in range(100, 200)], key=str)


def test_odd_names_and_empty(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "`part` int, `a.rest` int")
    assert rows(repeated_keys(frame, ["a.rest", "part"])) == [(1, 1, 2)]
    assert rows(repeated_keys(frame.limit(0), ["part"])) == []
    assert repeated_keys(frame.where("part = 2"), ["part"]).columns == ["part", "n"]


def test_merging_keeps_what_two_tasks_have():
    import pyarrow as pa

    a, b = (np.array(v, np.int64) for v in ([5, -7, 9, 9], [5, 11, -8]))
    parts = pa.Table.from_batches([_packed(a, 0), _packed(b, 0)])
    assert _merged(parts).column("rest").to_pylist() == sorted({0, 2**32 - 1})  # of 5, 9 and 11, and of -7 and -8


def shuffled(frame):
    """Bytes that the frame's executed plan has written for shuffles."""
    total, left = 0, [frame._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        metric = node.metrics().get("shuffleBytesWritten")
        total += metric.get().value() if metric.isDefined() else 0
        left += [node.children().apply(k) for k in range(node.children().size())]
    return total


def test_a_clean_key_shuffles_a_tenth(spark, tmp_path):
    """Bytes shuffled for a clean text key, against counting its values."""
    frame = spark.range(0, 400_000, 1, 4).selectExpr("sha2(string(id), 256) AS key")
    frame.write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")

    frame = repeated_keys(keys, ["key"])
    exact = keys.groupBy("key").count().where("count > 1")
    assert frame.collect() == exact.collect() == []
    first = suspects(keys, ["key"])
    first.collect()
    assert 0 < (shuffled(first) + shuffled(frame)) * 10 < shuffled(exact)
