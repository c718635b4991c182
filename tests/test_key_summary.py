import random
import shutil
from datetime import date, timedelta
from pathlib import Path

import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from stratalake.operators.key_summary import PROBES, SummarizedTable, may_hold, summarize
from stratalake.sources.partitioned import PartitionedTable

SCHEMA = "id long, line string, at int, day date"
START = date(2024, 1, 1)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def table(spark, folder, data=None):
    loaded = SummarizedTable(spark, str(folder), ["id", "line"], "day", frame(spark, []).schema)
    if data is not None:
        loaded.upsert(frame(spark, data), [F.col("at").desc()])
    return loaded


def newest(*batches):
    best = {}
    for row in (r for batch in batches for r in batch):
        best[row[:2]] = max(best.get(row[:2], row), row, key=lambda r: r[2])
    return sorted(best.values(), key=str)


def lay_waste(loaded, keep):
    """Delete the files of all partitions but some: whoever reads another fails or lacks rows."""
    for folder in Path(loaded.table.path).glob("data/*/day=*"):
        if folder.name.split("=")[1] not in keep:
            shutil.rmtree(folder)


def test_no_key_is_missed(spark):
    rng = random.Random(1)
    data = [(k, rng.choice(["a", None, ""]), 0, START + timedelta(days=rng.randrange(5))) for k in range(6000)]
    data += [(None, None, 0, START), (None, "x", 0, START + timedelta(days=4))]
    summary = summarize(frame(spark, data).withColumn("part", F.col("day").cast("string")), ["id", "line"]).cache()
    assert summary.select("block").distinct().count() >= 1 and summary.count() >= 5
    for row in [*rng.sample(data, 4), data[-1], data[-2]]:
        assert str(row[3]) in may_hold(summary, frame(spark, [row]), ["id", "line"])
    absent = frame(spark, [(k, "b", 0, START) for k in range(0, 6000, 3)])
    assert may_hold(summary, absent, ["id", "line"]) == []
    assert may_hold(summary, frame(spark, []), ["id", "line"]) == []


def test_a_large_partition_has_more_blocks(spark):
    big = spark.range(60_000).select(F.col("id"), F.lit("d").alias("part"))
    summary = summarize(big, ["id"])
    sizes = summary.agg(F.max("level"), F.count("*"), F.max(F.bitmap_count("bitmap"))).first()
    assert sizes[0] == 6 and sizes[1] == 64 and sizes[2] < 32_768 * 0.6 and PROBES == 12
    far = spark.range(50_000, 50_010).union(spark.range(10**6, 10**6 + 5000))
    assert may_hold(summary, far, ["id"]) == ["d"]
    assert may_hold(summary, spark.range(10**6, 10**6 + 5000), ["id"]) == []


def test_only_partitions_that_may_hold_a_key_are_read(spark, tmp_path):
    first = [(k, "x", 1, START + timedelta(days=k % 20)) for k in range(400)]
    loaded = table(spark, tmp_path, first)
    delta = [(7, "x", 2, START + timedelta(days=7)), (28, "x", 2, START + timedelta(days=30)), (9000, "x", 1, START)]
    read = {str(START + timedelta(days=k)) for k in (7, 8, 30, 0)}
    lay_waste(loaded, read)
    assert set(loaded.upsert(frame(spark, delta), [F.col("at").desc()])) == read
    want = [r for r in newest(first, delta) if str(r[3]) in read]
    assert [r for r in rows(loaded.read().where(F.col("day").cast("string").isin(*read)))] == want


def test_any_order_of_loads(spark, tmp_path):
    rng = random.Random(5)
    batches = [
        [
            (rng.choice([None, *range(30)]), rng.choice(["a", "b", None]), 1000 * b + k, rng.choice([None, START, START + timedelta(days=rng.randrange(6))]))
            for k in range(25)
        ]
        for b in range(3)
    ]
    batches = [newest(batch) for batch in batches]
    want = newest(*batches)
    for turn in (batches, [*batches[::-1], batches[1]]):
        loaded = table(spark, tmp_path / str(rng.random()))
        for batch in turn:
            loaded.upsert(frame(spark, batch), [F.col("at").desc()])
        assert rows(loaded.read()) == want


def test_a_job_that_dies_between_rows_and_summary(spark, tmp_path, monkeypatch):
    first = [(k, "x", 1, START + timedelta(days=k % 4)) for k in range(40)]
    loaded = table(spark, tmp_path, first)
    moved = [(1, "x", 2, START + timedelta(days=9))]
    with monkeypatch.context() as patch:
        patch.setattr(loaded.summary, "refresh", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            loaded.upsert(frame(spark, moved), [F.col("at").desc()])
    again = table(spark, tmp_path)
    # Partitions without a valid summary count as such that may hold any key.
    assert set(again.candidates(frame(spark, [(777, "x", 1, START)]))) == {str(START + timedelta(days=d)) for d in (1, 9)}
    back = [(1, "x", 3, START)]
    again.upsert(frame(spark, back), [F.col("at").desc()])
    assert rows(again.read()) == newest(first, moved, back)
    assert again.candidates(frame(spark, [(777, "x", 1, START)])) == []


def test_hot_partition_and_empty_delta(spark, tmp_path):
    first = [(k, "x", 1, START if k % 3 else START + timedelta(days=k % 11)) for k in range(3000)]
    loaded = table(spark, tmp_path, first)
    assert loaded.upsert(frame(spark, []), [F.col("at").desc()]) == []
    delta = [(k, "x", 2, START + timedelta(days=1)) for k in range(0, 3000, 500)]
    loaded.upsert(frame(spark, delta), [F.col("at").desc()])
    assert rows(loaded.read()) == newest(first, delta)


def test_loads_of_a_partitioned_table(spark, tmp_path):
    plain = PartitionedTable(spark, str(tmp_path), "day")
    assert plain.loads() == {}
    plain.replace(frame(spark, [(1, "x", 1, START), (1, "x", 1, None)]))
    assert set(plain.loads()) == {str(START), None}
