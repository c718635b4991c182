import random
from datetime import datetime, timedelta

import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from stratalake.streaming import LateRowsTable

SCHEMA = "id long, at timestamp, version int, day date"
START = datetime(2024, 6, 1)


def table(spark, folder, hours=2):
    schema = spark.createDataFrame([], SCHEMA).schema
    newest = [F.col("version").desc()]
    return LateRowsTable(spark, str(folder), schema, ["id"], newest, "day", "at", timedelta(hours=hours))


def row(k, hours, version=1):
    at = None if hours is None else START + timedelta(hours=hours)
    return (k, at, version, at and at.date())


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def newest(data):
    best = {}
    for r in data:
        best[r[0]] = max(best.get(r[0], r), r, key=lambda x: x[2])
    return sorted(best.values(), key=str)


def test_no_row_is_lost_in_any_split(spark, tmp_path):
    rng = random.Random(7)
    data = [row(k, rng.choice([None, rng.randrange(72)]), 10 * k + v) for k in range(20) for v in range(rng.randrange(1, 3))]
    for split in (1, 3):
        rng.shuffle(data)
        kept = table(spark, tmp_path / str(split))
        batches = [data[k::split] for k in range(split)]
        for number, batch in enumerate(batches):
            kept.load(frame(spark, batch), number)
        assert rows(kept.read()) == newest(data)
        seen, missed = None, []
        for batch in batches:
            mark = seen and seen - timedelta(hours=2)
            missed += [r for r in batch if mark and r[1] and r[1] < mark]
            seen = max([t for t in [seen, *[r[1] for r in batch]] if t])
        assert rows(kept.late().drop("missed_mark", "batch_id")) == sorted(missed, key=str)
        loads = kept.loads().orderBy("batch_id").collect()
        assert [r.row_count for r in loads] == [len(b) for b in batches]
        assert sum(r.late_count for r in loads) == len(missed) and max(r.newest for r in loads) == seen


def test_a_batch_that_is_done_again(spark, tmp_path, monkeypatch):
    kept = table(spark, tmp_path)
    kept.load(frame(spark, [row(1, 0), row(2, 30)]), 0)
    second = [row(3, 1), row(1, 31, 2), row(4, None)]
    with monkeypatch.context() as patch:
        patch.setattr(kept._loads, "replace", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            kept.load(frame(spark, second), 1)
    again = table(spark, tmp_path)
    for _ in range(2):
        again.load(frame(spark, second), 1)
        assert rows(again.read()) == newest([row(2, 30), *second])
        assert [(r.id, r.missed_mark, r.batch_id) for r in again.late().collect()] == [(3, START + timedelta(hours=28), 1)]
        assert [r.late_count for r in again.loads().orderBy("batch_id").collect()] == [0, 1]


def test_a_stream_of_files(spark, tmp_path):
    parts = [[row(1, 0), row(2, 50)], [row(3, 1), row(3, 1)], [row(2, 50), row(4, 49)], []]
    for part in parts:
        frame(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/arrivals")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/arrivals")
    kept = table(spark, tmp_path / "kept")
    kept.start(stream).awaitTermination()
    want = newest([r for part in parts for r in part])
    assert rows(kept.read()) == want
    assert {r.id for r in kept.late().collect()} == {3}
    kept.start(stream).awaitTermination()  # nothing new
    assert rows(kept.read()) == want
