import uuid

from core_helpers import rows, ts
from pyspark.sql import functions as F

from stratalake import shared_root
from stratalake.operators.incremental import read_partitions
from stratalake.plans import staging
from stratalake.streaming import deduplicate, raw_stream, upsert_stream


def arrive(spark, folder, emitted, *purchases):
    data = [
        (f"r{i}", f'{{"id": {i}, "user_id": 1, "product_id": {product}, "purchased_at": "{at}"}}', ts(emitted))
        for i, product, at in purchases
    ]
    frame = spark.createDataFrame(data, "record_id string, data string, emitted_at timestamp")
    frame.coalesce(1).write.mode("append").parquet(f"{folder}/arrivals")


def load(spark, folder, dedup=None, files=1):
    stream = raw_stream(spark, f"{folder}/arrivals", max_files_per_trigger=files)
    stream = deduplicate(stream, dedup, "emitted_at", "1 hour") if dedup else stream
    staged = staging.stg_purchases(stream).withColumn("day", F.to_date("purchased_at"))
    upsert_stream(staged, f"{folder}/table", f"{folder}/checkpoint", ["purchase_id"], [F.col("loaded_at").desc()], "day").awaitTermination()
    table = read_partitions(spark, f"{folder}/table", "day", staged.schema)
    return table.select("purchase_id", "product_id", F.col("day").cast("string"))


def test_late_and_corrected_rows_update_their_own_day(spark):
    folder = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    arrive(spark, folder, "2024-01-01 10:00:00", (1, 10, "2024-01-01T08:00:00Z"), (2, 10, "2024-01-01T09:00:00Z"))
    assert rows(load(spark, folder)) == [(1, 10, "2024-01-01"), (2, 10, "2024-01-01")]
    # Next start: a new day, a correction of purchase 2 and a late row of the first day.
    arrive(spark, folder, "2024-01-02 10:00:00", (3, 11, "2024-01-02T08:00:00Z"), (2, 99, "2024-01-01T09:00:00Z"))
    arrive(spark, folder, "2024-01-02 11:00:00", (4, 12, "2024-01-01T23:00:00Z"))
    assert rows(load(spark, folder)) == [(1, 10, "2024-01-01"), (2, 99, "2024-01-01"), (3, 11, "2024-01-02"), (4, 12, "2024-01-01")]
    # Nothing new arrived: nothing changes.
    assert load(spark, folder).count() == 4


def test_redelivered_records_are_dropped_within_the_watermark(spark):
    folder = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    arrive(spark, folder, "2024-01-01 10:00:00", (1, 10, "2024-01-01T08:00:00Z"), (1, 10, "2024-01-01T08:00:00Z"))
    arrive(spark, folder, "2024-01-01 10:30:00", (1, 77, "2024-01-01T08:00:00Z"), (2, 10, "2024-01-01T08:00:00Z"))
    assert rows(load(spark, folder, dedup=["record_id"])) == [(1, 10, "2024-01-01"), (2, 10, "2024-01-01")]


def test_batches_and_order_make_no_difference(spark):
    """A correction that arrives before what it corrects wins, in one batch or in several."""
    found = []
    for files in (1, 10):
        folder = f"{shared_root(spark)}/{uuid.uuid4().hex}"
        arrive(spark, folder, "2024-01-03 10:00:00", (1, 10, "2024-01-02T08:00:00Z"))
        arrive(spark, folder, "2024-01-01 10:00:00", (1, 77, "2024-01-01T08:00:00Z"), (2, 5, "2024-01-01T08:00:00Z"))
        arrive(spark, folder, "2024-01-03 10:00:00", (1, 10, "2024-01-02T08:00:00Z"))
        found.append(rows(load(spark, folder, files=files)))
    assert found[0] == found[1] == [(1, 10, "2024-01-02"), (2, 5, "2024-01-01")]
