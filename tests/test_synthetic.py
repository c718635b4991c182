"""Generated records and order-line keys far beyond the samples."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.sources import sample_tables, synthetic


def test_every_user_can_buy(spark):
    drawn = synthetic.purchases(synthetic.ids(spark, 20_000), n_users=100_000_000, n_products=10)
    low, high, users = drawn.agg(F.min("user_id"), F.max("user_id"), F.count_distinct("user_id")).first()
    assert low < 50_000 and high > 99_950_000 and users > 19_990
    tenths = drawn.groupBy(F.floor(F.col("user_id") / 10_000_000)).count().collect()
    assert len(tenths) == 10 and all(1800 < r["count"] < 2200 for r in tenths)


def test_products_and_slices(spark):
    ids = synthetic.ids(spark, 2500, records_per_slice=1000)
    assert ids.rdd.getNumPartitions() == 3
    streams = synthetic.synthetic_raw(spark, 10, n_products=7)
    assert {name: rows.count() for name, rows in streams.items()} == {"raw_users": 10, "raw_products": 7, "raw_purchases": 10}


def test_user_fields_are_those_of_the_seed(spark):
    from stratalake.sources.seed import seed_records

    keys = lambda rows: rows.selectExpr("json_object_keys(data) AS k").first().k
    generated = synthetic.synthetic_raw(spark, 1)["raw_users"]
    assert keys(generated) == keys(seed_records(spark)["raw_users"])


def test_order_lines_keep_their_keys_apart(spark, tmp_path):
    when = datetime(2024, 1, 1)
    line = lambda order, number, part, flag="N": (order, part, 1, number, 1.0, 2.0, 0.0, 0.0, flag, "O", when)
    big = 10**10
    lines = [line(big, 1, 5), line(big, 1, 5), line(big, 1, 6, "R"), line(big, 2, 5), line(big + 1, 1, 10**9), line(1, 1, 1)]
    spark.createDataFrame(lines, sample_tables.SCHEMAS["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(o, o % 97, "O", 1.0, when, "x") for o in (big, big + 1, 1)]
    spark.createDataFrame(orders, sample_tables.SCHEMAS["orders"]).write.parquet(f"{tmp_path}/orders.parquet")
    found = sample_tables.order_line_purchases(spark, str(tmp_path)).collect()
    assert len(found) == len({r.purchase_id for r in found}) == len(lines)
    assert sum(r.returned_at is not None for r in found) == 1


def test_order_line_keys_have_no_bounds(spark):
    """Large, negative and missing line numbers, and thousands of lines of one number, have keys of their own."""
    numbers = [None, -9, -1, 0, 1, 7, 8, 9, 15, 16, 1000, 10**6]
    lines = [(o, n, k) for o in (0, 1, 2, 3) for n in numbers for k in (1, 2, 3, 1024, 1025)]
    lines += [(10**11, n, k) for n in numbers[:9] for k in (1, 2, 3, 1024, 1025)] + [(5, 1, k) for k in range(1, 20_001)]
    key = sample_tables.order_line_key(F.col("o"), F.col("n"), F.col("k")).alias("key")
    keys = [r.key for r in spark.createDataFrame(lines, "o bigint, n int, k int").select(key).collect()]
    assert None not in keys and len(set(keys)) == len(lines) and min(keys) >= 0
    assert all(k >> 6 >> (k & 63) == order for (order, *_), k in zip(lines, keys))
    with pytest.raises(PySparkException, match="OVERFLOW"):  # 37 + 42 + 6 bits
        spark.createDataFrame([(10**11, 10**6, 1)], "o bigint, n int, k int").select(key).collect()
