"""One key holding a third of all rows, or more: same results, and no task that gets them all."""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from stratalake import shared_root
from stratalake.operators import checks, compare
from stratalake.operators.dedup import latest_per_key
from stratalake.plans import marts


@contextmanager
def settings(spark, **options):
    options = {k.replace("__", "."): v for k, v in options.items()}
    before = {k: spark.conf.get(k, None) for k in options}
    for key, value in options.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def written(spark, frame):
    path = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.parquet(path)


def hot_purchases(spark, n=60000):
    hot = (F.col("id") % 3) == 0
    rows = spark.range(n, numPartitions=8).select(
        F.col("id").alias("purchase_id"),
        F.when(hot, 7).otherwise(F.col("id") % 500).alias("user_id"),
        F.when(hot, 11).when(F.col("id") % 3 == 1, F.col("id") % 300).alias("product_id"),  # a third is NULL
        F.timestamp_seconds(F.col("id") * 60).alias("purchased_at"),
        F.timestamp_seconds(F.col("id") * 60).alias("added_to_cart_at"),
        F.lit(None).cast("timestamp").alias("returned_at"),
        F.lit(None).cast("timestamp").alias("loaded_at"),
    )
    return written(spark, rows)


def products(spark):
    rows = spark.range(300).select(
        F.col("id").alias("product_id"), F.lit("m").alias("make"), F.lit("n").alias("model"),
        F.lit("2.00").cast("decimal(10,2)").alias("price"),
    )
    return written(spark, rows)


def test_hot_product_partition_is_split(spark):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        purchases = hot_purchases(spark)
        fact = marts.fct_purchases(purchases, products(spark))
        assert "skew=true" in plan(fact)
        assert fact.count() == 60000
        assert fact.where("product_price IS NOT NULL").count() == 40000


def test_latest_per_key_keeps_one_row_per_task_before_the_shuffle(spark):
    purchases = hot_purchases(spark)
    newest = latest_per_key(purchases, ["user_id"], [F.col("purchased_at").desc_nulls_first(), F.col("purchase_id").desc()])
    text = plan(newest)
    partial, final = text.index("row_number(), 1, Final"), text.index("row_number(), 1, Partial")
    assert partial < text.index("Exchange hashpartitioning(user_id", partial) < final
    assert newest.where("user_id = 7").first().purchase_id == 59997


def test_foreign_keys_are_counted_before_the_join(spark):
    """With a parent too large to broadcast; a small one filters the rows map-side instead."""
    purchases = hot_purchases(spark)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        missing = checks.orphans(purchases, "user_id", spark.range(1, 500).withColumnRenamed("id", "key"), "key")
        assert [(r.value, r.n) for r in missing.collect()] == [(0, 80)]
        tree = missing._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("LeftAnti") < tree.index("Aggregate [user_id")


def test_repeated_keys_are_not_paired(spark):
    a = spark.range(20000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    result = compare.compare_relations(a, a, ["k"])
    assert [(r.status, r["keys"]) for r in result.collect()] == [("duplicate_key", 2)]
    assert "Join" not in result._jdf.queryExecution().optimizedPlan().toString()


def test_measures_of_a_hot_user(spark):
    users = spark.range(500).select(
        F.col("id").alias("user_id"), *[F.lit("x").alias(c) for c in ("full_name", "email", "occupation", "city", "state", "country_code")],
        F.lit(30).alias("age"), F.lit(None).cast("timestamp").alias("created_at"),
    )
    purchases = hot_purchases(spark)
    dim = {r.user_id: r.total_purchases for r in marts.dim_users(users, purchases, products(spark)).collect()}
    assert dim[7] == 20000 + 80 and sum(dim.values()) == 60000
