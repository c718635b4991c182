"""The bundled sample tables read as users, products, purchases and run history.

The sample tables carry no NULL dates, no dangling references and no returns, so fixed
rules inject them: every rule is a plain expression over the row, applied to all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.sources.envelope import TIME_FORMAT

EMITTED_AT = "2024-02-01 00:00:00"

USERS = """
    named_struct(
      'id', c_custkey,
      'name', c_name,
      'email', concat('user', c_custkey, '@example.com'),
      'gender', CASE c_custkey % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female'
                WHEN 2 THEN 'Fluid' WHEN 3 THEN 'Other' END,
      'title', CASE c_custkey % 4 WHEN 0 THEN 'Mr.' WHEN 1 THEN 'Ms.' WHEN 2 THEN 'Dr.' END,
      'occupation', c_mktsegment,
      'nationality', n_name,
      'language', r_name,
      'academic_degree', CASE c_custkey % 3 WHEN 0 THEN 'Bachelor' WHEN 1 THEN 'Master' ELSE 'PhD' END,
      'age', CAST(18 + c_custkey % 60 AS INT),
      'blood_type', CASE c_custkey % 4 WHEN 0 THEN 'O+' WHEN 1 THEN 'A+' WHEN 2 THEN 'B+' ELSE 'AB+' END,
      'address', named_struct(
        'city', concat(n_name, ' City'),
        'state', r_name,
        'country_code', n_name,
        'postal_code', CAST(10000 + c_custkey % 90000 AS STRING),
        'street_name', 'Market St',
        'street_number', CAST(c_custkey % 999 AS STRING)),
      'created_at', TIMESTAMP '2023-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 300 AS INT)),
      'updated_at', TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(0, CAST(c_custkey % 700 AS INT)))
"""

PRODUCTS = """
    named_struct(
      'id', p_partkey,
      'make', p_brand,
      'model', p_name,
      'year', CAST(2000 + p_size % 25 AS INT),
      'price', CAST(p_retailprice AS DECIMAL(10,2)),
      'created_at', TIMESTAMP '2023-01-01 00:00:00')
"""

PURCHASES = """
    named_struct(
      'id', event_id,
      'user_id', CASE WHEN event_id % 101 = 0 THEN -1L ELSE user_id END,
      'product_id', CASE WHEN event_id % 97 = 0 THEN 999999999L
                    ELSE CAST(get_json_object(props, '$.k') AS BIGINT) END,
      'purchased_at', CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END,
      'added_to_cart_at', CAST(ts AS TIMESTAMP) - INTERVAL 1 DAY,
      'returned_at', CASE WHEN value >= 100 THEN CAST(ts AS TIMESTAMP) + INTERVAL 10 DAY END)
"""


# Declared schemas: a read starts without a job to look into file footers first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _records(rows: DataFrame, record: str) -> DataFrame:
    return rows.select(F.expr(record).alias("record")).select("record.*")


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return _records(rows, USERS)


def product_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(table(spark, sf_dir, "part"), PRODUCTS)


def purchase_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return _records(events, PURCHASES)


def order_line_key(order: Column, number: Column, nth: Column) -> Column:
    """One bigint for an order, a line number (any, also NULL or negative) and the ``nth`` such line from 1 on.

    Number and place become one integer by Cantor's pairing, which stands below the order with its length in bits
    (six more) at the end. So no two lines share a key, whatever their number; a key beyond a bigint raises.
    """
    signed = F.when(number >= 0, number * 2 + 1).otherwise(number * -2)
    a, b = F.coalesce(signed, F.lit(0)).cast("bigint"), (nth - 1).cast("bigint")
    diagonal = (a + b) * (a + b + 1)
    place = F.call_function("div", diagonal, F.lit(2)) + b
    length = F.length(F.bin(place))
    return (order.cast("bigint") * F.call_function("shiftleft", F.lit(1).cast("bigint"), length) + place) * 64 + length


def _order_lines(spark: SparkSession, sf_dir: str, time: Callable[[str], Column]) -> DataFrame:
    """One purchase per order line; ``time`` gives a column's time, an order's before the order meets its lines.

    Line numbers repeat within an order, so each line is numbered among its likes, by all
    columns. Lines are dealt by order, which serves both the numbering and the join.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", time("o_orderdate").alias("ordered_at"))
    rest = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    nth = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*rest))
    numbered = lines.repartition("l_orderkey").withColumn("nth", nth)
    return numbered.join(orders, numbered.l_orderkey == orders.o_orderkey).select(
        order_line_key(F.col("l_orderkey"), F.col("l_linenumber"), F.col("nth")).alias("purchase_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("ordered_at").alias("purchased_at"),
        F.col("ordered_at").alias("added_to_cart_at"),
        F.when(F.col("l_returnflag") == "R", time("l_shipdate")).alias("returned_at"),
    )


def order_line_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger purchase fact: one purchase per order line."""
    rows = _order_lines(spark, sf_dir, lambda column: F.col(column).cast("timestamp"))
    return rows.withColumn("loaded_at", emitted_at())


def order_line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same purchases as records for an envelope, their times written as a payload has them.

    An order's time is written once, not for each of its lines and columns.
    """
    rows = _order_lines(spark, sf_dir, lambda column: F.date_format(F.col(column).cast("timestamp"), TIME_FORMAT))
    return rows.withColumnRenamed("purchase_id", "id")


def emitted_at() -> Column:
    return F.lit(EMITTED_AT).cast("timestamp")


def quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test results derived from the events: one result per event."""
    day = "CAST(CAST(ts AS DATE) AS STRING)"
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(ts AS TIMESTAMP) AS detected_at",
        f"concat('inv-', {day}) AS invocation_id",
        "CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_type = 'error' THEN 'fail' "
        "WHEN event_type = 'signup' THEN 'warn' ELSE 'pass' END AS status",
        "CASE user_id % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'marts' ELSE 'gold' END AS schema_name",
        "concat('model_', user_id % 7) AS table_name",
        "concat('c', event_id % 5) AS column_name",
        "concat('test_', event_id % 40) AS test_name",
        "event_type AS test_type",
        "CASE WHEN event_id % 6 = 0 THEN 'WARN' ELSE 'ERROR' END AS severity",
        "event_id % 4 AS failures",
        "concat('event ', event_id) AS test_results_description",
        "concat('t', event_id % 40) AS test_unique_id",
        "concat('model_', user_id % 7) AS model_unique_id",
    )


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run results derived from the events: one run per event."""
    day = "CAST(CAST(ts AS DATE) AS STRING)"
    return table(spark, sf_dir, "events").selectExpr(
        f"concat('inv-', {day}) AS invocation_id",
        "concat('model_', user_id % 7) AS name",
        "CASE event_id % 2 WHEN 0 THEN 'model' ELSE 'test' END AS resource_type",
        "CASE user_id % 2 WHEN 0 THEN 'table' ELSE 'view' END AS materialization",
        "CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 2 = 0 THEN 'success' "
        "ELSE 'pass' END AS status",
        "value AS execution_time",
        "event_id % 1000 AS rows_affected",
        "CAST(ts AS TIMESTAMP) AS execute_started_at",
        "CAST(ts AS TIMESTAMP) + INTERVAL 1 MINUTE AS execute_completed_at",
    )


def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models derived from the events; two of them are never tested."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr("user_id % 9 AS model_no")
        .distinct()
        .selectExpr(
            "concat('model_', model_no) AS unique_id",
            "concat('model_', model_no) AS name",
            "CASE model_no % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'marts' ELSE 'gold' END AS schema_name",
        )
    )
