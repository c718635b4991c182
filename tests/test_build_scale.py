"""The steps of a large build: each does what its form for small tables does, with less."""

from datetime import datetime

import pytest
from core_helpers import ts
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_skew import hot_purchases, plan, products, settings

from stratalake.operators import checks
from stratalake.plans import marts, staging
from stratalake.sources import sample_tables
from stratalake.sources.envelope import to_envelope

DECLARED = [
    checks.not_null("id"),
    checks.unique("id"),
    checks.unique("x"),
    checks.unique("kind"),
    checks.accepted_values("kind", ["a"]),
    checks.relationships("parent", "p", "key"),
    checks.relationships("parent", "q", "key"),
    checks.relationships("id", "q", "key"),
    checks.relationships("kind", "p", "key"),
]


def counts(table, parents, **options):
    found = checks.failure_counts(table, DECLARED, parents, with_total=True, **options).collect()
    return {r.no: r.failures for r in found}


def test_a_pass_per_column_counts_what_a_shared_pass_counts(spark):
    values = [(1, 0.0, "a", 10), (2, -0.0, "a", 11), (3, 1.0, "b", None), (None, None, None, 12), (3, 2.0, "zz", 12), (3, None, "12", 98)]
    table = spark.createDataFrame(values, "id int, x double, kind string, parent int")
    keys = spark.createDataFrame([("10",), ("12",), ("12",), ("no number",), (None,)], "key string")
    parents = {"p": keys, "q": spark.range(1, 12).withColumnRenamed("id", "key")}
    expected = {checks.TOTAL: 6, 0: 1, 1: 1, 2: 1, 3: 1, 4: 3, 5: 2, 6: 3, 7: 0, 8: 4}
    assert counts(table, parents, shared_pass=0) == counts(table, parents, shared_pass=1 << 40) == expected
    empty = table.where(F.lit(False))
    assert counts(empty, parents, shared_pass=0) == counts(empty, parents, shared_pass=1 << 40) == dict.fromkeys(expected, 0)


def test_in_a_large_table_only_foreign_keys_meet_a_parent(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 AS k").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    declared = [checks.unique("id"), checks.relationships("k", "p", "id")]
    counted = checks.failure_counts(table, declared, {"p": spark.range(5)}, shared_pass=0)
    assert {r.no: r.failures for r in counted.collect()} == {0: 0, 1: 28}
    tree = counted._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("Join") == 1 and "Expand" not in tree and "explode" not in tree.lower()


def test_the_fact_is_hashed_not_sorted(spark):
    with settings(
        spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"
    ):
        text = plan(marts.fct_purchases(hot_purchases(spark), products(spark)))
    final = text[: text.index("Initial Plan")]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final


def staged(spark, payload):
    raw = spark.createDataFrame([("r", payload, ts("2024-02-01 00:00:00"))], "record_id string, data string, emitted_at timestamp")
    return tuple(staging.stg_purchases(raw).first())[:-1]


@pytest.mark.parametrize(
    "payload, expected",
    [
        ('{"id": 1, "user_id": null, "product_id": 3, "purchased_at": "2024-01-02T03:04:05.000006Z"}', (1, None, 3, datetime(2024, 1, 2, 3, 4, 5, 6))),
        ('{"id": "7", "user_id": " 8 ", "product_id": 2024.0}', (7, 8, 2024, None)),
        ('{"id": 1, "id": 2, "user_id": "x", "user_id": 3}', (2, 3, None, None)),
        ('{"id": 1, "purchased_at": 2024.0}', (1, None, None, datetime(2024, 1, 1))),
        ('{"id": 1, "purchased_at": 2024}', (1, None, None, datetime(2024, 1, 1))),
        ('{"id": 1, "purchased_at": "2024-01-15T10:00:00+02:00", "other": {"id": 9}}', (1, None, None, datetime(2024, 1, 15, 8))),
        ('[{"id": 1}]', (None,) * 4),
        (' {"id": 5}', (5, None, None, None)),
        ("3", (None,) * 4),
        (None, (None,) * 4),
    ],
)
def test_purchases_are_read_as_their_texts_are(spark, payload, expected):
    assert staged(spark, payload)[:4] == expected


@pytest.mark.parametrize(
    "payload",
    ['{"id": "x"}', '{"id": 1.5}', '{"id": true}', '{"id": {}}', '{"id": ""}', '{"id": 1', "", '{"id": 12345678901234567890}']
    + ['{"id": 1, "other": NaN}', "{'id': 1}", '{"purchased_at": "soon"}', '{"purchased_at": ""}', '{"purchased_at": true}'],
)
def test_bad_purchases_raise(spark, payload):
    with pytest.raises((PySparkException, Py4JJavaError)):
        staged(spark, payload)


def test_plain_purchases_are_read_once(spark):
    raw = spark.createDataFrame([('{"id": 1}', ts("2024-02-01 00:00:00"))], "data string, emitted_at timestamp")
    tree = staging.stg_purchases(raw)._jdf.queryExecution().analyzed().toString()
    assert tree.count("from_json(") == 1


def test_records_of_order_lines_are_their_purchases(spark, tmp_path):
    """Lines that repeat, lack values or an order, and orders without a time give the same payloads."""
    line = "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    at = datetime(2024, 3, 1, 2, 3, 4, 567890)
    values = [(1, 1, "R", at), (1, 1, "R", None), (1, 1, "R", at), (2, None, "N", at), (3, 4, None, None), (9, 1, "R", at), (None, 1, "R", at)]
    rows = [(o, 7, 8, n, 1.0, 2.0, 0.0, None, f, "O", t) for o, n, f, t in values]
    first = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    schema = first + line.split("l_suppkey long, ")[1] + ", l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, 5, "O", 1.0, datetime(2024, 1, 1), "1"), (2, None, "O", 1.0, None, "1"), (3, 6, "O", 1.0, at, "1")]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, schema).write.parquet(f"{tmp_path}/orders.parquet")
    typed = sample_tables.order_line_purchases(spark, str(tmp_path)).drop("loaded_at").withColumnRenamed("purchase_id", "id")
    emitted = sample_tables.emitted_at()
    found = sorted(r.data for r in to_envelope(sample_tables.order_line_records(spark, str(tmp_path)), emitted).collect())
    assert found == sorted(r.data for r in to_envelope(typed, emitted).collect()) and len(found) == 5
