from datetime import date

import pytest
from core_helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake import estimated_bytes, shared_root, size_shuffles
from stratalake.operators import checks
from stratalake.operators.contracts import ContractViolation, contract_diff, enforce
from stratalake.operators.publish import HISTORY_LAYER, GateClosed, write_audit_publish
from stratalake.plans.build import build, write_together
from stratalake.sources.seed import seed_if_empty, seed_records

CONTRACT = [("id", "bigint"), ("amount", "decimal(5,1)")]


def numbers(spark, *values):
    return spark.createDataFrame(values, "id bigint, amount decimal(12,4)")


def money(text):
    from decimal import Decimal

    return Decimal(text)


def test_contract_problems(spark):
    frame = spark.createDataFrame([(1, "x", 2)], "id int, name string, extra int")
    found = rows(contract_diff(frame, [("id", "bigint"), ("name", "string"), ("gone", "date")]))
    assert found == [
        ("extra", "unexpected", None, "int", 1),
        ("gone", "missing", "date", None, 1),
        ("id", "type_mismatch", "bigint", "int", 1),
    ]
    held = contract_diff(numbers(spark, (1, money("1.0")), (2, None)), CONTRACT)
    assert held.isEmpty() and held.columns == contract_diff(frame, CONTRACT).columns
    wide = contract_diff(numbers(spark, (1, money("12345.0")), (2, money("9999.95")), (3, money("9999.94")), (4, None)), CONTRACT)
    assert rows(wide) == [("amount", "overflow", "decimal(5,1)", "decimal(12,4)", 2)]


def test_contract_orders_columns_and_settles_precision(spark):
    frame = spark.createDataFrame([(money("12.25"), 1)], "amount decimal(10,2), id bigint")
    result = enforce(frame, CONTRACT)
    assert result.dtypes == [("id", "bigint"), ("amount", "decimal(5,1)")]
    assert rows(result) == [(1, money("12.3"))]
    with pytest.raises(ContractViolation, match="amount: missing"):
        enforce(frame.drop("amount"), CONTRACT)


def test_overflow_raises(spark):
    with pytest.raises(PySparkException):
        enforce(numbers(spark, (1, money("12345.0"))), CONTRACT).collect()


def test_blocked_rows_never_reach_the_public_name(spark, warehouse):
    gate = [checks.unique("id"), checks.not_null("amount", severity="warn")]
    good = numbers(spark, (1, money("1.0")), (2, None))
    report = write_audit_publish(warehouse, good, "marts", "t", 1, CONTRACT, gate)
    assert (report.outcome, report.row_count) == ("published", 2)
    assert {r.status for r in report.results} == {"pass", "warn"}

    bad = numbers(spark, (3, money("1.0")), (3, money("2.0")))
    with pytest.raises(GateClosed, match="unique_t_id"):
        write_audit_publish(warehouse, bad, "marts", "t", 1, CONTRACT, gate, store_failures=True)
    assert {r.id for r in warehouse.ref("marts", "t").collect()} == {1, 2}
    assert warehouse.ref("check_failures", "marts_unique_t_id").count() == 2

    with pytest.raises(ContractViolation):
        write_audit_publish(warehouse, bad.drop("amount"), "marts", "t", 1, CONTRACT, gate)
    runs = warehouse.ref(HISTORY_LAYER, "run_results")
    by_kind = lambda kind: sorted(r.status for r in runs.collect() if r.resource_type == kind)
    assert by_kind("model") == ["error", "error", "success"]
    assert by_kind("contract") == ["fail", "pass", "pass"]
    assert warehouse.ref(HISTORY_LAYER, "quality_results").where("status = 'fail'").count() == 1


def test_rejected_rows_are_those_of_the_last_run_in_the_layer(spark, warehouse):
    gate = [checks.unique("id"), checks.not_null("amount", severity="warn")]
    stored = lambda layer, name: warehouse.ref("check_failures", f"{layer}_{name}").collect()
    bad = numbers(spark, (3, money("1.0")), (3, None))
    for layer in ("marts", "gold"):
        with pytest.raises(GateClosed):
            write_audit_publish(warehouse, bad, layer, "t", 1, CONTRACT, gate, store_failures=True)
    good = numbers(spark, (3, money("1.0")), (4, money("2.0")))
    write_audit_publish(warehouse, good, "marts", "t", 1, CONTRACT, gate, store_failures=True)
    nulls = next(c for c in gate if c.test_type == "not_null").name("t")
    assert stored("marts", "unique_t_id") == stored("marts", nulls) == []
    kept = stored("gold", "unique_t_id") + stored("gold", nulls)
    assert [r.id for r in kept] == [3, 3, 3] and len({r.invocation_id for r in kept}) == 1


def test_closed_gate_stops_the_build(spark, warehouse):
    raw = seed_records(spark)
    raw["raw_users"] = raw["raw_users"].where("get_json_object(data, '$.id') <> '4'")
    with pytest.raises(GateClosed, match="relationships_stg_purchases_user_id"):
        build(warehouse, raw)
    assert warehouse.exists("staging", "stg_users")
    assert not warehouse.exists("staging", "stg_purchases")
    assert not warehouse.exists("marts", "dim_users")


def test_versions(spark, warehouse):
    first, second = numbers(spark, (1, money("1.0"))), numbers(spark, (2, money("2.0")))
    warehouse.overwrite(first, "gold", "g", version=1)
    warehouse.overwrite(second, "gold", "g", version=2)
    assert (warehouse.ref("gold", "g").first().id, warehouse.ref("gold", "g", 1).first().id) == (2, 1)
    warehouse.overwrite(numbers(spark, (9, None)), "gold", "g", version=1)
    assert (warehouse.ref("gold", "g").first().id, warehouse.ref("gold", "g", 1).first().id) == (2, 9)
    with pytest.warns(DeprecationWarning, match="2025-06-30"):
        warehouse.overwrite(first, "gold", "g", version=1, deprecated_on=date(2025, 6, 30))
    assert warehouse.deprecated_on("gold", "g", 2) is None
    # A declared latest version wins over the highest.
    warehouse.overwrite(numbers(spark, (5, None)), "gold", "g", version=3, latest_version=2)
    assert (warehouse.ref("gold", "g").first().id, warehouse.ref("gold", "g", 3).first().id) == (2, 5)
    with pytest.raises(ValueError, match="stands for a version"):
        warehouse.append(first, "gold", "g")


def test_seed_refresh_and_append_share_a_name(spark, warehouse):
    one, two = numbers(spark, (1, money("1.0"))), numbers(spark, (2, money("2.0")))
    ids = lambda: sorted(r.id for r in warehouse.ref("raw", "t").collect())
    assert seed_if_empty(warehouse, one, "raw", "t")
    warehouse.append(two, "raw", "t")
    assert ids() == [1, 2]
    warehouse.overwrite(two, "raw", "t")
    assert ids() == [2] and not seed_if_empty(warehouse, one, "raw", "t")
    warehouse.overwrite(two.where("id > 9"), "raw", "t")
    assert seed_if_empty(warehouse, one, "raw", "t") and ids() == [1]
    warehouse.drop_old_generations("raw", "t")
    assert ids() == [1]


def test_quotes_in_contracts(spark):
    odd = spark.createDataFrame([(1, "a")], "`it's` bigint, `back``tick` string")
    found = contract_diff(odd, [("it's", "string"), ("a'b", "int"), ("back`tick", "string")])
    assert {(r.column_name, r.problem) for r in found.collect()} == {("it's", "type_mismatch"), ("a'b", "missing")}
    assert enforce(odd, [("back`tick", "string"), ("it's", "bigint")]).columns == ["back`tick", "it's"]


def test_a_table_can_be_replaced_by_rows_computed_from_itself(spark, warehouse):
    warehouse.overwrite(numbers(spark, (1, money("1.0")), (2, money("2.0"))), "marts", "t")
    table = warehouse.ref("marts", "t")
    replaced = warehouse.overwrite(table.where("id = 2").union(table.where("id = 2")), "marts", "t")
    assert sorted(r.id for r in replaced.collect()) == [2, 2]
    assert sorted(r.id for r in table.collect()) == [1, 2]  # an open reader keeps its rows
    warehouse.write_generation(table, "marts", "t")  # never published, as after a closed gate
    assert warehouse.drop_old_generations("marts", "t") == 1
    assert warehouse.ref("marts", "t").count() == 2


def test_partitioned_write_and_layer_names(spark, warehouse):
    frame = spark.range(100).withColumn("day", (F.col("id") % 3).cast("int"))
    table = warehouse.overwrite(frame, "marts", "p", partition_by=["day"])
    assert table.where("day = 1").count() == 33
    assert warehouse.database("marts") == f"{warehouse.namespace}marts"
    view = warehouse.as_view(table.where("day = 0"), f"{warehouse.namespace}v")
    assert view.count() == 34 and spark.sql(f"SELECT count(*) FROM {warehouse.namespace}v").first()[0] == 34


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shuffles_are_sized_by_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1000) == 4
        assert size_shuffles(spark, 2 << 40) == 4096
        assert size_shuffles(spark, 100 << 40) == 204_800  # in proportion, without a ceiling
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_input_is_what_the_sources_hold(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/a")
    one = spark.read.parquet(f"{tmp_path}/a")
    assert 0 < estimated_bytes(one) == estimated_bytes(one.groupBy("id").count())
    assert estimated_bytes(one.join(one.withColumnRenamed("id", "b"))) == 2 * estimated_bytes(one)


def test_build_sizes_its_shuffles(spark, warehouse):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        raw = write_together(warehouse, seed_records(spark))
        build(warehouse, raw, input_bytes=3 << 30)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "6"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
