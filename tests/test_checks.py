from datetime import timedelta

import pytest
from core_helpers import rows, ts
from pyspark.sql import functions as F

from stratalake.operators import checks
from stratalake.plans.spec import CHECKS


@pytest.fixture
def table(spark):
    values = [(1, "a", 5, 10), (2, "a", -1, 11), (3, "b", None, 99), (None, None, 7, None), (3, "zz", 0, 99), (3, "b", 1, 98)]
    return spark.createDataFrame(values, "id int, kind string, amount int, parent int")


def run(table, *declared, parents=None):
    found = checks.run_checks(table, "layer", "t", declared, parents).collect()
    return {(r.test_type, r.column_name): (r.failures, r.status) for r in found}


def test_every_kind_finds_its_violations(spark, table):
    parents = {"p": spark.range(10, 20).withColumnRenamed("id", "key")}
    found = run(
        table,
        checks.not_null("id"),
        checks.unique("id"),
        checks.accepted_values("kind", ["a"]),
        checks.relationships("parent", "p", "key"),
        checks.expression_is_true("amount", ">= 0"),
        checks.between("amount", 0, 5),
        checks.matches("kind", "^[a-z]$"),
        checks.not_null_proportion("kind", 0.9),
        checks.not_null_proportion("amount", 0.8),
        parents=parents,
    )
    assert found == {
        ("not_null", "id"): (1, "fail"),
        ("unique", "id"): (1, "fail"),  # one value repeated three times
        ("accepted_values", "kind"): (2, "fail"),  # two values on three rows
        ("relationships", "parent"): (3, "fail"),  # rows, not values
        ("expression_is_true", "amount"): (1, "fail"),
        ("between", "amount"): (2, "fail"),
        ("matches", "kind"): (1, "fail"),
        ("not_null_proportion", "kind"): (1, "fail"),
        ("not_null_proportion", "amount"): (0, "pass"),
    }


def test_clean_rows_pass(spark, table):
    clean = table.where("id = 1")
    parents = {"p": spark.range(10, 20).withColumnRenamed("id", "key")}
    found = run(
        clean,
        checks.not_null("id"),
        checks.unique("id"),
        checks.unique("kind"),
        checks.accepted_values("kind", ["a"]),
        checks.relationships("parent", "p", "key"),
        checks.expression_is_true("amount", ">= 0"),
        parents=parents,
    )
    assert set(found.values()) == {(0, "pass")} and len(found) == 6


def test_empty_table_passes_and_reports_every_check(table):
    found = run(table.where(F.lit(False)), checks.not_null("id"), checks.unique("id"), checks.accepted_values("kind", ["a"]))
    assert len(found) == 3 and set(found.values()) == {(0, "pass")}


@pytest.mark.parametrize(
    "options,status",
    [
        ({}, "fail"),
        ({"severity": "warn"}, "warn"),
        ({"warn_above": 0, "error_above": 10}, "warn"),
        ({"warn_above": 1, "error_above": 10}, "pass"),
        ({"severity": "warn", "warn_above": 5}, "pass"),
    ],
)
def test_severity_and_thresholds(table, options, status):
    assert run(table, checks.not_null("id", **options))[("not_null", "id")] == (1, status)


def test_quotes_in_names_are_kept(table):
    found = checks.run_checks(table, "la'yer", "t\\x", [checks.not_null("id")]).first()
    assert (found.schema_name, found.table_name) == ("la'yer", "t\\x")


def test_failing_rows(spark, table):
    parents = {"p": spark.range(10, 20).withColumnRenamed("id", "key")}
    assert checks.failing_rows(table, checks.unique("id")).count() == 3
    assert checks.failing_rows(table, checks.not_null("id")).count() == 1
    assert checks.failing_rows(table, checks.relationships("parent", "p", "key"), parents).count() == 3
    assert rows(checks.failing_rows(table, checks.accepted_values("kind", ["a", "b"])).select("kind")) == [("zz",)]


def test_declared_suite_has_54_checks():
    declared = [c for table in CHECKS.values() for c in table]
    kinds = {k: sum(c.test_type == k for c in declared) for k in {c.test_type for c in declared}}
    assert len(declared) == 54
    assert kinds == {"not_null": 33, "unique": 10, "relationships": 7, "accepted_values": 1, "expression_is_true": 3}


def test_freshness_boundaries(spark):
    now = ts("2024-02-02 00:00:00")
    ages = {"fresh": timedelta(hours=12), "old": timedelta(hours=12, seconds=1), "edge": timedelta(hours=24), "stale": timedelta(hours=24, seconds=1)}
    sources = {n: spark.createDataFrame([(now - a,), (now - a - timedelta(days=9),)], "at timestamp") for n, a in ages.items()}
    sources["empty"] = sources["fresh"].where(F.lit(False))
    found = {r.source_name: r.status for r in checks.freshness(sources, "at", F.lit("2024-02-02 00:00:00").cast("timestamp")).collect()}
    assert found == {"fresh": "pass", "old": "warn", "edge": "warn", "stale": "error", "empty": "error"}


def test_unique_is_the_same_alone_and_among_others(spark):
    zeros = spark.createDataFrame([(0.0, "a", 1), (-0.0, "b", 1), (2.0, "2.0", 2)], "x double, y string, z int")
    alone = run(zeros, checks.unique("x"))
    among = run(zeros, checks.unique("x"), checks.unique("y"), checks.unique("z"))
    assert alone["unique", "x"] == among["unique", "x"] == (1, "fail")
    assert among["unique", "y"] == (0, "pass") and among["unique", "z"] == (1, "fail")


def test_names_tell_arguments_and_options_apart():
    declared = [
        checks.expression_is_true("age", ">= 0"),
        checks.expression_is_true("age", "< 150"),
        checks.not_null("age"),
        checks.not_null("age", severity="warn"),
        checks.accepted_values("age", [1]),
        checks.accepted_values("age", [2]),
    ]
    assert len({c.name("u") for c in declared}) == len(declared)
    assert checks.not_null("age").name("u") == "not_null_u_age"


def test_two_passes_over_the_table(spark, tmp_path):
    """One scan counts rows and row-level failures, one counts values; parents are scanned for their keys."""
    spark.range(100).selectExpr("id", "id % 7 AS k", "cast(id AS string) AS s").write.parquet(f"{tmp_path}/t")
    spark.range(5).write.parquet(f"{tmp_path}/p")
    table, parent = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/p")
    declared = [
        checks.not_null("id"),
        checks.expression_is_true("k", ">= 0"),
        checks.unique("id"),
        checks.unique("s"),
        checks.relationships("k", "p", "id"),
        checks.accepted_values("k", [0, 1]),
    ]
    counted = checks.failure_counts(table, declared, {"p": parent}, with_total=True)
    found = {r.no: r.failures for r in counted.collect()}
    assert found == {checks.TOTAL: 100, 0: 0, 1: 0, 2: 0, 3: 0, 4: 28, 5: 5}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3 and plan.count("Join") == 1
