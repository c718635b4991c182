from decimal import Decimal

import pytest
from core_helpers import ts
from pyspark.sql import functions as F

from stratalake.operators.unit_tests import UnitTest, UnitTestFailed, differences, require, run
from stratalake.plans import gold, marts
from stratalake.plans.spec import CONTRACTS, UNIT_TESTS

USERS = (
    "user_id bigint, full_name string, email string, occupation string, city string, state string, "
    "country_code string, age int, created_at timestamp"
)
PRODUCTS = "product_id bigint, make string, model string, year int, price decimal(10,2), created_at timestamp, loaded_at timestamp"
PURCHASES = (
    "purchase_id bigint, user_id bigint, product_id bigint, purchased_at timestamp, "
    "added_to_cart_at timestamp, returned_at timestamp, loaded_at timestamp"
)


def users(spark, *ids):
    day = ts("2024-01-01 00:00:00")
    return spark.createDataFrame([(i, f"U{i}", f"u{i}@x", "job", "c", "s", "US", 30, day) for i in ids], USERS)


def products(spark, *priced):
    day = ts("2024-01-01 00:00:00")
    return spark.createDataFrame([(i, f"Make{i}", f"Model{i}", 2024, Decimal(p), day, day) for i, p in priced], PRODUCTS)


def purchases(spark, *bought):
    return spark.createDataFrame([(n, u, p, ts(at), None, ts(back), None) for n, u, p, at, back in bought], PURCHASES)


def gold_rows(spark, u, p, q):
    table = gold.gold_user_purchases(marts.dim_users(u, q, p), marts.fct_purchases(q, p))
    return {r.user_id: r for r in table.collect()}


def model(ref):
    return gold.gold_user_purchases(ref["dim_users"], ref["fct_purchases"])


@pytest.mark.parametrize("test", UNIT_TESTS["gold_user_purchases"], ids=lambda t: t.name)
def test_declared_unit_tests(spark, test):
    assert differences(spark, test, model) == []


def test_a_broken_expectation_stops_the_build(spark):
    good = UNIT_TESTS["gold_user_purchases"][0]
    wrong = UnitTest("wrong", good.given, [{"user_id": 1, "return_rate_pct": "31.0"}])
    found = run(spark, [good, wrong], model)
    assert found[good.name] == []
    with pytest.raises(UnitTestFailed, match="wrong"):
        require(found)


def test_a_row_too_many_breaks_a_unit_test(spark):
    test = UNIT_TESTS["gold_user_purchases"][0]
    twice = lambda ref: model(ref).union(model(ref))
    assert len(differences(spark, test, twice)) == 1


def test_total_spent_aggregation(spark):
    q = purchases(spark, (1, 1, 10, "2024-01-01", None), (2, 1, 11, "2024-01-02", None), (3, 1, 10, "2024-01-03", None))
    row = gold_rows(spark, users(spark, 1), products(spark, (10, "10.10"), (11, "5.05")), q)[1]
    assert row.total_spent == Decimal("25.25")


def test_total_purchases_count(spark):
    q = purchases(spark, (1, 1, 10, "2024-01-01", None), (2, 1, 10, "2024-01-02", "2024-01-05"), (3, 2, 10, "2024-01-03", None))
    found = gold_rows(spark, users(spark, 1, 2), products(spark, (10, "1.00")), q)
    assert (found[1].total_purchases, found[1].total_returns, found[2].total_purchases) == (2, 1, 1)


def test_undated_purchase_is_the_latest_but_not_the_last_date(spark):
    q = purchases(spark, (1, 1, 10, "2024-06-01", None), (2, 1, 11, None, None))
    row = gold_rows(spark, users(spark, 1), products(spark, (10, "1.00"), (11, "2.00")), q)[1]
    assert row.last_purchased_product == "Make11 Model11"
    assert row.last_purchase_at == ts("2024-06-01 00:00:00")


def test_equal_dates_go_to_the_higher_purchase_id(spark):
    q = purchases(spark, (5, 1, 10, "2024-06-01", None), (7, 1, 11, "2024-06-01", None), (6, 1, 10, "2024-06-01", None))
    row = gold_rows(spark, users(spark, 1), products(spark, (10, "1.00"), (11, "2.00")), q)[1]
    assert row.last_purchased_price == Decimal("2.00")


def test_unknown_product_counts_but_costs_nothing(spark):
    q = purchases(spark, (1, 1, 99, "2024-06-01", None))
    row = gold_rows(spark, users(spark, 1), products(spark, (10, "1.00")), q)[1]
    assert (row.total_purchases, row.total_spent, row.avg_purchase_value) == (1, Decimal("0.00"), Decimal("0.00"))
    assert row.last_purchased_product is None and row.last_purchased_price is None


def test_users_without_purchases_are_in_the_dimension_only(spark):
    u, p = users(spark, 1, 2), products(spark, (10, "1.00"))
    q = purchases(spark, (1, 1, 10, "2024-06-01", None), (2, 42, 10, "2024-06-01", None))
    dim = {r.user_id: r for r in marts.dim_users(u, q, p).collect()}
    assert set(dim) == {1, 2} and dim[2].total_purchases == 0 and dim[2].total_spent == Decimal("0.00")
    assert dim[2].first_purchase_at is None
    assert set(gold_rows(spark, u, p, q)) == {1}
    assert {r.user_id for r in marts.fct_purchases(q, p).collect()} == {1, 42}


@pytest.mark.parametrize(
    "spent,count,returns,avg,rate",
    [("250.00", 3, 1, "83.33", "33.3"), ("0.05", 2, 1, "0.03", "50.0"), ("100.00", 8, 1, "12.50", "12.5"), ("0.01", 400, 1, "0.00", "0.3")],
)
def test_rounding_is_half_away_from_zero(spark, spent, count, returns, avg, rate):
    test = UnitTest(
        "rounding",
        {
            "dim_users": (CONTRACTS["dim_users"], [{"user_id": 1, "total_purchases": count, "total_spent": spent, "total_returns": returns}]),
            "fct_purchases": (CONTRACTS["fct_purchases"], []),
        },
        [{"user_id": 1, "avg_purchase_value": avg, "return_rate_pct": rate}],
    )
    assert differences(spark, test, model) == []


def test_measures_add_up(spark):
    u, p = users(spark, 1, 2, 3), products(spark, (10, "3.00"), (11, "4.00"), (12, "5.00"))
    q = purchases(spark, *[(i, i % 4, 9 + i % 5, "2024-06-01", None) for i in range(100)])
    direct, from_fact = marts.dim_users(u, q, p), marts.dim_users_from_fact(u, marts.fct_purchases(q, p))
    assert sorted(map(str, direct.collect())) == sorted(map(str, from_fact.collect()))
    known_products, known_users = {10, 11, 12}, {1, 2, 3}
    bought = q.collect()
    sold = marts.dim_products(p, q).agg(F.sum("times_sold")).first()[0]
    per_user = marts.dim_users(u, q, p).agg(F.sum("total_purchases")).first()[0]
    assert sold == sum(r.product_id in known_products for r in bought)
    assert per_user == sum(r.user_id in known_users for r in bought)
    assert marts.fct_purchases(q, p).count() == len(bought)
