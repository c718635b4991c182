"""Contracts and checks declared for the models, and who consumes them."""

from __future__ import annotations

from stratalake.operators.checks import (
    Check,
    accepted_values,
    expression_is_true,
    not_null,
    relationships,
    unique,
)
from stratalake.operators.unit_tests import UnitTest

# Columns and types of the contracted models.
CONTRACTS: dict[str, list[tuple[str, str]]] = {
    "dim_users": [
        ("user_id", "bigint"),
        ("full_name", "string"),
        ("email", "string"),
        ("occupation", "string"),
        ("city", "string"),
        ("state", "string"),
        ("country_code", "string"),
        ("age", "int"),
        ("created_at", "timestamp"),
        ("total_purchases", "bigint"),
        ("total_spent", "decimal(12,2)"),
        ("total_returns", "bigint"),
        ("first_purchase_at", "timestamp"),
        ("last_purchase_at", "timestamp"),
    ],
    "dim_products": [
        ("product_id", "bigint"),
        ("make", "string"),
        ("model", "string"),
        ("year", "int"),
        ("price", "decimal(12,2)"),
        ("created_at", "timestamp"),
        ("loaded_at", "timestamp"),
        ("times_sold", "bigint"),
        ("times_returned", "bigint"),
    ],
    "fct_purchases": [
        ("purchase_id", "bigint"),
        ("user_id", "bigint"),
        ("product_id", "bigint"),
        ("product_make", "string"),
        ("product_model", "string"),
        ("product_price", "decimal(10,2)"),
        ("purchased_at", "timestamp"),
        ("added_to_cart_at", "timestamp"),
        ("returned_at", "timestamp"),
        ("is_returned", "boolean"),
        ("loaded_at", "timestamp"),
    ],
    "gold_user_purchases": [
        ("user_id", "bigint"),
        ("full_name", "string"),
        ("email", "string"),
        ("occupation", "string"),
        ("city", "string"),
        ("state", "string"),
        ("country_code", "string"),
        ("age", "int"),
        ("total_purchases", "bigint"),
        ("total_spent", "decimal(12,2)"),
        ("total_returns", "bigint"),
        ("avg_purchase_value", "decimal(12,2)"),
        ("return_rate_pct", "decimal(5,1)"),
        ("last_purchased_product", "string"),
        ("last_purchased_price", "decimal(12,2)"),
        ("first_purchase_at", "timestamp"),
        ("last_purchase_at", "timestamp"),
        ("user_created_at", "timestamp"),
        ("refreshed_at", "timestamp"),
    ],
}

# The checks declared per table.
CHECKS: dict[str, list[Check]] = {
    "raw_users": [not_null("data")],
    "raw_products": [not_null("data")],
    "raw_purchases": [not_null("data")],
    "stg_users": [
        unique("user_id"),
        not_null("user_id"),
        unique("email"),
        not_null("email"),
        not_null("full_name"),
        not_null("age"),
        accepted_values("gender", ["Male", "Female", "Fluid", "Other"]),
    ],
    "stg_products": [
        unique("product_id"),
        not_null("product_id"),
        not_null("make"),
        not_null("model"),
        not_null("price"),
    ],
    "stg_purchases": [
        unique("purchase_id"),
        not_null("purchase_id"),
        not_null("user_id"),
        relationships("user_id", "stg_users", "user_id"),
        not_null("product_id"),
        relationships("product_id", "stg_products", "product_id"),
    ],
    "dim_users": [
        unique("user_id"),
        not_null("user_id"),
        relationships("user_id", "stg_users", "user_id"),
        not_null("full_name"),
        unique("email"),
        not_null("email"),
        not_null("total_purchases"),
        expression_is_true("total_purchases", ">= 0"),
        not_null("total_spent"),
    ],
    "dim_products": [
        unique("product_id"),
        not_null("product_id"),
        relationships("product_id", "stg_products", "product_id"),
        not_null("make"),
        not_null("model"),
        not_null("price"),
        expression_is_true("price", "> 0"),
        expression_is_true("times_sold", ">= 0"),
    ],
    "fct_purchases": [
        unique("purchase_id"),
        not_null("purchase_id"),
        not_null("user_id"),
        relationships("user_id", "stg_users", "user_id"),
        not_null("product_id"),
        relationships("product_id", "stg_products", "product_id"),
    ],
    "gold_user_purchases": [
        unique("user_id"),
        not_null("user_id"),
        relationships("user_id", "dim_users", "user_id"),
        not_null("full_name"),
        unique("email"),
        not_null("email"),
        not_null("total_purchases"),
        not_null("total_spent"),
        not_null("avg_purchase_value"),
        not_null("return_rate_pct"),
    ],
}



def _gold_test(name: str, user: dict, purchases: list[dict], expect: dict) -> UnitTest:
    return UnitTest(
        name,
        {
            "dim_users": (CONTRACTS["dim_users"], [{"user_id": 1, **user}]),
            "fct_purchases": (CONTRACTS["fct_purchases"], [{"user_id": 1, **p} for p in purchases]),
        },
        [{"user_id": 1, **expect}],
    )


# Given and expected values of the gold model's unit tests.
UNIT_TESTS: dict[str, list[UnitTest]] = {
    "gold_user_purchases": [
        _gold_test(
            "return_rate_calculation",
            {"total_purchases": 10, "total_spent": "500.00", "total_returns": 3},
            [{"purchase_id": 1, "product_make": "TestMake", "product_model": "TestModel", "product_price": "50.00", "purchased_at": "2024-06-01"}],
            {"return_rate_pct": "30.0"},
        ),
        _gold_test(
            "avg_purchase_value",
            {"total_purchases": 3, "total_spent": "250.00", "total_returns": 0},
            [{"purchase_id": 1, "product_make": "TestMake", "product_model": "TestModel", "product_price": "83.33", "purchased_at": "2024-06-01"}],
            {"avg_purchase_value": "83.33"},
        ),
        _gold_test(
            "user_with_no_returns",
            {"total_purchases": 5, "total_spent": "200.00", "total_returns": 0},
            [{"purchase_id": 1, "product_make": "TestMake", "product_model": "TestModel", "product_price": "40.00", "purchased_at": "2024-05-01"}],
            {"return_rate_pct": "0.0"},
        ),
        _gold_test(
            "last_purchased_product",
            {"total_purchases": 2, "total_spent": "300.00", "total_returns": 0},
            [
                {"purchase_id": 1, "product_make": "OldMake", "product_model": "OldModel", "product_price": "100.00", "purchased_at": "2024-01-15"},
                {"purchase_id": 2, "product_make": "NewMake", "product_model": "NewModel", "product_price": "200.00", "purchased_at": "2024-06-01"},
            ],
            {"last_purchased_product": "NewMake NewModel", "last_purchased_price": "200.00"},
        ),
    ],
}

# The layer of each table.
LAYERS: dict[str, str] = {
    "raw_users": "raw",
    "raw_products": "raw",
    "raw_purchases": "raw",
    "stg_users": "staging",
    "stg_products": "staging",
    "stg_purchases": "staging",
    "dim_users": "marts",
    "dim_products": "marts",
    "fct_purchases": "marts",
    "gold_user_purchases": "gold",
}

# Contracted models are versioned; staging and raw tables are not.
VERSIONS: dict[str, int] = {name: 1 for name in CONTRACTS}

# The version that a model's bare name stands for.
LATEST: dict[str, int] = {name: 1 for name in CONTRACTS}

# Model to the models it is computed from.
UPSTREAM: dict[str, list[str]] = {
    "stg_users": ["raw_users"],
    "stg_products": ["raw_products"],
    "stg_purchases": ["raw_purchases"],
    "dim_products": ["stg_products", "stg_purchases"],
    "fct_purchases": ["stg_purchases", "stg_products"],
    "dim_users": ["stg_users", "fct_purchases"],
    "gold_user_purchases": ["dim_users", "fct_purchases"],
}

# Declared consumers as (consumer, kind, model, version); without a version, the latest.
EXPOSURES: list[tuple[str, str, str, int | None]] = [
    ("executive_kpi_dashboard", "dashboard", "gold_user_purchases", 1),
    ("product_performance_report", "analysis", "dim_products", 1),
    ("product_performance_report", "analysis", "gold_user_purchases", 1),
    ("customer_segmentation_model", "ml", "gold_user_purchases", 1),
    ("customer_segmentation_model", "ml", "dim_users", 1),
    ("metabase_user_purchases", "dashboard", "gold_user_purchases", None),
]
