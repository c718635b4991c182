"""Marts: user and product dimensions and the purchase fact.

Purchases are aggregated before they meet a dimension, so the joins are one row per key
on both sides and a user or product with a third of all purchases costs no more than
any other: partial aggregation reduces it to one row per task before the shuffle. The
fact keeps every purchase; its product join is left to adaptive execution, which
broadcasts products only when their measured size allows and splits the partition of a
hot product otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import zero_if_null
from stratalake.operators.aggregate_state import ROWS, Measures

MONEY = "decimal(12,2)"


def dim_products(products: DataFrame, purchases: DataFrame) -> DataFrame:
    sales = purchases.groupBy("product_id").agg(
        F.count("*").alias("sold"), F.count("returned_at").alias("returned")
    )
    return products.join(sales, "product_id", "left").select(
        "product_id",
        "make",
        "model",
        "year",
        F.col("price").cast(MONEY).alias("price"),
        "created_at",
        "loaded_at",
        zero_if_null(F.col("sold")).alias("times_sold"),
        zero_if_null(F.col("returned")).alias("times_returned"),
    )


def user_activity(priced: DataFrame) -> DataFrame:
    """Per user: purchases, spend, returns, first and last purchase time.

    A purchase without a price (of an unknown product) counts but adds nothing to the spend.
    """
    return priced.groupBy("user_id").agg(
        F.count("*").alias("purchases"),
        F.sum("product_price").alias("spent"),
        F.count("returned_at").alias("returns"),
        F.min("purchased_at").alias("first_purchase_at"),
        F.max("purchased_at").alias("last_purchase_at"),
    )


def dim_users(users: DataFrame, purchases: DataFrame, products: DataFrame) -> DataFrame:
    prices = products.select("product_id", F.col("price").alias("product_price"))
    priced = purchases.select("user_id", "product_id", "purchased_at", "returned_at").join(prices, "product_id", "left")
    return dim_users_from_fact(users, priced)


def dim_users_from_fact(users: DataFrame, priced: DataFrame) -> DataFrame:
    """The user dimension when the purchase fact exists already.

    The fact carries each purchase's price, so purchases are not joined with products, and
    possibly shuffled for it, a second time.
    """
    return dim_users_from_activity(users, user_activity(priced))


#: What :func:`user_activity` computes, as aggregates that follow changes of the purchases.
ACTIVITY = Measures(
    counts=("returned_at",), sums=("product_price",), least=("purchased_at",), greatest=("purchased_at",)
)


def maintained_activity(aggregates: DataFrame) -> DataFrame:
    """The columns of :func:`user_activity` from maintained aggregates."""
    return aggregates.select(
        "user_id",
        F.col(ROWS).alias("purchases"),
        F.col("sum_product_price").alias("spent"),
        F.col("count_returned_at").alias("returns"),
        F.col("min_purchased_at").alias("first_purchase_at"),
        F.col("max_purchased_at").alias("last_purchase_at"),
    )


def dim_users_from_activity(users: DataFrame, activity: DataFrame) -> DataFrame:
    return users.join(activity, "user_id", "left").select(
        "user_id",
        "full_name",
        "email",
        "occupation",
        "city",
        "state",
        "country_code",
        "age",
        "created_at",
        zero_if_null(F.col("purchases")).alias("total_purchases"),
        zero_if_null(F.col("spent")).cast(MONEY).alias("total_spent"),
        zero_if_null(F.col("returns")).alias("total_returns"),
        "first_purchase_at",
        "last_purchase_at",
    )


def fct_purchases(purchases: DataFrame, products: DataFrame) -> DataFrame:
    catalog = products.select(
        "product_id",
        F.col("make").alias("product_make"),
        F.col("model").alias("product_model"),
        F.col("price").alias("product_price"),
    )
    return purchases.join(catalog, "product_id", "left").select(
        "purchase_id",
        "user_id",
        "product_id",
        "product_make",
        "product_model",
        "product_price",
        "purchased_at",
        "added_to_cart_at",
        "returned_at",
        F.col("returned_at").isNotNull().alias("is_returned"),
        "loaded_at",
    )
