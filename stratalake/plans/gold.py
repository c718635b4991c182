"""Gold: one row per user with purchases, ready for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import half_up_ratio, percent_of
from stratalake.operators.dedup import latest_per_key
from stratalake.plans.marts import MONEY


def user_last_purchase(fct: DataFrame) -> DataFrame:
    """Product and price of each user's newest purchase.

    An undated purchase counts as the newest; equal dates go to the higher purchase id.
    The label is NULL when the product is unknown.
    """
    newest_first = [F.col("purchased_at").desc_nulls_first(), F.col("purchase_id").desc()]
    columns = ["user_id", "purchase_id", "purchased_at", "product_make", "product_model", "product_price"]
    return latest_per_key(fct.select(*columns), ["user_id"], newest_first).select(
        "user_id",
        F.concat("product_make", F.lit(" "), "product_model").alias("last_product"),
        F.col("product_price").alias("last_product_price"),
    )


def gold_user_purchases(dim_users: DataFrame, fct: DataFrame, as_of: Column | None = None) -> DataFrame:
    buyers = dim_users.where(F.col("total_purchases") > 0)
    spent, bought = F.col("total_spent"), F.col("total_purchases")
    refreshed = F.current_timestamp() if as_of is None else as_of
    return buyers.join(user_last_purchase(fct), "user_id", "left").select(
        "user_id",
        "full_name",
        "email",
        "occupation",
        "city",
        "state",
        "country_code",
        "age",
        "total_purchases",
        "total_spent",
        "total_returns",
        half_up_ratio(spent, bought, 2).cast(MONEY).alias("avg_purchase_value"),
        percent_of(F.col("total_returns"), bought, 1).cast("decimal(5,1)").alias("return_rate_pct"),
        F.col("last_product").alias("last_purchased_product"),
        F.col("last_product_price").cast(MONEY).alias("last_purchased_price"),
        "first_purchase_at",
        "last_purchase_at",
        F.col("created_at").alias("user_created_at"),
        refreshed.alias("refreshed_at"),
    )
