"""A deterministic generator of users, products and purchases.

Each record is a function of its id and the seed only (one MD5 per field), so any
partitioning, retry or parallelism gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import cents_to_money
from stratalake.sources.envelope import to_envelope

MAKES = ["Aster", "Borealis", "Cinder", "Dune", "Ember", "Fjord", "Gale", "Harbor"]
OCCUPATIONS = ["Engineer", "Teacher", "Nurse", "Designer", "Analyst"]
COUNTRIES = ["US", "CA", "GB", "DE", "JP", "BR"]
GENDERS = ["Male", "Female", "Fluid", "Other"]
TITLES = ["Mr.", "Ms.", "Dr."]
NATIONALITIES = ["American", "Canadian", "British", "German", "Japanese", "Brazilian"]
LANGUAGES = ["English", "German", "Japanese", "Portuguese"]
DEGREES = ["Bachelor", "Master", "PhD"]
BLOOD_TYPES = ["O+", "A+", "B+", "AB+", "O-", "A-", "B-", "AB-"]
STREETS = ["Birch Rd", "Canal St", "Hill Ave", "Lake Dr", "Mill Ln"]


def ids(spark: SparkSession, count: int, parallelism: int = 4, records_per_slice: int | None = None) -> DataFrame:
    """Ids ``0 .. count-1``; ``records_per_slice`` sets how many one task makes."""
    if records_per_slice:
        parallelism = max(1, -(-count // records_per_slice))
    return spark.range(0, count, 1, parallelism)


def _number(stream: str, seed: int, field: str, below: int) -> Column:
    """A number in ``[0, below)`` from 60 bits of an MD5 over the field's name and the record's id."""
    digest = F.md5(F.concat(F.lit(f"{stream}:{seed}:{field}:"), F.col("id").cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(below).cast("bigint"))


def _pick(stream: str, seed: int, field: str, choices: list[str]) -> Column:
    number = _number(stream, seed, field, len(choices))
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (number + 1).cast("int"))


def _time(stream: str, seed: int, field: str) -> Column:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), _number(stream, seed, field, 200 * 1440).cast("int"))


def users(ids: DataFrame, seed: int = 42) -> DataFrame:
    number = lambda field, below: _number("users", seed, field, below)
    pick = lambda field, choices: _pick("users", seed, field, choices)
    address = F.struct(
        F.concat(F.lit("City "), number("city", 100).cast("string")).alias("city"),
        F.concat(F.lit("State "), number("state", 10).cast("string")).alias("state"),
        pick("country", COUNTRIES).alias("country_code"),
        (F.lit(10000) + number("postal", 90000)).cast("string").alias("postal_code"),
        pick("street", STREETS).alias("street_name"),
        (F.lit(1) + number("house", 999)).cast("string").alias("street_number"),
    )
    created = _time("users", seed, "created")
    return ids.select(
        "id",
        F.concat(F.lit("User "), F.col("id").cast("string")).alias("name"),
        F.concat(F.lit("user"), F.col("id").cast("string"), F.lit("@example.com")).alias("email"),
        pick("gender", GENDERS).alias("gender"),
        pick("title", TITLES).alias("title"),
        pick("occupation", OCCUPATIONS).alias("occupation"),
        pick("nationality", NATIONALITIES).alias("nationality"),
        pick("language", LANGUAGES).alias("language"),
        pick("degree", DEGREES).alias("academic_degree"),
        (F.lit(18) + number("age", 60)).cast("int").alias("age"),
        pick("blood", BLOOD_TYPES).alias("blood_type"),
        address.alias("address"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def products(ids: DataFrame, seed: int = 42) -> DataFrame:
    number = lambda field, below: _number("products", seed, field, below)
    return ids.select(
        "id",
        _pick("products", seed, "make", MAKES).alias("make"),
        F.concat(F.lit("Model "), number("model", 500).cast("string")).alias("model"),
        (F.lit(2000) + number("year", 25)).cast("int").alias("year"),
        cents_to_money(number("price", 8000000) + 100000).alias("price"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )


def purchases(ids: DataFrame, n_users: int, n_products: int, seed: int = 42) -> DataFrame:
    """One purchase in ten is returned, ten days later."""
    number = lambda field, below: _number("purchases", seed, field, below)
    bought = _time("purchases", seed, "bought")
    ten_days = F.make_dt_interval(F.lit(10))
    return ids.select(
        "id",
        number("user", n_users).alias("user_id"),
        number("product", n_products).alias("product_id"),
        bought.alias("purchased_at"),
        (bought - F.make_dt_interval(F.lit(1))).alias("added_to_cart_at"),
        F.when(number("returned", 10) == 0, bought + ten_days).alias("returned_at"),
    )


def synthetic_raw(
    spark: SparkSession,
    count: int,
    seed: int = 42,
    parallelism: int = 4,
    records_per_slice: int | None = None,
    emitted_at: Column | None = None,
    n_products: int = 100,
) -> dict[str, DataFrame]:
    """Raw envelope streams for ``count`` users, ``count`` purchases and ``n_products`` products."""
    rows = lambda n: ids(spark, n, parallelism, records_per_slice)
    return {
        "raw_users": to_envelope(users(rows(count), seed), emitted_at),
        "raw_products": to_envelope(products(rows(n_products), seed), emitted_at),
        "raw_purchases": to_envelope(purchases(rows(count), count, n_products, seed), emitted_at),
    }
