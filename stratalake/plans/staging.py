"""Staging: one typed row per raw record; extraction and casts only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import json_texts

Field = tuple[str, str, str]  # column, path in the payload, type

# Column names, payload paths and types of the staging models.
USER_FIELDS: list[Field] = [
    ("user_id", "id", "bigint"),
    ("full_name", "name", "string"),
    ("email", "email", "string"),
    ("gender", "gender", "string"),
    ("title", "title", "string"),
    ("occupation", "occupation", "string"),
    ("nationality", "nationality", "string"),
    ("language", "language", "string"),
    ("academic_degree", "academic_degree", "string"),
    ("age", "age", "int"),
    ("blood_type", "blood_type", "string"),
    ("city", "address.city", "string"),
    ("state", "address.state", "string"),
    ("country_code", "address.country_code", "string"),
    ("postal_code", "address.postal_code", "string"),
    ("created_at", "created_at", "timestamp"),
    ("updated_at", "updated_at", "timestamp"),
]
PRODUCT_FIELDS: list[Field] = [
    ("product_id", "id", "bigint"),
    ("make", "make", "string"),
    ("model", "model", "string"),
    ("year", "year", "int"),
    ("price", "price", "decimal(10,2)"),
    ("created_at", "created_at", "timestamp"),
]
PURCHASE_FIELDS: list[Field] = [
    ("purchase_id", "id", "bigint"),
    ("user_id", "user_id", "bigint"),
    ("product_id", "product_id", "bigint"),
    ("purchased_at", "purchased_at", "timestamp"),
    ("added_to_cart_at", "added_to_cart_at", "timestamp"),
    ("returned_at", "returned_at", "timestamp"),
]


def _texts(raw: DataFrame, fields: Sequence[Field], document: Column) -> DataFrame:
    """``text``, a struct with each field's text, next to the raw columns."""
    parsed = raw.select("data", document.alias("doc"), F.col("emitted_at").alias("loaded_at"))
    return parsed.select("data", "doc", "loaded_at", json_texts("doc", [path for _, path, _ in fields]).alias("text"))


# What the strict reader takes is JSON as ``parse_json`` knows it.
_STRICT_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def stage(raw: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Typed columns of the payload plus ``loaded_at``; a bad payload or value raises.

    Where all fields are bigints and timestamps of the payload itself, a payload is read once by a
    strict reader; one that this does not take whole (a number given as a string, say) is read like all others.
    """
    if all("." not in path and dtype in ("bigint", "timestamp") for _, path, dtype in fields):
        return _stage_plain(raw, fields)
    return _texts(raw, fields, F.parse_json("data")).selectExpr(
        *[f"CAST(text.{path} AS {dtype}) AS `{name}`" for name, path, dtype in fields], "loaded_at"
    )


def _stage_plain(raw: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """:func:`stage` of bigints and timestamps at the top of the payload.

    The strict reader takes bigints from integers only, and times as text, of which a cast makes the
    value or nothing. So what it gives is what the text of the field gives, or the row is read as text.
    """
    schema = ", ".join(f"`{path}` {'bigint' if dtype == 'bigint' else 'string'}" for _, path, dtype in fields)
    read = raw.select(
        "data", F.col("emitted_at").alias("loaded_at"), F.from_json("data", f"{schema}, _bad string", _STRICT_JSON).alias("read")
    )
    times = [path for _, path, dtype in fields if dtype == "timestamp"]
    cast = read.selectExpr("*", *[f"try_cast(read.`{path}` AS timestamp) AS `time_{path}`" for path in times])
    taken = ["startswith(data, '{')", "read IS NOT NULL", "read._bad IS NULL"]
    taken += [f"(read.`{path}` IS NULL OR `time_{path}` IS NOT NULL)" for path in times]
    texts = json_texts(F.parse_json("data"), [path for _, path, _ in fields])
    either = cast.withColumn("taken", F.expr(f"coalesce({' AND '.join(taken)}, false)")).withColumn(
        "text", F.when(~F.col("taken"), texts)
    )
    values = [(name, path, dtype, f"`time_{path}`" if dtype == "timestamp" else f"read.`{path}`") for name, path, dtype in fields]
    return either.selectExpr(
        *[f"CASE WHEN taken THEN {value} ELSE CAST(text.`{path}` AS {dtype}) END AS `{name}`" for name, path, dtype, value in values],
        "loaded_at",
    )


def stage_with_errors(raw: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Like :func:`stage`, but bad values become NULL and are named in ``errors``.

    Rows with an empty ``errors`` array are what :func:`stage` would give; the others
    belong in quarantine together with their ``data``.
    """
    problems = ["CASE WHEN data IS NOT NULL AND doc IS NULL THEN 'data' END"]
    for name, path, dtype in fields:
        if dtype != "string":
            problems.append(f"CASE WHEN text.{path} IS NOT NULL AND try_cast(text.{path} AS {dtype}) IS NULL THEN '{name}' END")
    return _texts(raw, fields, F.try_parse_json("data")).selectExpr(
        *[f"try_cast(text.{path} AS {dtype}) AS `{name}`" for name, path, dtype in fields],
        "loaded_at",
        "data",
        f"array_compact(array({', '.join(problems)})) AS errors",
    )


def stg_users(raw_users: DataFrame) -> DataFrame:
    return stage(raw_users, USER_FIELDS)


def stg_products(raw_products: DataFrame) -> DataFrame:
    return stage(raw_products, PRODUCT_FIELDS)


def stg_purchases(raw_purchases: DataFrame) -> DataFrame:
    return stage(raw_purchases, PURCHASE_FIELDS)


def typed(records: DataFrame, fields: Sequence[Field], loaded_at: Column) -> DataFrame:
    """Staging rows from records that are typed already, without the JSON step."""
    columns = [F.expr(f"CAST({path} AS {dtype}) AS `{name}`") for name, path, dtype in fields]
    return records.select(*columns, loaded_at.alias("loaded_at"))
