"""Declared column contracts: names, type families and precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import literal, quoted
from stratalake.sources.small import small_table

Contract = Sequence[tuple[str, str]]  # (column, type)

DIFF = "column_name string, problem string, expected_type string, actual_type string, affected_rows bigint"


class ContractViolation(ValueError):
    """The rows do not have the declared columns and types."""


def declared_schema(contract: Contract) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{quoted(name)} {dtype}" for name, dtype in contract))


def _family(dtype: T.DataType) -> str:
    # Decimals of any precision are one family; the cast settles precision and overflow.
    return "decimal" if isinstance(dtype, T.DecimalType) else dtype.simpleString()


def contract_problems(schema: T.StructType, contract: Contract) -> list[tuple[str, str, str | None, str | None]]:
    """(column, missing|unexpected|type_mismatch, expected type, actual type) per problem."""
    declared = {f.name: f.dataType for f in declared_schema(contract)}
    actual = {f.name: f.dataType for f in schema}
    problems = []
    for name, dtype in declared.items():
        if name not in actual:
            problems.append((name, "missing", dtype.simpleString(), None))
        elif _family(actual[name]) != _family(dtype):
            problems.append((name, "type_mismatch", dtype.simpleString(), actual[name].simpleString()))
    for name, dtype in actual.items():
        if name not in declared:
            problems.append((name, "unexpected", None, dtype.simpleString()))
    return problems


def contract_diff(rows: DataFrame, contract: Contract) -> DataFrame:
    """The problems as rows, with how many rows each affects; empty when the contract holds.

    Wrong names and types affect every row. Where the type is right, one pass counts the
    values beyond the declared precision, which :func:`enforce` would raise on.
    """
    wrong = contract_problems(rows.schema, contract)
    named_wrong = {column for column, *_ in wrong}
    actual = {f.name: f.dataType.simpleString() for f in rows.schema}
    decimals = [f for f in declared_schema(contract) if f.name not in named_wrong and isinstance(f.dataType, T.DecimalType)]
    counts = [F.expr("count(*) AS total")] + [
        F.expr(
            f"count_if({quoted(f.name)} IS NOT NULL"
            f" AND try_cast({quoted(f.name)} AS {f.dataType.simpleString()}) IS NULL) AS over{i}"
        )
        for i, f in enumerate(decimals)
    ]
    problems = [(*problem, "total") for problem in wrong] + [
        (f.name, "overflow", f.dataType.simpleString(), actual[f.name], f"over{i}") for i, f in enumerate(decimals)
    ]
    if not problems:
        return small_table(rows.sparkSession, [], DIFF)
    entries = ", ".join(
        f"named_struct('column_name', {literal(c)}, 'problem', {literal(p)}, 'expected_type', {literal(e)}, "
        f"'actual_type', {literal(a)}, 'affected_rows', {n})"
        for c, p, e, a, n in problems
    )
    return rows.agg(*counts).selectExpr(f"inline(array({entries}))").where("problem <> 'overflow' OR affected_rows > 0")


def enforce(rows: DataFrame, contract: Contract) -> DataFrame:
    """Rows in the declared column order and precision, or :class:`ContractViolation`.

    A value beyond its declared precision raises when the rows are computed.
    """
    problems = contract_problems(rows.schema, contract)
    if problems:
        raise ContractViolation("; ".join(f"{c}: {p} (expected {e}, got {a})" for c, p, e, a in problems))
    return rows.selectExpr(*[f"CAST({quoted(name)} AS {dtype}) AS {quoted(name)}" for name, dtype in contract])
