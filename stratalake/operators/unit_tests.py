"""Unit tests of models: given rows in, expected columns out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators.contracts import Contract, declared_schema
from stratalake.sources.small import small_table


class UnitTestFailed(AssertionError):
    """A model's rows differ from what its unit test expects."""


@dataclass(frozen=True)
class UnitTest:
    """``given`` maps an input to its columns and rows; only expected columns are compared."""

    name: str
    given: Mapping[str, tuple[Contract, Sequence[Mapping]]]
    expect: Sequence[Mapping]


def given_rows(spark: SparkSession, contract: Contract, rows: Sequence[Mapping]) -> DataFrame:
    """Rows under the input's columns; values are written as text, absent ones are NULL."""
    schema = declared_schema(contract)
    text = ", ".join(f"`{f.name}` string" for f in schema)
    values = [tuple(None if r.get(f.name) is None else str(r[f.name]) for f in schema) for r in rows]
    casts = [f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    return small_table(spark, values, text).selectExpr(*casts)


def differences(spark: SparkSession, test: UnitTest, model: Callable[[Mapping[str, DataFrame]], DataFrame]) -> list:
    """Rows, counting repeats, that the model gives but the test does not expect, and the other way round."""
    inputs = {name: given_rows(spark, contract, rows) for name, (contract, rows) in test.given.items()}
    columns = list(test.expect[0])
    actual = model(inputs).select(*columns)
    contract = [(f.name, f.dataType.simpleString()) for f in actual.schema]
    expected = given_rows(spark, contract, test.expect)
    apart = actual.exceptAll(expected).unionByName(expected.exceptAll(actual))
    return sorted(str(tuple(r)) for r in apart.collect())


def run(
    spark: SparkSession, tests: Sequence[UnitTest], model: Callable[[Mapping[str, DataFrame]], DataFrame]
) -> dict[str, list]:
    """The differences of each test by its name; the tests run side by side."""
    if not tests:
        return {}
    with ThreadPoolExecutor(max_workers=len(tests)) as pool:
        return dict(pool.map(lambda test: (test.name, differences(spark, test, model)), tests))


def require(results: Mapping[str, list]) -> None:
    """Raise :class:`UnitTestFailed` when the model breaks any of the tests."""
    broken = {name: rows for name, rows in results.items() if rows}
    if broken:
        raise UnitTestFailed(str(broken))
