"""Data-quality checks.

All checks of a table become one DataFrame with a row per check, from two passes over the
table: one aggregate for the row count and all row-level checks, and one shuffle of the
values, with counts, of every column whose values are compared: unique ones, foreign keys
and those with accepted values. In a large table each of these columns has a pass and a shuffle
of its own: a pass reads one column, its values need no number beside them, and only foreign
keys meet the parents. A value that holds a third of the rows is one partial-aggregate row per
task by the time it is shuffled.

NULL conventions: NULLs break only ``not_null``. ``unique`` counts repeated values,
``accepted_values`` offending values, all others offending rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from stratalake.functions import literal
from stratalake.session import estimated_bytes

#: Bytes (of rows, by the optimizer) up to which all compared columns share a pass.
SHARED_PASS = 128 << 20

RESULT = (
    "check_name string, schema_name string, table_name string, column_name string, "
    "test_type string, severity string, failures bigint, status string"
)


@dataclass(frozen=True)
class Check:
    """One declared check; ``severity`` and the thresholds decide its status."""

    test_type: str
    column: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""
    expression: str = ""
    severity: str = "error"
    warn_above: int = 0
    error_above: int = 0

    def name(self, table: str) -> str:
        """Unique among a table's checks: arguments and options other than the defaults add their hash."""
        arguments = [*map(str, self.values), self.parent, self.parent_column, self.expression]
        options = (self.severity, self.warn_above, self.error_above)
        if options != ("error", 0, 0):
            arguments += map(str, options)
        text = "|".join(a for a in arguments if a)
        suffix = f"_{hashlib.md5(text.encode()).hexdigest()[:8]}" if text else ""
        return f"{self.test_type}_{table}_{self.column}{suffix}"


def not_null(column: str, **options) -> Check:
    return Check("not_null", column, **options)


def unique(column: str, **options) -> Check:
    return Check("unique", column, **options)


def accepted_values(column: str, values: Sequence, **options) -> Check:
    return Check("accepted_values", column, values=tuple(values), **options)


def relationships(column: str, parent: str, parent_column: str, **options) -> Check:
    return Check("relationships", column, parent=parent, parent_column=parent_column, **options)


def expression_is_true(column: str, condition: str, **options) -> Check:
    """``condition`` continues the column name, as in ``">= 0"``."""
    return Check("expression_is_true", column, expression=f"{column} {condition}", **options)


def between(column: str, low, high, **options) -> Check:
    return Check("between", column, values=(low, high), **options)


def matches(column: str, pattern: str, **options) -> Check:
    return Check("matches", column, expression=pattern, **options)


def not_null_proportion(column: str, at_least: float, **options) -> Check:
    """Fails with the number of NULL rows when fewer than ``at_least`` are filled."""
    return Check("not_null_proportion", column, values=(at_least,), **options)


def violation(check: Check) -> Column:
    """True on the rows a row-level check rejects."""
    column = F.col(check.column)
    if check.test_type in ("not_null", "not_null_proportion"):
        return column.isNull()
    if check.test_type == "expression_is_true":
        return ~F.expr(check.expression)
    if check.test_type == "accepted_values":
        return ~column.isin(*check.values)
    if check.test_type == "between":
        low, high = check.values
        return ~column.between(low, high)
    if check.test_type == "matches":
        return ~column.rlike(check.expression)
    raise ValueError(f"{check.test_type} is not a row-level check")


ROW_LEVEL = ("not_null", "expression_is_true", "between", "matches", "not_null_proportion")


# The row count travels as a check of this number.
TOTAL = -1


def _row_level_counts(rows: DataFrame, checks: Sequence[tuple[int, Check]], with_total: bool) -> DataFrame:
    total = F.count("*")

    def failures(check: Check) -> Column:
        bad = F.count_if(violation(check))
        if check.test_type == "not_null_proportion":
            enough = (total - bad) >= F.lit(check.values[0]) * total
            return F.when(enough, F.lit(0).cast("bigint")).otherwise(bad)
        return bad

    counts = [(i, failures(check)) for i, check in checks]
    return _rows_from_columns(rows, counts + [(TOTAL, total)] * with_total)


def _rows_from_columns(rows: DataFrame, counts: Sequence[tuple[int, Column]]) -> DataFrame:
    """One aggregate over ``rows`` with a row for each of its numbered columns."""
    row = rows.agg(*[column.alias(f"c{k}") for k, (_, column) in enumerate(counts)])
    pairs = ", ".join(f"named_struct('no', {i}, 'failures', c{k})" for k, (i, _) in enumerate(counts))
    return row.selectExpr(f"inline(array({pairs}))")


def _value_counts(
    rows: DataFrame, checks: Sequence[tuple[int, Check]], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """Checks that compare values: each column's values are counted in their own type, in one shuffle.

    A value travels in the slot of its type beside the number of its check. Keys of the
    parents, distinct, meet the counted values, so the join never sees a value twice.
    """
    kind = {i: rows.schema[c.column].dataType.simpleString() for i, c in checks}
    slots = {t: f"v{k}" for k, t in enumerate(dict.fromkeys(kind.values()))}

    def entry(i: int, value: Column) -> list[Column]:
        placed = {s: value if t == kind[i] else F.lit(None).cast(t) for t, s in slots.items()}
        return [F.lit(i).alias("no"), *[v.alias(s) for s, v in placed.items()]]

    order = ["no", *slots.values()]
    entries = [F.struct(*entry(i, F.col(c.column))) for i, c in checks]
    values = rows.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    counted = (
        values.where(reduce(Column.__or__, [F.col(s).isNotNull() for s in slots.values()]))
        .groupBy(*order)
        .agg(F.count("*").alias("n"))
    )
    relations = [(i, c) for i, c in checks if c.test_type == "relationships"]
    if relations:
        keys = [
            parents[c.parent].select(*entry(i, F.col(c.parent_column).try_cast(kind[i]))) for i, c in relations
        ]
        known = reduce(DataFrame.union, keys).distinct().select(*[F.col(c).alias(f"p_{c}") for c in order])
        same = [F.col("no") == F.col("p_no"), *[F.col(s).eqNullSafe(F.col(f"p_{s}")) for s in slots.values()]]
        counted = counted.join(known, same, "left")

    def failures(i: int, check: Check) -> Column:
        own = F.col("no") == i
        if check.test_type == "unique":
            return F.count_if(own & (F.col("n") > 1))
        if check.test_type == "accepted_values":
            return F.count_if(own & ~F.col(slots[kind[i]]).isin(*check.values))
        return F.coalesce(F.sum(F.when(own & F.col("p_no").isNull(), F.col("n"))), F.lit(0).cast("bigint"))

    return _rows_from_columns(counted, [(i, failures(i, c)) for i, c in checks])


def _column_counts(
    rows: DataFrame, column: str, checks: Sequence[tuple[int, Check]], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """The checks of :func:`_value_counts` that look at one column, with a pass and a shuffle for it alone.

    Nothing but foreign keys meets a parent, and each check meets the distinct keys of its own.
    """
    kind = rows.schema[column].dataType.simpleString()
    counted = (
        rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    )
    for i, check in checks:
        if check.test_type == "relationships":
            keys = parents[check.parent].select(F.col(check.parent_column).try_cast(kind).alias(f"p{i}"))
            known = keys.where(F.col(f"p{i}").isNotNull()).distinct()
            counted = counted.join(known, F.col("value") == F.col(f"p{i}"), "left")

    def failures(i: int, check: Check) -> Column:
        if check.test_type == "unique":
            return F.count_if(F.col("n") > 1)
        if check.test_type == "accepted_values":
            return F.count_if(~F.col("value").isin(*check.values))
        return F.coalesce(F.sum(F.when(F.col(f"p{i}").isNull(), F.col("n"))), F.lit(0).cast("bigint"))

    return _rows_from_columns(counted, [(i, failures(i, c)) for i, c in checks])


def orphans(rows: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without a parent and the number of rows carrying each.

    Rows are counted per value before the anti join, so the join sees distinct values.
    """
    keys = parent.select(F.col(parent_column).alias("parent_key"))
    per_value = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return per_value.join(keys, F.col("value") == F.col("parent_key"), "left_anti")


def failure_counts(
    rows: DataFrame,
    checks: Sequence[Check],
    parents: Mapping[str, DataFrame],
    with_total: bool = False,
    shared_pass: int = SHARED_PASS,
) -> DataFrame:
    """``(no, failures)`` with one row per check, ``no`` being its position; ``TOTAL`` for the row count.

    Beyond ``shared_pass`` bytes of rows every compared column has a pass of its own.
    """
    numbered = list(enumerate(checks))
    row_level = [(i, c) for i, c in numbered if c.test_type in ROW_LEVEL]
    by_value = [(i, c) for i, c in numbered if c.test_type not in ROW_LEVEL]
    parts = []
    if row_level or with_total:
        parts.append(_row_level_counts(rows, row_level, with_total))
    columns = dict.fromkeys(c.column for _, c in by_value)
    if columns and estimated_bytes(rows) > shared_pass:
        for column in columns:
            parts.append(_column_counts(rows, column, [(i, c) for i, c in by_value if c.column == column], parents))
    elif by_value:
        parts.append(_value_counts(rows, by_value, parents))
    return reduce(DataFrame.unionByName, parts)


def run_checks(
    rows: DataFrame,
    schema_name: str,
    table_name: str,
    checks: Sequence[Check],
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per check: what it looked at, how many failures, and the status.

    A check of severity ``warn`` never fails; otherwise more than ``error_above``
    failures fail and more than ``warn_above`` warn.
    """
    return _described(failure_counts(rows, checks, parents or {}), schema_name, table_name, checks)


def audit(
    rows: DataFrame,
    schema_name: str,
    table_name: str,
    checks: Sequence[Check],
    parents: Mapping[str, DataFrame] | None = None,
) -> tuple[int, list[Row]]:
    """The row count and the results of :func:`run_checks`, computed side by side."""
    counts = failure_counts(rows, checks, parents or {}, with_total=True)
    found = _described(counts, schema_name, table_name, checks).collect()
    total = next(r.failures for r in found if r.check_name is None)
    return total, [r for r in found if r.check_name is not None]


def _described(counts: DataFrame, schema_name: str, table_name: str, checks: Sequence[Check]) -> DataFrame:
    # One SQL literal instead of a Column object per field: building those would take
    # longer than checking a small table.
    declared = ", ".join(
        f"named_struct('check_name', {literal(c.name(table_name))}, 'schema_name', {literal(schema_name)}, "
        f"'table_name', {literal(table_name)}, 'column_name', {literal(c.column)}, "
        f"'test_type', {literal(c.test_type)}, 'severity', {literal(c.severity)}, "
        f"'warn_above', {c.warn_above}L, 'error_above', {c.error_above}L)"
        for c in [*checks, Check("", "")]  # one more, so that the array always has its type
    )
    described = counts.selectExpr(f"get(array({declared}), no) AS check", "failures").select("check.*", "failures")
    status = F.expr(
        "CASE WHEN severity = 'error' AND failures > error_above THEN 'fail' "
        "WHEN failures > warn_above THEN 'warn' ELSE 'pass' END"
    )
    return described.select(*_RESULT_COLUMNS, status.alias("status"))


_RESULT_COLUMNS = (
    "check_name",
    "schema_name",
    "table_name",
    "column_name",
    "test_type",
    "severity",
    "failures",
)


def failing_rows(rows: DataFrame, check: Check, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows a check rejects, whole, to be stored next to the result."""
    if check.test_type == "unique":
        repeated = rows.where(F.col(check.column).isNotNull()).groupBy(check.column).count().where("count > 1")
        return rows.join(repeated.select(check.column), check.column, "left_semi")
    if check.test_type == "relationships":
        parent = (parents or {})[check.parent]
        missing = orphans(rows, check.column, parent, check.parent_column).select("value")
        return rows.join(missing, F.col(check.column) == F.col("value"), "left_semi")
    return rows.where(violation(check))


def freshness(
    sources: Mapping[str, DataFrame],
    loaded_at: str,
    as_of: Column | None = None,
    warn_after_hours: int = 12,
    error_after_hours: int = 24,
) -> DataFrame:
    """Age of each source's newest row and its status; an empty source is an error."""
    now = F.current_timestamp() if as_of is None else as_of
    rows = [
        source.agg(F.max(loaded_at).alias("max_loaded_at")).select(
            F.lit(name).alias("source_name"), "max_loaded_at"
        )
        for name, source in sources.items()
    ]
    age = F.unix_timestamp(now) - F.unix_timestamp("max_loaded_at")
    status = (
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(F.col("age_seconds") > error_after_hours * 3600, "error")
        .when(F.col("age_seconds") > warn_after_hours * 3600, "warn")
        .otherwise("pass")
    )
    return reduce(DataFrame.unionByName, rows).withColumn("age_seconds", age).withColumn("status", status)


class StaleSource(RuntimeError):
    """Sources are older than their error threshold; ``names`` lists them."""

    def __init__(self, rows: Sequence[Row]):
        super().__init__(", ".join(f"{r.source_name} ({r.age_seconds} s)" for r in rows))
        self.names = [r.source_name for r in rows]


def require_fresh(report: DataFrame) -> list[Row]:
    """The rows of a :func:`freshness` report, or :class:`StaleSource` if one is an error."""
    rows = report.collect()
    stale = [r for r in rows if r.status == "error"]
    if stale:
        raise StaleSource(stale)
    return rows
