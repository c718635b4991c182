"""Write, audit, publish: rows reach the public name only after their checks pass."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from stratalake.operators.checks import Check, audit, failing_rows
from stratalake.operators.contracts import Contract, enforce
from stratalake.sources.small import small_table
from stratalake.sources.warehouse import Warehouse

HISTORY_LAYER = "observability"

QUALITY_RESULTS = (
    "detected_at timestamp, invocation_id string, status string, schema_name string, "
    "table_name string, column_name string, test_name string, test_type string, "
    "severity string, failures bigint, test_results_description string, "
    "test_unique_id string, model_unique_id string"
)
RUN_RESULTS = (
    "invocation_id string, name string, resource_type string, materialization string, "
    "status string, execution_time double, rows_affected bigint, "
    "execute_started_at timestamp, execute_completed_at timestamp"
)
REPORT = (
    "table_name string, outcome string, row_count bigint, checks bigint, passed bigint, "
    "warned bigint, failed bigint"
)


class GateClosed(RuntimeError):
    """A check of severity ``error`` failed, so nothing was published."""

    def __init__(self, report: "PublishReport"):
        bad = ", ".join(f"{r.check_name} ({r.failures})" for r in report.results if r.status == "fail")
        super().__init__(f"{report.table_name} not published: {bad}")
        self.report = report


@dataclass
class PublishReport:
    """What happened to one table; ``results`` holds one row per check."""

    table_name: str
    outcome: str
    row_count: int
    results: list[Row] = field(default_factory=list)

    def as_row(self) -> tuple:
        by_status = [sum(r.status == s for r in self.results) for s in ("pass", "warn", "fail")]
        return (self.table_name, self.outcome, self.row_count, len(self.results), *by_status)


def _now() -> datetime:
    return datetime.now(timezone.utc)


class History:
    """Check and run results of one invocation, appended to the history tables by ``flush``."""

    def __init__(self, warehouse: Warehouse, invocation_id: str | None = None):
        self.warehouse = warehouse
        self.invocation_id = invocation_id or uuid.uuid4().hex
        self._results: list[tuple] = []
        self._runs: list[tuple] = []

    def add_results(self, results: Sequence[Row]) -> None:
        detected = _now()
        for r in results:
            self._results.append(
                (
                    detected,
                    self.invocation_id,
                    r.status,
                    r.schema_name,
                    r.table_name,
                    r.column_name,
                    r.check_name,
                    r.test_type,
                    r.severity,
                    r.failures,
                    f"{r.failures} failures",
                    r.check_name,
                    r.table_name,
                )
            )

    def add_run(
        self, name: str, status: str, started: datetime, rows: int | None, resource_type: str = "model"
    ) -> None:
        """What became of a model (success, error, skipped), a unit test, a contract or a source."""
        ended = _now()
        seconds = (ended - started).total_seconds()
        kind = "table" if resource_type == "model" else None
        self._runs.append((self.invocation_id, name, resource_type, kind, status, seconds, rows, started, ended))

    def flush(self) -> None:
        pending = (
            ("quality_results", self._results, QUALITY_RESULTS),
            ("run_results", self._runs, RUN_RESULTS),
        )
        for name, rows, schema in pending:
            if rows:
                history = small_table(self.warehouse.spark, rows, schema).coalesce(1)
                self.warehouse.append(history, HISTORY_LAYER, name)
                rows.clear()


def write_audit_publish(
    warehouse: Warehouse,
    rows: DataFrame,
    layer: str,
    name: str,
    version: int | None = None,
    contract: Contract | None = None,
    checks: Sequence[Check] = (),
    parents: Mapping[str, DataFrame] | Callable[[], Mapping[str, DataFrame]] | None = None,
    partition_by: Sequence[str] = (),
    history: History | None = None,
    store_failures: bool = False,
    latest_version: int | None = None,
) -> PublishReport:
    """Check the contract, write a hidden generation, check its rows, then publish it.

    The rows are computed once: the checks read the written generation, and publishing
    repoints the public name without moving data. On a failed check of severity ``error``
    the public name keeps its old rows and :class:`GateClosed` is raised. What comes back
    to the driver is one row per check. ``parents`` may be a function: it is called once
    the rows are written, when the tables they refer to may just have been published.
    Without a ``history`` the results are recorded at once as an invocation of their own.
    With ``store_failures`` each check's table in ``check_failures`` has what it rejected in this run.
    """
    own_history = history is None
    history = history or History(warehouse)
    started = _now()
    status, row_count = "error", None
    try:
        if contract is not None:
            held = "fail"
            try:
                rows, held = enforce(rows, contract), "pass"
            finally:
                history.add_run(f"contract_{name}", held, started, None, "contract")
        generation = warehouse.write_generation(rows, layer, name, version, partition_by)
        written = warehouse.spark.table(generation)
        parents = parents() if callable(parents) else parents
        row_count, results = audit(written, layer, name, checks, parents)
        history.add_results(results)
        if store_failures:
            _store_failures(warehouse, written, layer, name, checks, parents, results, history.invocation_id)
        if any(r.status == "fail" for r in results):
            raise GateClosed(PublishReport(name, "blocked", row_count, results))
        warehouse.publish(generation, layer, name, version, latest_version)
        status = "success"
    finally:
        history.add_run(name, status, started, row_count)
        if own_history:
            history.flush()
    return PublishReport(name, "published", row_count, results)


def failures_table(layer: str, name: str, check: Check) -> str:
    """Where a check of a table keeps the rows it rejects, in the layer ``check_failures``."""
    return f"{layer}_{check.name(name)}"


def _store_failures(
    warehouse: Warehouse,
    written: DataFrame,
    layer: str,
    name: str,
    checks: Sequence[Check],
    parents: Mapping[str, DataFrame] | None,
    results: Sequence[Row],
    invocation_id: str,
) -> None:
    """Keep the rows that each check rejects in this run; a check that passes has none, also where it had some."""
    by_name = {r.check_name: r for r in results}
    for check in checks:
        rejected = failing_rows(written, check, parents) if by_name[check.name(name)].failures else written.limit(0)
        stamped = rejected.withColumn("failed_check", F.lit(check.name(name)))
        warehouse.overwrite(
            stamped.withColumn("invocation_id", F.lit(invocation_id)), "check_failures", failures_table(layer, name, check)
        )
