"""Views over the check and run history, and the dashboard cards read from them.

The history grows with every run, so each view aggregates it before anything else; rows
of different shape meet only after that. A NULL status is neither passed nor failed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import percent_of

RUN_OK = ("success", "pass")
PERCENT = "decimal(5,1)"


def _counts(ok: Column) -> list[Column]:
    return [F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed")]


def _per_invocation(results: DataFrame) -> DataFrame:
    return results.groupBy(F.to_date("detected_at").alias("run_date"), "invocation_id").agg(
        F.count("*").alias("total_tests"),
        *_counts(F.col("status") == "pass"),
        F.max("detected_at").alias("last_detected_at"),
    )


@dataclass(frozen=True)
class Report:
    """A report over one history table: what its columns are, once for DataFrames and catalog views.

    ``keys`` are grouped by where there are ``measures`` or where it is ``distinct``, else just shown.
    """

    of: str
    keys: dict[str, str]
    measures: dict[str, str] = field(default_factory=dict)
    where: str = "true"
    distinct: bool = False

    def rows(self, table: DataFrame) -> DataFrame:
        columns, measures = ([F.expr(e).alias(c) for c, e in part.items()] for part in (self.keys, self.measures))
        found = table.where(self.where)
        if not measures:
            found = found.select(*columns)
            return found.distinct() if self.distinct else found
        return found.groupBy(*columns).agg(*measures)

    def sql(self, table: str) -> str:
        columns = ", ".join(f"{e} AS {c}" for c, e in {**self.keys, **self.measures}.items())
        grouped = " GROUP BY ALL" if self.measures else ""
        return f"SELECT {'DISTINCT ' * self.distinct}{columns} FROM {table} WHERE {self.where}{grouped}"


def _same(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


def _passed(ok: str) -> dict[str, str]:
    return {"passed": f"count_if({ok})", "failed": f"count_if(NOT ({ok}))"}


_IS_PASS = "status = 'pass'"
_DAY = {"run_date": "to_date(detected_at)"}

PASS_RATES = Report(
    "quality_results",
    {**_DAY, **_same("invocation_id")},
    {
        "total_tests": "count(*)",
        **_passed(_IS_PASS),
        "pass_rate_pct": f"CAST(round(CAST(count_if({_IS_PASS}) AS DECIMAL(20,0)) * 100 / CAST(count(*) AS DECIMAL(20,0)), 1)"
        f" AS {PERCENT})",
    },
)
BY_MODEL = Report(
    "quality_results",
    {"layer": "schema_name", "model": "table_name", **_same("test_type", "status"), **_DAY, **_same("invocation_id")},
    {"test_count": "count(*)"},
)
MODEL_TIMES = Report(
    "run_results",
    {
        "model_name": "name",
        **_same("materialization", "execution_time", "status", "rows_affected", "execute_started_at", "invocation_id"),
    },
    where="resource_type = 'model'",
)
INVOCATIONS = Report(
    "run_results",
    _same("invocation_id", "resource_type"),
    {
        "total": "count(*)",
        **_passed(f"status IN {RUN_OK}"),
        "avg_execution_time_s": "CAST(round(CAST(avg(execution_time) AS DECIMAL(18,6)), 2) AS DECIMAL(14,2))",
        "started_at": "min(execute_started_at)",
        "completed_at": "max(execute_completed_at)",
    },
)
FAILURES = Report(
    "quality_results",
    _same(
        "test_name",
        "table_name",
        "column_name",
        "test_type",
        "status",
        "severity",
        "failures",
        "test_results_description",
        "detected_at",
    ),
    where="status <> 'pass'",
)
#: What was ever tested, whose size depends on the declared tests and not on how often they ran.
TESTED = Report("quality_results", _same("model_unique_id", "test_unique_id", "column_name"), distinct=True)
#: Over models beside their ``TESTED`` rows; untested models count zero.
COVERAGE = Report(
    "models",
    {"model_name": "name", "layer": "schema_name"},
    {"test_count": "count(DISTINCT test_unique_id)", "columns_tested": "count(DISTINCT column_name)"},
)


def pass_rate_trend(results: DataFrame) -> DataFrame:
    return PASS_RATES.rows(results).orderBy(F.col("run_date").desc(), "invocation_id")


def results_by_model(results: DataFrame) -> DataFrame:
    return BY_MODEL.rows(results).orderBy("layer", "model", "run_date", "invocation_id", "test_type", "status")


def execution_times(runs: DataFrame) -> DataFrame:
    return MODEL_TIMES.rows(runs).orderBy(F.col("execute_started_at").desc(), "model_name", "invocation_id")


def invocation_history(runs: DataFrame) -> DataFrame:
    return INVOCATIONS.rows(runs).orderBy(F.col("started_at").desc(), "invocation_id", "resource_type")


def latest_failures(results: DataFrame) -> DataFrame:
    newest = [F.col("detected_at").desc_nulls_first(), F.col("test_name"), F.col("table_name"), F.col("column_name")]
    return FAILURES.rows(results).orderBy(*newest)


def test_coverage(models: DataFrame, results: DataFrame) -> DataFrame:
    """Distinct tests and tested columns per model; untested models count zero."""
    tested = TESTED.rows(results)
    beside = models.join(tested, models.unique_id == tested.model_unique_id, "left")
    return COVERAGE.rows(beside).orderBy(F.col("test_count").desc(), "model_name", "layer")


def sketched_coverage(models: DataFrame, counts: DataFrame) -> DataFrame:
    """As :func:`test_coverage`, from counts per ``model_unique_id`` that daily sketches give."""
    found = {"test_count": "distinct_test_unique_id", "columns_tested": "distinct_column_name"}
    beside = models.join(counts, models.unique_id == counts.model_unique_id, "left")
    return beside.select(
        F.col("name").alias("model_name"),
        F.col("schema_name").alias("layer"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(name) for name, c in found.items()],
    ).orderBy(F.col("test_count").desc(), "model_name", "layer")


def latest_invocation(results: DataFrame) -> DataFrame:
    """One row for the newest run; runs of one day are told apart by their last result."""
    newest = [F.col(c).desc() for c in ("run_date", "last_detected_at", "invocation_id")]
    return _per_invocation(results).orderBy(*newest).limit(1)


def kpi_cards(results: DataFrame, models: DataFrame, runs: DataFrame) -> DataFrame:
    """Tests and pass rate of the newest run, number of models, end of the last run."""
    return latest_invocation(results).select(
        "total_tests",
        percent_of(F.col("passed"), F.col("total_tests"), 1).cast(PERCENT).alias("pass_rate_pct"),
        models.agg(F.count("*")).scalar().alias("model_count"),
        runs.agg(F.max("execute_completed_at")).scalar().alias("last_run"),
    )


def pass_rate_series(results: DataFrame) -> DataFrame:
    return pass_rate_trend(results).select("run_date", "pass_rate_pct", "invocation_id").orderBy("run_date", "invocation_id")


def duration_series(runs: DataFrame) -> DataFrame:
    return (
        execution_times(runs)
        .select("model_name", "execution_time", "execute_started_at")
        .orderBy("execute_started_at", "model_name")
    )


def results_of_latest_run(results: DataFrame) -> DataFrame:
    newest = latest_invocation(results).select("invocation_id").scalar()
    return (
        results_by_model(results.where(F.col("invocation_id") == newest))
        .select("layer", "model", "test_type", "status", "test_count")
        .orderBy("layer", "model", "test_type", "status")
    )


def recent_failures(results: DataFrame, k: int = 50) -> DataFrame:
    shown = ["test_name", "table_name", "column_name", "test_type", "severity", "failures", "detected_at"]
    return latest_failures(results).limit(k).select(*shown)


def slowest_models(runs: DataFrame, k: int = 10, slow_above_s: float = 60) -> DataFrame:
    """The ``k`` model runs that took longest, among those that finished or failed."""
    return (
        runs.where((F.col("resource_type") == "model") & F.col("status").isin("success", "error"))
        .orderBy(F.col("execution_time").desc(), F.col("execute_started_at"), "name")
        .limit(k)
        .select("name", "execution_time", (F.col("execution_time") > slow_above_s).alias("is_slow"), "execute_started_at")
    )
