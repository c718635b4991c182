"""The reports of ``observability`` as catalog views, for those who ask with SQL."""

from __future__ import annotations

from stratalake.operators.publish import HISTORY_LAYER
from stratalake.plans import observability
from stratalake.sources.warehouse import Warehouse

# The view names dashboards ask for.
VIEWS = {
    "v_test_pass_rate_trend": observability.PASS_RATES,
    "v_test_results_by_model": observability.BY_MODEL,
    "v_model_execution_times": observability.MODEL_TIMES,
    "v_invocation_history": observability.INVOCATIONS,
    "v_latest_test_failures": observability.FAILURES,
    "v_test_coverage_by_model": observability.COVERAGE,
}


def register_observability(warehouse: Warehouse) -> list[str]:
    """Create the views beside the history; each is computed from its current rows when it is queried."""

    def relation(report: observability.Report) -> str:
        table = warehouse.relation(HISTORY_LAYER, report.of)
        if report is not observability.COVERAGE:
            return table
        tested = observability.TESTED.sql(relation(observability.TESTED))
        return f"{table} LEFT JOIN ({tested}) ON unique_id = model_unique_id"

    return [warehouse.create_view(HISTORY_LAYER, name, report.sql(relation(report))) for name, report in VIEWS.items()]
