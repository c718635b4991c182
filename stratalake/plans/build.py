"""The whole build: raw checks, staging, marts and gold, each behind its gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame

from stratalake.operators import unit_tests
from stratalake.operators.checks import StaleSource, audit, freshness, require_fresh
from stratalake.operators.publish import (
    HISTORY_LAYER,
    GateClosed,
    History,
    PublishReport,
    write_audit_publish,
)
from stratalake.plans import gold, marts, staging
from stratalake.plans.lineage import declared_models
from stratalake.plans.spec import CHECKS, CONTRACTS, LATEST, LAYERS, UNIT_TESTS, UPSTREAM, VERSIONS
from stratalake.session import estimated_bytes, size_shuffles
from stratalake.sources.warehouse import Warehouse


def model_rows(name: str, ref: Mapping[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """A model's rows from its upstream tables."""
    if name == "stg_users":
        return staging.stg_users(ref["raw_users"])
    if name == "stg_products":
        return staging.stg_products(ref["raw_products"])
    if name == "stg_purchases":
        return staging.stg_purchases(ref["raw_purchases"])
    if name == "dim_users":
        return marts.dim_users_from_fact(ref["stg_users"], ref["fct_purchases"])
    if name == "dim_products":
        return marts.dim_products(ref["stg_products"], ref["stg_purchases"])
    if name == "fct_purchases":
        return marts.fct_purchases(ref["stg_purchases"], ref["stg_products"])
    if name == "gold_user_purchases":
        return gold.gold_user_purchases(ref["dim_users"], ref["fct_purchases"], as_of)
    raise KeyError(name)


def all_models(raw: Mapping[str, DataFrame], as_of: Column | None = None) -> dict[str, DataFrame]:
    """Every model as a lazy DataFrame over the raw tables, nothing written.

    For small inputs and trials: each model parses the JSON of its inputs again.
    """
    tables = dict(raw)
    for name in UPSTREAM:
        tables[name] = model_rows(name, tables, as_of)
    return tables


def write_together(warehouse: Warehouse, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Replace several tables at the same time, as the full refresh of all raw streams does."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        written = pool.map(lambda name: warehouse.overwrite(tables[name], LAYERS[name], name), tables)
        return dict(zip(tables, written))


def build(
    warehouse: Warehouse,
    raw: Mapping[str, DataFrame],
    as_of: Column | None = None,
    invocation_id: str | None = None,
    fresh_as_of: Column | None = None,
    input_bytes: int | None = None,
) -> list[PublishReport]:
    """Check the raw tables and build every model; a closed gate blocks what depends on it.

    With ``fresh_as_of`` a stale source stops the build before anything is written. The
    history records what became of every model (those that could not be made are skipped),
    unit test, contract, stale source and check. A
    model starts once the tables it reads are published: its unit tests first, then its
    contract, its rows, and their checks. Models that do not wait for each other run side
    by side and share the cluster. Staging is written, not left as a view: three marts and
    the checks read it, and each would parse the JSON again. Shuffles are sized for
    ``input_bytes``, by default what the optimizer knows of the raw tables.
    """
    size_shuffles(warehouse.spark, estimated_bytes(*raw.values()) if input_bytes is None else input_bytes)
    history = History(warehouse, invocation_id)
    started = datetime.now(timezone.utc)
    if fresh_as_of is not None:
        try:
            require_fresh(freshness(raw, "emitted_at", fresh_as_of))
        except StaleSource as stale:
            for name in stale.names:
                history.add_run(name, "error", started, None, "source")
            for name in UPSTREAM:
                history.add_run(name, "skipped", started, None)
            history.flush()
            raise
    done: dict[str, Future] = {}

    def check_raw(name: str) -> tuple[PublishReport, DataFrame]:
        row_count, results = audit(raw[name], LAYERS[name], name, CHECKS[name])
        history.add_results(results)
        if any(r.status == "fail" for r in results):
            raise GateClosed(PublishReport(name, "blocked", row_count, results))
        return PublishReport(name, "checked", row_count, results), raw[name]

    def published(names: Iterable[str]) -> dict[str, DataFrame]:
        """The named tables, as soon as all of them are there."""
        return {name: done[name].result()[1] for name in names}

    def make(name: str) -> tuple[PublishReport, DataFrame]:
        tested = unit_tests.run(warehouse.spark, UNIT_TESTS.get(name, ()), lambda ref: model_rows(name, ref, as_of))
        for test, apart in tested.items():
            history.add_run(f"{name}.{test}", "fail" if apart else "pass", started, None, "unit_test")
        layer, version = LAYERS[name], VERSIONS.get(name)
        try:
            unit_tests.require(tested)
            upstream = published(UPSTREAM[name])
        except Exception:
            history.add_run(name, "skipped", started, None)
            raise
        report = write_audit_publish(
            warehouse,
            model_rows(name, upstream, as_of),
            layer,
            name,
            version,
            CONTRACTS.get(name),
            CHECKS[name],
            lambda: published(c.parent for c in CHECKS[name] if c.parent),
            history=history,
            latest_version=LATEST.get(name),
        )
        return report, warehouse.ref(layer, name, version)

    # A thread per table, so that waiting for other tables never holds one up.
    with ThreadPoolExecutor(max_workers=len(raw) + len(UPSTREAM) + 1) as pool:
        models = pool.submit(warehouse.overwrite, declared_models(warehouse.spark), HISTORY_LAYER, "models")
        for name in raw:
            done[name] = pool.submit(check_raw, name)
        for name in UPSTREAM:
            done[name] = pool.submit(make, name)
    history.flush()
    models.result()
    return [future.result()[0] for future in done.values()]
