"""Every registered query: ``name -> callable(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Callable, Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import configure, shared_root
from stratalake.functions import cents_to_money, surrogate_key
from stratalake.operators import anomaly, checks, compare, contracts, incremental, snapshots
from stratalake.operators.aggregate_state import MaintainedAggregates
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.distinct_counts import DistinctCounts
from stratalake.operators.key_summary import SummarizedTable
from stratalake.operators.uniqueness import repeated_keys
from stratalake.operators.publish import REPORT, GateClosed, write_audit_publish
from stratalake.plans import analytics, build, gold, lineage, marts, observability, staging
from stratalake.plans.spec import CHECKS, CONTRACTS, LAYERS
from stratalake.plans.views import VIEWS, register_observability
from stratalake.sources import sample_tables, synthetic
from stratalake.sources.envelope import discover_schema, to_envelope
from stratalake.sources.partitioned import PartitionedTable
from stratalake.sources.seed import seed_if_empty as seed_table
from stratalake.sources.small import small_table
from stratalake.sources.warehouse import Warehouse
from stratalake.streaming import LateRowsTable, deduplicate, raw_stream, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

STREAMS = ("raw_users", "raw_products", "raw_purchases")


def utc_wall_clock(rows: DataFrame) -> DataFrame:
    """Timestamps as zone-less UTC, so a result reads the same in any session zone."""
    return rows.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in rows.schema
        ]
    )


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return utc_wall_clock(function(configure(spark), sf_dir))

    QUERIES[function.__name__] = run
    return run


def as_of(text: str = sample_tables.EMITTED_AT):
    return F.lit(text).cast("timestamp")


def trial_warehouse(spark: SparkSession) -> Warehouse:
    """A warehouse of its own under the shared folder, for one query."""
    return Warehouse(spark, namespace=f"trial_{uuid.uuid4().hex[:10]}_")


@contextlib.contextmanager
def passing_warehouse(spark: SparkSession) -> Iterator[Warehouse]:
    """A trial warehouse whose tables are dropped once a report on them is made."""
    warehouse = trial_warehouse(spark)
    try:
        yield warehouse
    finally:
        warehouse.drop()


def report(rows: DataFrame) -> DataFrame:
    """A result of a few rows, computed now, so that the tables behind it can go."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return small_table(rows.sparkSession, [tuple(r) for r in rows.collect()], schema)


def trial_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/trial_{uuid.uuid4().hex[:10]}"


class Sample:
    """The sample tables seen as each layer; everything is lazy and described once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @functools.cache
    def records(self, stream: str) -> DataFrame:
        reader = {
            "raw_users": sample_tables.user_records,
            "raw_products": sample_tables.product_records,
            "raw_purchases": sample_tables.purchase_records,
        }[stream]
        return reader(self.spark, self.sf_dir)

    @functools.cache
    def raw(self, stream: str) -> DataFrame:
        return to_envelope(self.records(stream), as_of())

    def raw_tables(self) -> dict[str, DataFrame]:
        return {stream: self.raw(stream) for stream in STREAMS}

    @functools.cache
    def users(self) -> DataFrame:
        return staging.typed(self.records("raw_users"), staging.USER_FIELDS, as_of())

    @functools.cache
    def products(self) -> DataFrame:
        return staging.typed(self.records("raw_products"), staging.PRODUCT_FIELDS, as_of())

    @functools.cache
    def purchases(self) -> DataFrame:
        return staging.typed(self.records("raw_purchases"), staging.PURCHASE_FIELDS, as_of())

    @functools.cache
    def dim_users(self) -> DataFrame:
        return marts.dim_users(self.users(), self.purchases(), self.products())

    @functools.cache
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.products(), self.purchases())

    @functools.cache
    def fct(self) -> DataFrame:
        return marts.fct_purchases(self.purchases(), self.products())

    @functools.cache
    def gold(self) -> DataFrame:
        return gold.gold_user_purchases(self.dim_users(), self.fct(), as_of())

    def checked_tables(self, warehouse: Warehouse) -> dict[str, DataFrame]:
        """Every table the declared checks look at, each written once to the warehouse."""
        staged = {"stg_users": self.users(), "stg_products": self.products(), "stg_purchases": self.purchases()}
        tables = {**self.raw_tables(), **build.write_together(warehouse, staged)}
        users, products, purchases = (tables[name] for name in staged)
        first = {
            "dim_products": marts.dim_products(products, purchases),
            "fct_purchases": marts.fct_purchases(purchases, products),
        }
        tables |= build.write_together(warehouse, first)
        tables |= build.write_together(warehouse, {"dim_users": marts.dim_users_from_fact(users, tables["fct_purchases"])})
        final = gold.gold_user_purchases(tables["dim_users"], tables["fct_purchases"], as_of())
        return tables | build.write_together(warehouse, {"gold_user_purchases": final})

    def order_lines(self) -> DataFrame:
        return sample_tables.order_line_purchases(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return sample_tables.table(self.spark, self.sf_dir, name)

    def results(self) -> DataFrame:
        return sample_tables.quality_history(self.spark, self.sf_dir)

    def runs(self) -> DataFrame:
        return sample_tables.run_history(self.spark, self.sf_dir)

    def models(self) -> DataFrame:
        return sample_tables.model_registry(self.spark, self.sf_dir)


# --- raw layer -------------------------------------------------------------------------


@query
def raw_envelope(spark, sf_dir):
    """All streams as raw envelope rows: JSON payload, content id, emission time."""
    streams = Sample(spark, sf_dir).raw_tables().items()
    return functools.reduce(DataFrame.unionByName, [r.select(F.lit(name).alias("stream"), "*") for name, r in streams])


@query
def raw_scan_counts(spark, sf_dir):
    return analytics.table_counts(Sample(spark, sf_dir).raw_tables())


@query
def discover_raw_schema(spark, sf_dir):
    """Fields of the three streams with type, presence and null counts."""
    streams = [
        discover_schema(rows).select(F.lit(name).alias("stream"), "*")
        for name, rows in Sample(spark, sf_dir).raw_tables().items()
    ]
    return functools.reduce(DataFrame.unionByName, streams)


@query
def seed_if_empty(spark, sf_dir):
    """Seeding every stream twice writes it once."""
    warehouse = trial_warehouse(spark)
    for stream, rows in Sample(spark, sf_dir).raw_tables().items():
        for _ in range(2):
            seed_table(warehouse, rows, "raw", stream)
    return functools.reduce(
        DataFrame.unionByName,
        [warehouse.ref("raw", stream).select(F.lit(stream).alias("stream"), "*") for stream in STREAMS],
    )


@query
def seed_then_refresh(spark, sf_dir):
    """One table seeded, refreshed, emptied, seeded again and appended to; seeding it once more adds nothing."""
    rows, warehouse = Sample(spark, sf_dir).raw("raw_products"), trial_warehouse(spark)
    few, rest = rows.where("record_id < '8'"), rows.where("record_id >= '8'")
    seed_table(warehouse, few, "raw", "raw_products")
    warehouse.overwrite(rows, "raw", "raw_products")
    warehouse.overwrite(rows.where(F.lit(False)), "raw", "raw_products")
    seed_table(warehouse, few, "raw", "raw_products")
    warehouse.append(rest, "raw", "raw_products")
    seed_table(warehouse, rows, "raw", "raw_products")
    return warehouse.ref("raw", "raw_products")


@query
def full_refresh_overwrite(spark, sf_dir):
    """Every stream replaced by a full refresh; the second load leaves no trace of the first."""
    warehouse = trial_warehouse(spark)
    streams = Sample(spark, sf_dir).raw_tables()
    build.write_together(warehouse, {n: rows.withColumn("data", F.lit(None).cast("string")) for n, rows in streams.items()})
    tables = build.write_together(warehouse, streams)
    counts = [
        rows.agg(F.count("*").alias("row_count"), F.count("data").alias("payloads")).select(
            F.lit(name).alias("table_name"), "row_count", "payloads"
        )
        for name, rows in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


@query
def synthetic_ecommerce(spark, sf_dir):
    """Generated profiles and purchases, one for each sample customer, out of 100 million users."""
    customers = Sample(spark, sf_dir).table("customer")
    ids = customers.select(F.col("c_custkey").alias("id"))
    generated = synthetic.users(ids).select("*", "address.*").drop("address")
    bought = synthetic.purchases(ids, n_users=100_000_000, n_products=5000)
    return generated.join(bought, "id")


@query
def synthetic_products(spark, sf_dir):
    """As many generated products as the sample has parts, a thousand to a task."""
    count = Sample(spark, sf_dir).table("part").count()
    return synthetic.products(synthetic.ids(spark, count, records_per_slice=1000))


# --- staging ---------------------------------------------------------------------------


@query
def stg_users(spark, sf_dir):
    return staging.stg_users(Sample(spark, sf_dir).raw("raw_users"))


@query
def stg_products(spark, sf_dir):
    return staging.stg_products(Sample(spark, sf_dir).raw("raw_products"))


@query
def stg_purchases(spark, sf_dir):
    return staging.stg_purchases(Sample(spark, sf_dir).raw("raw_purchases"))


@query
def stg_purchases_quarantine(spark, sf_dir):
    """Payloads with unusable values: what is kept, and which fields were rejected."""
    records = Sample(spark, sf_dir).records("raw_purchases")
    damaged = records.withColumns(
        {
            "user_id": F.when(F.col("user_id") < 0, "unknown").otherwise(F.col("user_id").cast("string")),
            "product_id": F.when(F.col("product_id") == 999999999, "n/a").otherwise(F.col("product_id").cast("string")),
        }
    )
    checked = staging.stage_with_errors(to_envelope(damaged, as_of()), staging.PURCHASE_FIELDS)
    return checked.select(
        "purchase_id", "user_id", "product_id", "purchased_at", F.array_join("errors", ",").alias("errors")
    )


# --- marts and gold --------------------------------------------------------------------


@query
def dim_products(spark, sf_dir):
    return Sample(spark, sf_dir).dim_products()


@query
def dim_users(spark, sf_dir):
    return Sample(spark, sf_dir).dim_users()


@query
def fct_purchases(spark, sf_dir):
    return Sample(spark, sf_dir).fct()


@query
def user_last_purchase(spark, sf_dir):
    return gold.user_last_purchase(Sample(spark, sf_dir).fct())


@query
def gold_user_purchases(spark, sf_dir):
    return Sample(spark, sf_dir).gold()


@query
def gold_order_lines(spark, sf_dir):
    """The gold table over the larger purchase fact, one purchase per order line.

    The fact is written before it is read twice, by the user measures and by the latest
    purchase; otherwise order lines would be grouped and joined for each.
    """
    sample = Sample(spark, sf_dir)
    fact = trial_warehouse(spark).overwrite(
        marts.fct_purchases(sample.order_lines(), sample.products()), "marts", "fct_purchases"
    )
    return gold.gold_user_purchases(marts.dim_users_from_fact(sample.users(), fact), fact, as_of())


@query
def full_build(spark, sf_dir):
    """Raw JSON to gold with every contract, check and gate on the way; the published gold table."""
    sample = Sample(spark, sf_dir)
    lines = sample_tables.order_line_records(spark, sf_dir)
    warehouse = trial_warehouse(spark)
    raw = build.write_together(warehouse, {**sample.raw_tables(), "raw_purchases": to_envelope(lines, as_of())})
    build.build(warehouse, raw, as_of())
    for layer in ("raw", "staging", "marts", "observability"):
        warehouse.drop(layer)
    return warehouse.ref("gold", "gold_user_purchases")


@query
def layer_showcase(spark, sf_dir):
    """The first rows of each layer, side by side."""
    sample = Sample(spark, sf_dir)

    def first(layer, rows, n):
        named = rows.select("user_id", "full_name", *([] if layer == "staging" else ["total_spent"]))
        shown = analytics.layer_sample(named, "user_id", named.columns, n)
        spent = F.col("total_spent") if layer != "staging" else F.lit(None).cast("decimal(12,2)")
        return shown.select(F.lit(layer).alias("layer"), "user_id", "full_name", spent.alias("total_spent"))

    return (
        first("staging", sample.users(), 5)
        .unionByName(first("marts", sample.dim_users(), 10))
        .unionByName(first("gold", sample.gold(), 10))
    )


@query
def versioned_latest(spark, sf_dir):
    """Versions 1, 2 and 1 again: the pinned one, the bare name, and the bare name declared to be version 1."""
    products = Sample(spark, sf_dir).dim_products()
    wider = products.withColumn("has_sales", F.col("times_sold") > 0)
    describe = lambda name, rows: rows.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("relation"), F.lit(len(rows.columns)).alias("columns"), "row_count"
    )
    with passing_warehouse(spark) as warehouse:
        for version, rows in ((1, products), (2, wider), (1, products.where("times_sold > 0"))):
            warehouse.overwrite(rows, "marts", "dim_products", version=version)
        found = describe("dim_products_v1", warehouse.ref("marts", "dim_products", version=1))
        found = report(found.unionByName(describe("dim_products", warehouse.ref("marts", "dim_products"))))
        warehouse.overwrite(wider, "marts", "dim_products", version=2, latest_version=1)
        declared = report(describe("dim_products, declared", warehouse.ref("marts", "dim_products")))
    return found.unionByName(declared)


@query
def versioned_projection(spark, sf_dir):
    """A version that leaves out two columns."""
    return incremental.versioned_projection(Sample(spark, sf_dir).dim_products(), exclude=["loaded_at", "created_at"])


# --- gold reports ----------------------------------------------------------------------


@query
def top_spenders(spark, sf_dir):
    return analytics.top_spenders(Sample(spark, sf_dir).gold())


@query
def high_return_rate(spark, sf_dir):
    return analytics.high_return_rate(Sample(spark, sf_dir).gold(), above_pct=15)


@query
def customer_lifetime_value(spark, sf_dir):
    report = analytics.customer_lifetime_value(Sample(spark, sf_dir).gold())
    # Interval types differ between engines; whole seconds do not.
    seconds = F.floor(F.expr("extract(DAY FROM customer_tenure) * 86400 + extract(HOUR FROM customer_tenure) * 3600"
                             " + extract(MINUTE FROM customer_tenure) * 60 + extract(SECOND FROM customer_tenure)"))
    return report.withColumn("tenure_seconds", seconds.cast("bigint")).drop("customer_tenure")


@query
def recent_purchasers(spark, sf_dir):
    return analytics.recent_purchasers(Sample(spark, sf_dir).gold(), as_of("2024-02-25 00:00:00"))


@query
def geo_revenue(spark, sf_dir):
    return analytics.geo_revenue(Sample(spark, sf_dir).gold())


@query
def revenue_by_country(spark, sf_dir):
    return analytics.revenue_by_country(Sample(spark, sf_dir).gold())


@query
def return_rate_histogram(spark, sf_dir):
    return analytics.return_rate_histogram(Sample(spark, sf_dir).gold())


@query
def value_vs_return_rate(spark, sf_dir):
    return analytics.value_vs_return_rate(Sample(spark, sf_dir).gold())


@query
def purchase_timeline(spark, sf_dir):
    return analytics.purchase_timeline(Sample(spark, sf_dir).gold())


@query
def product_monthly_sales(spark, sf_dir):
    return analytics.product_monthly_sales(Sample(spark, sf_dir).fct())


@query
def weekly_kpi(spark, sf_dir):
    return analytics.weekly_retention(Sample(spark, sf_dir).fct())


@query
def rfm_features(spark, sf_dir):
    customers = trial_warehouse(spark).overwrite(Sample(spark, sf_dir).gold(), "gold", "gold_user_purchases")
    return analytics.segmentation_features(customers, as_of())


# --- checks ----------------------------------------------------------------------------


def _checked(spark, sf_dir, keep, more=()):
    """The declared checks that ``keep`` accepts, over the tables that declare them, and some more."""
    with passing_warehouse(spark) as warehouse:
        tables = Sample(spark, sf_dir).checked_tables(warehouse)
        parts = [
            checks.run_checks(tables[name], LAYERS[name], name, chosen, tables)
            for name, declared in CHECKS.items()
            if (chosen := [c for c in declared if keep(c)])
        ]
        parts += [checks.run_checks(tables[name], LAYERS[name], name, declared, tables) for name, declared in more]
        return report(functools.reduce(DataFrame.unionByName, parts))


@query
def check_not_null(spark, sf_dir):
    return _checked(spark, sf_dir, lambda c: c.test_type == "not_null")


@query
def check_unique(spark, sf_dir):
    return _checked(spark, sf_dir, lambda c: c.test_type == "unique")


@query
def check_unique_two_pass(spark, sf_dir):
    """Repeated keys of clean, composite, repeating and text columns: how many there are, and in how many rows."""
    sample = Sample(spark, sf_dir)
    keys = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["user_id"], "customer": ["c_name"]}
    parts = [
        repeated_keys(sample.table(name), columns).agg(
            F.lit(name).alias("table_name"),
            F.lit(",".join(columns)).alias("columns"),
            F.count("*").alias("failures"),
            F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("row_count"),
        )
        for name, columns in keys.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def check_accepted_values(spark, sf_dir):
    """The declared values, and a list too short for the data."""
    users = Sample(spark, sf_dir).users()
    declared = [c for c in CHECKS["stg_users"] if c.test_type == "accepted_values"]
    return checks.run_checks(
        users, "staging", "stg_users", [*declared, checks.accepted_values("academic_degree", ["Master"])]
    )


@query
def check_relationships(spark, sf_dir):
    return _checked(spark, sf_dir, lambda c: c.test_type == "relationships")


@query
def check_expression(spark, sf_dir):
    """The declared conditions, and one that many products break."""
    sold = checks.expression_is_true("times_returned", "= 0")
    return _checked(spark, sf_dir, lambda c: c.test_type == "expression_is_true", [("dim_products", [sold])])


@query
def check_extended(spark, sf_dir):
    """Range, pattern, fill-share and not-in-the-future checks."""
    sample = Sample(spark, sf_dir)
    users = checks.run_checks(
        sample.users(),
        "staging",
        "stg_users",
        [
            checks.between("age", 20, 70),
            checks.matches("email", "^user[0-9]+@example[.]com$"),
            checks.matches("blood_type", "^O"),
            checks.not_null_proportion("gender", 0.75),
            checks.not_null_proportion("title", 0.9),
        ],
    )
    purchases = checks.run_checks(
        sample.purchases(),
        "staging",
        "stg_purchases",
        [checks.expression_is_true("returned_at", "<= TIMESTAMP '2024-02-01 00:00:00'")],
    )
    return users.unionByName(purchases)


@query
def check_severity(spark, sf_dir):
    """The same check under different severities and thresholds."""
    fct = Sample(spark, sf_dir).fct()
    options = [
        {"severity": "error"},
        {"severity": "warn"},
        {"severity": "error", "warn_above": 10, "error_above": 1000000000},
        {"severity": "error", "warn_above": 1000000000, "error_above": 1000000000},
    ]
    declared = [checks.not_null("purchased_at", **o) for o in options]
    numbered = checks.run_checks(fct, "marts", "fct_purchases", declared)
    return numbered.select("check_name", "column_name", "severity", "failures", "status")


@query
def check_failing_rows(spark, sf_dir):
    """The purchases a foreign-key check rejects, whole."""
    sample = Sample(spark, sf_dir)
    check = next(c for c in CHECKS["stg_purchases"] if c.test_type == "relationships" and c.column == "product_id")
    return checks.failing_rows(sample.purchases(), check, {"stg_products": sample.products()}).drop("value")


@query
def check_suite(spark, sf_dir):
    """All declared checks over all tables."""
    return _checked(spark, sf_dir, lambda c: True)


@query
def source_freshness(spark, sf_dir):
    """Streams 6, 18 and 30 hours old, and one that is empty."""
    raw = Sample(spark, sf_dir).raw_tables()
    hours = {"raw_users": 6, "raw_products": 18, "raw_purchases": 30}
    aged = {n: r.withColumn("emitted_at", F.col("emitted_at") - F.make_dt_interval(F.lit(0), F.lit(hours[n]))) for n, r in raw.items()}
    aged["raw_empty"] = raw["raw_users"].where(F.col("data").isNull())
    return checks.freshness(aged, "emitted_at", as_of())


@query
def contract_diff(spark, sf_dir):
    """The user dimension with a renamed and a retyped column, against a contract too narrow for its sums."""
    drifted = (
        Sample(spark, sf_dir)
        .dim_users()
        .withColumnRenamed("occupation", "job")
        .withColumn("age", F.col("age").cast("string"))
    )
    narrow = [(c, "decimal(6,2)" if c == "total_spent" else t) for c, t in CONTRACTS["dim_users"]]
    return contracts.contract_diff(drifted, narrow)


@query
def wap_report(spark, sf_dir):
    """Two tables through the gate: one passes, one is stopped by dangling references."""
    sample = Sample(spark, sf_dir)
    users, products = sample.users(), sample.products()
    with passing_warehouse(spark) as warehouse:
        reports = [
            write_audit_publish(
                warehouse, sample.dim_products(), "marts", "dim_products", 1,
                CONTRACTS["dim_products"], CHECKS["dim_products"], {"stg_products": products},
            )
        ]
        try:
            write_audit_publish(
                warehouse, sample.fct(), "marts", "fct_purchases", 1,
                CONTRACTS["fct_purchases"], CHECKS["fct_purchases"], {"stg_users": users, "stg_products": products},
            )
        except GateClosed as closed:
            reports.append(closed.report)
    return small_table(spark, [r.as_row() for r in reports], REPORT)


@query
def build_history(spark, sf_dir):
    """What a build records whose gate closes at the purchases: checks, models, unit tests."""
    with passing_warehouse(spark) as warehouse:
        raw = build.write_together(warehouse, Sample(spark, sf_dir).raw_tables())
        with contextlib.suppress(GateClosed):
            build.build(warehouse, raw, as_of(), invocation_id="inv-1")
        results = warehouse.ref("observability", "quality_results").select(
            F.lit("check").alias("kind"), F.col("test_unique_id").alias("name"), "status", F.col("failures").alias("n")
        )
        runs = warehouse.ref("observability", "run_results").select(
            F.col("resource_type").alias("kind"), "name", "status", F.col("rows_affected").alias("n")
        )
        return report(results.unionByName(runs))


# --- observability ---------------------------------------------------------------------


@query
def obs_pass_rate_trend(spark, sf_dir):
    return observability.pass_rate_trend(Sample(spark, sf_dir).results())


@query
def obs_results_by_model(spark, sf_dir):
    return observability.results_by_model(Sample(spark, sf_dir).results())


@query
def obs_execution_times(spark, sf_dir):
    return observability.execution_times(Sample(spark, sf_dir).runs())


@query
def obs_invocation_history(spark, sf_dir):
    return observability.invocation_history(Sample(spark, sf_dir).runs())


@query
def obs_latest_failures(spark, sf_dir):
    return observability.latest_failures(Sample(spark, sf_dir).results())


@query
def obs_test_coverage(spark, sf_dir):
    sample = Sample(spark, sf_dir)
    return observability.test_coverage(sample.models(), sample.results())


def _counted_results(spark, sf_dir, columns, by) -> DistinctCounts:
    """The history of results by day with sketches beside it: two loads, the second of which replaces a day of the first."""
    results = Sample(spark, sf_dir).results().withColumn("run_day", F.to_date("detected_at"))
    rows = results.select(*dict.fromkeys([*by, *columns]), "run_day")
    table = PartitionedTable(spark, f"{trial_folder(spark)}/results", "run_day")
    counts = DistinctCounts(table, f"{trial_folder(spark)}/sketches", rows.schema, columns, by)
    unnamed = F.when(F.col("run_day") < F.lit("2024-01-20").cast("date"), F.col(columns[0]))
    table.replace(rows.where("run_day <= DATE '2024-01-20'").withColumn(columns[0], unnamed))
    counts.refresh()
    table.replace(rows.where("run_day >= DATE '2024-01-20'"))
    counts.refresh()
    return counts


@query
def obs_test_coverage_sketched(spark, sf_dir):
    """Tests and tested columns per model over all days, from daily sketches."""
    counts = _counted_results(spark, sf_dir, ["test_unique_id", "column_name"], ["model_unique_id"])
    return observability.sketched_coverage(Sample(spark, sf_dir).models(), counts.between())


@query
def distinct_rolling(spark, sf_dir):
    """Different results and tests of seven days per layer, and how many were there in the seven days before."""
    columns = ["test_results_description", "test_unique_id"]
    return _counted_results(spark, sf_dir, columns, ["schema_name"]).rolling(7)


@query
def dash_kpis(spark, sf_dir):
    sample = Sample(spark, sf_dir)
    return observability.kpi_cards(sample.results(), sample.models(), sample.runs())


@query
def dash_pass_rate_series(spark, sf_dir):
    return observability.pass_rate_series(Sample(spark, sf_dir).results())


@query
def dash_duration_series(spark, sf_dir):
    return observability.duration_series(Sample(spark, sf_dir).runs())


@query
def dash_results_latest_run(spark, sf_dir):
    return observability.results_of_latest_run(Sample(spark, sf_dir).results())


@query
def dash_recent_failures(spark, sf_dir):
    return observability.recent_failures(Sample(spark, sf_dir).results())


@query
def view_reports(spark, sf_dir):
    """The catalog views over a history that grows after they were made, read by SQL."""
    sample, warehouse = Sample(spark, sf_dir), trial_warehouse(spark)
    results = sample.results()
    warehouse.overwrite(sample.models(), "observability", "models")
    warehouse.overwrite(sample.runs(), "observability", "run_results")
    warehouse.overwrite(results.where("test_type = 'error'"), "observability", "quality_results")
    register_observability(warehouse)
    warehouse.append(results.where("test_type <> 'error'"), "observability", "quality_results")
    history = warehouse.database("observability")
    return spark.sql(f"SELECT * FROM `{history}`.v_test_pass_rate_trend")


@query
def view_totals(spark, sf_dir):
    """All six catalog views: how many rows each has, and the total of one of its columns."""
    sample, warehouse = Sample(spark, sf_dir), trial_warehouse(spark)
    warehouse.overwrite(sample.models(), "observability", "models")
    warehouse.overwrite(sample.runs(), "observability", "run_results")
    warehouse.overwrite(sample.results(), "observability", "quality_results")
    totals = {
        "v_test_pass_rate_trend": "sum(passed)",
        "v_test_results_by_model": "sum(test_count)",
        "v_model_execution_times": "sum(rows_affected)",
        "v_invocation_history": "sum(failed)",
        "v_latest_test_failures": "sum(failures)",
        "v_test_coverage_by_model": "sum(columns_tested)",
    }
    names = dict(zip(VIEWS, register_observability(warehouse)))
    parts = [
        spark.sql(f"SELECT '{view}' AS view, count(*) AS row_count, CAST({total} AS BIGINT) AS total FROM {names[view]}")
        for view, total in totals.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def slowest_models(spark, sf_dir):
    return observability.slowest_models(Sample(spark, sf_dir).runs())


@query
def unused_models(spark, sf_dir):
    """Models of the run history that nothing reads: edges and consumers come from it too."""
    events = Sample(spark, sf_dir).table("events")
    models = events.selectExpr("concat('model_', user_id % 50) AS name").distinct()
    edges = events.where("event_type = 'click'").selectExpr("concat('model_', event_id % 31) AS upstream")
    consumers = events.where("event_type = 'view'").selectExpr("concat('model_', event_id % 37) AS model")
    return lineage.unused_models(models, edges, consumers)


@query
def unused_models_transitive(spark, sf_dir):
    """Models from which no consumer can be reached; edges of the run history, cycles among them."""
    events = Sample(spark, sf_dir).table("events")
    models = events.selectExpr("concat('model_', user_id % 50) AS name").distinct()
    edges = events.where("event_type = 'click'").selectExpr(
        "concat('model_', user_id % 50) AS upstream", "concat('model_', (user_id % 50 * 3 + 1) % 50) AS downstream"
    )
    consumers = events.where("event_type = 'view'").selectExpr("concat('model_', event_id % 5) AS model")
    return lineage.unreached_models(models, edges, consumers)


# --- incremental loads, history, comparison --------------------------------------------


@query
def incr_cursor_lookback(spark, sf_dir):
    """Events copied in three loads: some have no time, some come late, some twice."""
    events = Sample(spark, sf_dir).table("events").select("event_id", "user_id", "event_type", "ts")
    source = events.withColumn("ts", F.when(F.col("event_id") % 53 != 0, F.col("ts")))
    source = source.unionByName(source.where("event_id % 10 = 0"))
    late = F.coalesce((F.col("event_id") % 7 == 0) & (F.col("ts") >= "2024-01-10"), F.lit(False))
    seen = [
        source.where(~late & F.expr("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'")),
        source.where(~late),
        source,
    ]
    copied = incremental.CursorTable(spark, trial_folder(spark), source.schema, "ts", timedelta(days=25))
    for state in seen:
        copied.load(state)
    return copied.read()


@query
def dedup_latest(spark, sf_dir):
    """The newest event of each user; the event id breaks ties."""
    events = Sample(spark, sf_dir).table("events")
    newest = [F.col("ts").desc_nulls_first(), F.col("event_id").desc()]
    return latest_per_key(events, ["user_id"], newest).select("user_id", "event_id", "ts", "event_type", "value")


@query
def incr_high_water(spark, sf_dir):
    """Orders newer than a target that holds those up to the end of 1996."""
    orders = Sample(spark, sf_dir).table("orders")
    loaded = orders.where("o_orderdate < TIMESTAMP_NTZ '1997-01-01 00:00:00'")
    fresh = incremental.rows_after_high_water(orders, loaded, "o_orderdate")
    return fresh.select("o_orderkey", "o_custkey", "o_orderdate")


def _event_delta(spark, sf_dir):
    """Per user: the state before 20 January as target, later events as delta."""
    events = Sample(spark, sf_dir).table("events").select("user_id", "event_id", "ts", "event_type")
    cutoff = "TIMESTAMP_NTZ '2024-01-20 00:00:00'"
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    target = latest_per_key(events.where(f"ts < {cutoff}"), ["user_id"], newest)
    return target, events.where(f"ts >= {cutoff}"), newest


@query
def incr_upsert(spark, sf_dir):
    target, delta, newest = _event_delta(spark, sf_dir)
    return incremental.upsert(target, delta, ["user_id"], newest)


@query
def incr_upsert_late(spark, sf_dir):
    """The newest event per user, upserted by day in three loads that come in the wrong order."""
    path = trial_folder(spark)
    events = Sample(spark, sf_dir).table("events").select("user_id", "event_id", "ts", "event_type")
    rows = events.withColumn("event_day", F.to_date("ts"))
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    for part in (2, 0, 1):
        delta = latest_per_key(rows.where(f"event_id % 3 = {part}"), ["user_id"], newest)
        incremental.upsert_partitions(delta, path, ["user_id"], newest, "event_day")
    return incremental.read_partitions(spark, path, "event_day", rows.schema)


@query
def incr_upsert_pruned(spark, sf_dir):
    """The same loads as in ``incr_upsert_late``; each reads only days whose key summary may hold its users."""
    events = Sample(spark, sf_dir).table("events").select("user_id", "event_id", "ts", "event_type")
    rows = events.withColumn("event_day", F.to_date("ts"))
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    loaded = SummarizedTable(spark, trial_folder(spark), ["user_id"], "event_day", rows.schema)
    for part in (2, 0, 1):
        loaded.upsert(latest_per_key(rows.where(f"event_id % 3 = {part}"), ["user_id"], newest), newest)
    return loaded.read()


@query
def incr_dim_users(spark, sf_dir):
    """The user dimension over aggregates that follow three loads of new, corrected and deleted purchases."""
    sample = Sample(spark, sf_dir)
    prices = sample.products().select("product_id", F.col("price").alias("product_price"))
    priced = sample.purchases().join(prices, "product_id", "left")
    rows = priced.select("purchase_id", "user_id", "product_price", "purchased_at", "returned_at")
    by_user = (["purchase_id"], ["user_id"], marts.ACTIVITY)
    users = MaintainedAggregates(spark, trial_folder(spark), rows.schema, *by_user, buckets=8)
    corrected = rows.where("purchase_id % 8 = 1").withColumn("returned_at", F.col("purchased_at"))
    loads = [
        rows.where("purchase_id % 4 <> 0").withColumn("deleted", F.lit(False)),
        rows.where("purchase_id % 4 = 0").unionByName(corrected).withColumn("deleted", F.lit(False)),
        rows.where("purchase_id % 5 = 0").withColumn("deleted", F.lit(True)),
    ]
    for changes in loads:
        users.load(changes, [F.col("purchase_id")])
    return marts.dim_users_from_activity(sample.users(), marts.maintained_activity(users.read()))


@query
def incr_delete_insert(spark, sf_dir):
    target, delta, _ = _event_delta(spark, sf_dir)
    return incremental.delete_insert(target, delta, ["user_id"])


@query
def incr_append(spark, sf_dir):
    """A table appended to in two loads."""
    events = Sample(spark, sf_dir).table("events").select("event_id", "ts", "user_id")
    warehouse = trial_warehouse(spark)
    for part in ("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'", "ts >= TIMESTAMP_NTZ '2024-01-15 00:00:00'"):
        warehouse.append(events.where(part), "staging", "events")
    return warehouse.ref("staging", "events")


@query
def incr_insert_overwrite(spark, sf_dir):
    """Days from 20 January on replaced by corrected values; earlier days untouched."""
    path = trial_folder(spark)
    events = Sample(spark, sf_dir).table("events").withColumn("event_day", F.to_date("ts"))
    rows = events.select("event_id", "event_type", "value", "event_day")
    incremental.overwrite_partitions(rows, path, "event_day")
    corrected = rows.where("event_day >= DATE '2024-01-20'").withColumn("value", F.lit(0.0))
    incremental.overwrite_partitions(corrected, path, "event_day")
    return incremental.read_partitions(spark, path, "event_day", rows.schema)


@query
def microbatch_daily(spark, sf_dir):
    """A first load up to 16 January, then a batch whose lookback repairs the three days before."""
    path = trial_folder(spark)
    events = Sample(spark, sf_dir).table("events").select("event_id", "ts", "event_type")
    early = events.where("event_type <> 'signup'")  # sign-ups arrive late
    incremental.microbatch(early, path, "ts", date(2024, 1, 1), date(2024, 1, 17), lookback=0)
    incremental.microbatch(events, path, "ts", date(2024, 1, 17), date(2024, 1, 25), lookback=3)
    loaded = incremental.read_partitions(spark, path, "event_day", events.withColumn("event_day", F.to_date("ts")).schema)
    return loaded.groupBy("event_day").agg(F.count("*").alias("row_count"))


@query
def microbatch_unique_key(spark, sf_dir):
    """One row per user and range; the reload finds one day gone and some users on another day."""
    path = trial_folder(spark)
    events = Sample(spark, sf_dir).table("events").select("event_id", "ts", "user_id")
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    options = {"unique_key": ["user_id"], "newest_first": newest, "lookback": 0}
    first = events.where("event_id % 2 = 0")
    incremental.microbatch(first, path, "ts", date(2024, 1, 1), date(2024, 1, 13), **options)
    left = events.where("to_date(ts) <> DATE '2024-01-15'")
    incremental.microbatch(first, path, "ts", date(2024, 1, 13), date(2024, 1, 17), isolate=True, **options)
    incremental.microbatch(left, path, "ts", date(2024, 1, 13), date(2024, 1, 17), **options)
    return incremental.read_partitions(spark, path, "event_day", events.withColumn("event_day", F.to_date("ts")).schema)


@query
def schema_evolve(spark, sf_dir):
    """A load that lost one column and gained another, under the three merging policies."""
    nationwide = Sample(spark, sf_dir).table("customer").select("c_custkey", "c_name", "c_mktsegment")
    target = nationwide.where("c_mktsegment <> 'BUILDING'")
    incoming = nationwide.where("c_mktsegment = 'BUILDING'").select(
        "c_custkey", "c_name", F.length("c_name").alias("name_length")
    )
    parts = []
    for policy in ("ignore", "append_new_columns", "sync_all_columns"):
        merged = incremental.evolve_schema(target, incoming, policy)
        filled = [
            F.count(F.col(c)).alias(f"{c}_filled") if c in merged.columns else F.lit(None).cast("bigint").alias(f"{c}_filled")
            for c in ("c_mktsegment", "name_length")
        ]
        parts.append(
            merged.agg(F.count("*").alias("row_count"), *filled).select(
                F.lit(policy).alias("policy"), F.lit(len(merged.columns)).alias("columns"), "*"
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


def _user_states(spark, sf_dir):
    """Users as first seen, and later: some moved, some are new, some are gone."""
    users = Sample(spark, sf_dir).users().select("user_id", "occupation", "city", "created_at", "updated_at")
    before = users.where("created_at < TIMESTAMP '2023-08-01 00:00:00'").withColumn(
        "updated_at", F.col("created_at")
    )
    moved = F.col("updated_at") >= F.lit("2024-01-20 00:00:00").cast("timestamp")
    after = users.where("occupation <> 'MACHINERY'").withColumns(
        {
            "city": F.when(moved, F.concat(F.lit("New "), F.col("city"))).otherwise(F.col("city")),
            "updated_at": F.when(moved, F.col("updated_at")).otherwise(F.col("created_at")),
        }
    )
    return before, after


@query
def scd2_snapshot(spark, sf_dir):
    """Type 2 history by update time; rows that are gone stay open."""
    before, after = _user_states(spark, sf_dir)
    history = snapshots.first_snapshot(before, ["user_id"], F.col("updated_at"))
    result = snapshots.snapshot(history, after, ["user_id"], as_of(), updated_at="updated_at")
    return result.select("user_id", "city", "valid_from", "valid_to", "scd_id")


@query
def scd2_snapshot_check(spark, sf_dir):
    """Type 2 history by compared columns; rows that are gone are closed."""
    before, after = _user_states(spark, sf_dir)
    history = snapshots.first_snapshot(before, ["user_id"], as_of("2023-09-01 00:00:00"))
    result = snapshots.snapshot(history, after, ["user_id"], as_of(), check_columns=["city"], close_deleted=True)
    return result.select("user_id", "city", "valid_from", "valid_to", "scd_id")


@query
def scd2_changelog(spark, sf_dir):
    """What a user does last as a history, a sign-up ending it; told by a log that comes in three mixed parts."""
    events = Sample(spark, sf_dir).table("events").select("user_id", "event_type", "ts", "event_id")
    gone = F.col("event_type") == "signup"
    parts = [events.where(f"event_id % 3 = {part}") for part in (2, 0, 1)]
    options = {"keys": ["user_id"], "changed_at": "ts", "deleted": gone, "sequence": ["event_id"], "slice_by": "week"}
    log, history = parts[0], snapshots.from_changes(parts[0], **options)
    for batch in parts[1:]:
        history = snapshots.merge_changes(history, log, batch, **options)
        log = log.unionByName(batch)
    return history


@query
def compare_relations(spark, sf_dir):
    before, after = _user_states(spark, sf_dir)
    return compare.compare_relations(before, after, ["user_id"])


@query
def compare_differences(spark, sf_dir):
    """Every user that is not the same before and after, and in which columns."""
    before, after = _user_states(spark, sf_dir)
    found = compare.differences(before, after, ["user_id"])
    return found.select("user_id", "status", F.array_join("columns", ",").alias("columns"))


@query
def compare_columns(spark, sf_dir):
    before, after = _user_states(spark, sf_dir)
    return compare.compare_columns(before, after, ["user_id"])


@query
def compare_row_counts(spark, sf_dir):
    before, after = _user_states(spark, sf_dir)
    return compare.row_differences(before, after)


@query
def volume_anomaly(spark, sf_dir):
    """Daily event counts against the 14 days before; two days are silent."""
    events = Sample(spark, sf_dir).table("events").where("day(ts) NOT IN (20, 21)")
    daily = anomaly.daily_metrics(events, "ts", {})
    return anomaly.anomalies(daily, "row_count", sigmas=1.5)


@query
def schema_anomaly(spark, sf_dir):
    """Fields of the events' records that appear, vanish or change type from one day to the next."""
    events = Sample(spark, sf_dir).table("events")
    d = F.dayofmonth("ts")
    fields = F.map_concat(
        F.create_map(F.lit("k"), F.when(d.between(10, 12), F.lit("string")).otherwise(F.lit("bigint"))),
        F.when(d >= 15, F.create_map(F.lit("channel"), F.lit("string"))).otherwise(F.expr("map()").cast("map<string,string>")),
        F.when(d % 7 != 0, F.create_map(F.lit("value"), F.lit("double"))).otherwise(F.expr("map()").cast("map<string,string>")),
    )
    return anomaly.schema_changes(events, "ts", fields)


@query
def distribution_anomaly(spark, sf_dir):
    """Daily share of errors per event type group against the 14 days before."""
    events = Sample(spark, sf_dir).table("events")
    large = F.count_if(F.col("value") >= 100)
    daily = anomaly.daily_metrics(events, "ts", {"large_values": large}, by=["event_type"])
    return anomaly.anomalies(daily, "large_values", by=["event_type"], sigmas=2.0)


@query
def distribution_shift(spark, sf_dir):
    """Days whose values are distributed otherwise than before: three days, whose mean is as ever, have few large ones."""
    events = Sample(spark, sf_dir).table("events")
    few = F.when(F.col("event_id") % 10 == 0, 500.0).otherwise(0.0)
    value = F.when(F.dayofmonth("ts").isin(18, 19, 25), few).otherwise(F.col("value"))
    daily = anomaly.daily_metrics(events, "ts", {"sketch": anomaly.sketch(value)})
    return anomaly.distribution_shifts(daily).select("day", "n", "is_shift")


@query
def freshness_anomaly(spark, sf_dir):
    """Seconds from each day's last event to midnight against the 14 days before."""
    silence = F.unix_timestamp(F.date_add(F.to_date(F.max("ts")), 1)) - F.unix_timestamp(F.max("ts").cast("timestamp"))
    daily = anomaly.daily_metrics(Sample(spark, sf_dir).table("events"), "ts", {"silent_seconds": silence})
    return anomaly.anomalies(daily, "silent_seconds", sigmas=1.5)


@query
def dedup_staging_money(spark, sf_dir):
    """Orders delivered twice in cents: the later delivery, as amounts."""
    orders = Sample(spark, sf_dir).table("orders").select(
        "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    )
    first = orders.withColumn("loaded_at", as_of("2024-01-01 00:00:00"))
    corrected = orders.select("o_orderkey", (F.col("cents") + 1).alias("cents"), as_of().alias("loaded_at"))
    latest = latest_per_key(first.unionByName(corrected), ["o_orderkey"], [F.col("loaded_at").desc()])
    return latest.select("o_orderkey", cents_to_money(F.col("cents")).alias("amount"), "loaded_at")


@query
def surrogate_keys(spark, sf_dir):
    """A key made of two columns, one of them with NULLs; and one of texts that would run together."""
    users = Sample(spark, sf_dir).users()
    split = F.when(F.col("user_id") % 2 == 0, F.array(F.lit("x|=y"), F.lit("z"))).otherwise(F.array(F.lit("x"), F.lit("y|=z")))
    return users.select(
        "user_id",
        surrogate_key(["user_id", "gender"]).alias("user_key"),
        surrogate_key([split[0], split[1]]).alias("text_key"),
    )


@query
def stream_late_rows(spark, sf_dir):
    """Purchases as a stream in four batches of mixed age: late ones are on record and in their day."""
    folder = trial_folder(spark)
    raw = Sample(spark, sf_dir).raw("raw_purchases")
    for part in (3, 0, 2, 1):
        raw.where(f"pmod(xxhash64(record_id), 4) = {part}").coalesce(1).write.mode("append").parquet(f"{folder}/arrivals")
    staged = staging.stg_purchases(raw_stream(spark, f"{folder}/arrivals", max_files_per_trigger=1))
    staged = staged.withColumn("event_day", F.to_date("added_to_cart_at"))
    newest = [F.col("loaded_at").desc()]
    table = LateRowsTable(
        spark, folder, staged.schema, ["purchase_id"], newest, "event_day", "added_to_cart_at", timedelta(hours=1)
    )
    table.start(staged).awaitTermination()
    return table.read()


@query
def stream_dedup(spark, sf_dir):
    """Purchases delivered twice as a stream of files, in four batches: deduplicated, staged and upserted by day."""
    folder = trial_folder(spark)
    raw = Sample(spark, sf_dir).raw("raw_purchases")
    for _ in range(2):
        raw.write.mode("append").parquet(f"{folder}/arrivals")
    files = len(spark.read.parquet(f"{folder}/arrivals").inputFiles())
    stream = raw_stream(spark, f"{folder}/arrivals", max_files_per_trigger=-(-files // 4))
    arrivals = deduplicate(stream, ["record_id"], "emitted_at", "1 hour")
    staged = staging.stg_purchases(arrivals).withColumn("event_day", F.to_date("added_to_cart_at"))
    newest = [F.col("loaded_at").desc()]
    upsert_stream(
        staged, f"{folder}/table", f"{folder}/checkpoint", ["purchase_id"], newest, "event_day"
    ).awaitTermination()
    return incremental.read_partitions(spark, f"{folder}/table", "event_day", staged.schema)
