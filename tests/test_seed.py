"""The demonstration records through the whole build, against rows worked out by hand."""

import pytest
from pyspark.sql import functions as F

from stratalake.operators.checks import StaleSource
from stratalake.operators.publish import HISTORY_LAYER
from stratalake.plans import observability
from stratalake.plans.build import all_models, build, write_together
from stratalake.plans.lineage import declared_models, exposures, lineage_edges, unused_models
from stratalake.plans.views import register_observability
from stratalake.sources.seed import seed_if_empty, seed_records

GOLD = [
    (1, "Alice Johnson", 4, "197940.00", 0, "49485.00", "0.0", "Porsche Cayenne", "82900.00", "2024-04-01 14:30:00", "2024-07-10 16:00:00"),
    (2, "Bob Smith", 3, "91565.00", 0, "30521.67", "0.0", "Hyundai Tucson", "30550.00", "2024-05-01 11:00:00", "2024-07-15 09:00:00"),
    (3, "Charlie Brown", 2, "94400.00", 1, "47200.00", "50.0", "Toyota Camry", "28500.00", "2024-05-10 15:20:00", "2024-06-25 10:00:00"),
    (4, "Diana Müller", 5, "270555.00", 1, "54111.00", "20.0", "Ford Mustang", "32515.00", "2024-03-15 08:00:00", "2024-07-20 11:00:00"),
    (5, "Ethan Park", 4, "238040.00", 0, "59510.00", "0.0", "Tesla Model 3", "42990.00", "2024-04-05 10:00:00", "2024-07-25 08:00:00"),
    (6, "Fatima Al-Rashid", 3, "88865.00", 2, "29621.67", "66.7", "Ford Mustang", "32515.00", "2024-04-10 07:00:00", "2024-06-28 11:00:00"),
    (7, "George Tanaka", 3, "84850.00", 0, "28283.33", "0.0", "Honda Civic", "25800.00", "2024-03-20 04:00:00", "2024-06-10 03:00:00"),
    (8, "Hannah Cohen", 2, "54300.00", 0, "27150.00", "0.0", "Toyota Camry", "28500.00", "2024-04-15 16:00:00", "2024-06-01 12:00:00"),
    (9, "Ivan Petrov", 3, "106055.00", 1, "35351.67", "33.3", "Hyundai Tucson", "30550.00", "2024-04-25 10:00:00", "2024-07-05 15:00:00"),
    (10, "Julia Santos", 2, "78765.00", 0, "39382.50", "0.0", "Ford Mustang", "32515.00", "2024-05-12 13:00:00", "2024-07-01 10:00:00"),
    (11, "Kevin O'Brien", 3, "191790.00", 1, "63930.00", "33.3", "Tesla Model 3", "42990.00", "2024-04-08 08:00:00", "2024-07-12 11:00:00"),
    (12, "Lena Fischer", 1, "42990.00", 0, "42990.00", "0.0", "Tesla Model 3", "42990.00", "2024-07-28 09:00:00", "2024-07-28 09:00:00"),
]
SOLD = {101: (6, 1), 102: (4, 0), 103: (4, 1), 104: (4, 3), 105: (4, 0), 106: (5, 0), 107: (4, 0), 108: (4, 1)}


def golden(table):
    return [
        (r.user_id, r.full_name, r.total_purchases, str(r.total_spent), r.total_returns, str(r.avg_purchase_value),
         str(r.return_rate_pct), r.last_purchased_product, str(r.last_purchased_price),
         str(r.first_purchase_at), str(r.last_purchase_at))
        for r in table.orderBy("user_id").collect()
    ]


def test_models_without_writing(spark):
    tables = all_models(seed_records(spark))
    assert golden(tables["gold_user_purchases"]) == GOLD
    assert {r.product_id: (r.times_sold, r.times_returned) for r in tables["dim_products"].collect()} == SOLD
    street = tables["stg_users"].where("user_id = 10").first()
    assert (street.city, street.postal_code, street.gender) == ("São Paulo", "01310-100", "Female")


def test_gated_build_and_its_history(spark, warehouse):
    raw = write_together(warehouse, seed_records(spark))
    reports = {r.table_name: r for r in build(warehouse, raw, invocation_id="inv-1")}
    assert golden(warehouse.ref("gold", "gold_user_purchases")) == GOLD
    assert sum(len(r.results) for r in reports.values()) == 54
    assert all(c.status == "pass" for r in reports.values() for c in r.results)
    assert reports["stg_purchases"].row_count == 35

    results = warehouse.ref(HISTORY_LAYER, "quality_results")
    runs = warehouse.ref(HISTORY_LAYER, "run_results")
    assert results.count() == 54
    trend = observability.pass_rate_trend(results).collect()
    assert [(r.total_tests, r.passed, str(r.pass_rate_pct)) for r in trend] == [(54, 54, "100.0")]
    kinds = {r.resource_type: (r.total, r.passed, r.failed) for r in observability.invocation_history(runs).collect()}
    assert kinds == {"model": (7, 7, 0), "unit_test": (4, 4, 0), "contract": (4, 4, 0)}
    assert results.select("test_unique_id").distinct().count() == 54
    assert observability.latest_failures(results).isEmpty()
    coverage = {r.model_name: r.test_count for r in observability.test_coverage(declared_models(spark), results).collect()}
    assert coverage["dim_users"] == 9 and coverage["gold_user_purchases"] == 10
    cards = observability.kpi_cards(results, warehouse.ref(HISTORY_LAYER, "models"), runs).first()
    assert (cards.total_tests, str(cards.pass_rate_pct), cards.model_count) == (54, "100.0", 7)

    # The same reports through SQL, by the names dashboards use.
    history = warehouse.database(HISTORY_LAYER)
    assert len(register_observability(warehouse)) == 6
    models = warehouse.ref(HISTORY_LAYER, "models")
    for view, frame in {
        "v_test_pass_rate_trend": observability.pass_rate_trend(results),
        "v_test_results_by_model": observability.results_by_model(results),
        "v_model_execution_times": observability.execution_times(runs),
        "v_invocation_history": observability.invocation_history(runs),
        "v_latest_test_failures": observability.latest_failures(results),
        "v_test_coverage_by_model": observability.test_coverage(models, results),
    }.items():
        stored = spark.table(f"{history}.{view}")
        assert stored.schema.simpleString() == frame.schema.simpleString(), view
        assert sorted(map(str, stored.collect())) == sorted(map(str, frame.collect())), view
    # They follow the next build, also when what they were made over is gone.
    build(warehouse, raw, invocation_id="inv-2")
    for table in ("models", "quality_results", "run_results"):
        warehouse.drop_old_generations(HISTORY_LAYER, table)
    trend = f"SELECT invocation_id, total_tests FROM {history}.v_test_pass_rate_trend ORDER BY invocation_id"
    assert [tuple(r) for r in spark.sql(trend).collect()] == [("inv-1", 54), ("inv-2", 54)]
    assert spark.table(f"{history}.v_test_coverage_by_model").where("test_count > 0").count() == 7
    gold = warehouse.relation("gold", "gold_user_purchases", 1)
    top = spark.sql(f"SELECT full_name FROM {gold} ORDER BY total_spent DESC LIMIT 3").collect()
    assert [r.full_name for r in top] == ["Diana Müller", "Ethan Park", "Alice Johnson"]
    recent = f"SELECT count(*) FROM {gold} WHERE last_purchase_at > TIMESTAMP '2024-08-10' - INTERVAL '30 days'"
    assert spark.sql(recent).first()[0] == 5


def test_stale_sources_stop_the_build(spark, warehouse):
    raw = seed_records(spark)
    with pytest.raises(StaleSource, match="raw_users"):
        build(warehouse, raw, fresh_as_of=F.current_timestamp() + F.make_dt_interval(F.lit(2)))
    assert not warehouse.exists("staging", "stg_users")
    runs = warehouse.ref(HISTORY_LAYER, "run_results").collect()
    assert sorted({(r.resource_type, r.status) for r in runs}) == [("model", "skipped"), ("source", "error")]
    assert len(runs) == 3 + 7


@pytest.mark.parametrize("stream", ["raw_users", "raw_products", "raw_purchases"])
def test_seeding_is_idempotent(spark, warehouse, stream):
    records = seed_records(spark)[stream]
    assert seed_if_empty(warehouse, records, "raw", stream)
    assert not seed_if_empty(warehouse, records, "raw", stream)
    assert warehouse.ref("raw", stream).count() == records.count()


def test_lineage(spark):
    unused = unused_models(declared_models(spark), lineage_edges(spark), exposures(spark))
    assert [r.name for r in unused.collect()] == []
    no_consumers = exposures(spark).where(F.lit(False))
    assert [r.name for r in unused_models(declared_models(spark), lineage_edges(spark), no_consumers).collect()] == [
        "dim_products",
        "gold_user_purchases",
    ]
