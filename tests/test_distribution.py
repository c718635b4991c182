import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratalake.operators.anomaly import GRID, daily_metrics, distribution_shifts, rank_error, sketch

START = datetime(2024, 3, 1)


def frame(spark, days):
    rows = [("g" if k % 2 else None, START + timedelta(days=d, seconds=k), v) for d, values in days.items() for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "grp string, at timestamp, v double")


def shifts(spark, days, by=()):
    daily = daily_metrics(frame(spark, days), "at", {"sketch": sketch(F.col("v"))}, by)
    return distribution_shifts(daily, by).orderBy("day", *by).collect()


def exact(own, ref):
    points = sorted({*own, *ref})
    at = lambda values, x: sum(v <= x for v in values) / len(values)
    return max(abs(at(own, x) - at(ref, x)) for x in points)


def calm(rng, n=300):
    return [rng.gauss(50, 20) for _ in range(n)]


def test_distance_is_within_the_stated_error(spark):
    rng = random.Random(1)
    days = {d: calm(rng) if d % 4 else [rng.choice([1.0, 2.0, 50.0]) for _ in range(200)] for d in range(12)}
    got = shifts(spark, days)
    error = rank_error()
    assert error < 0.008
    for d, row in enumerate(got):
        ref = [v for k in range(max(0, d - 14), d) for v in days[k]]
        if not ref:
            assert row.distance is None
            continue
        true = exact(days[d], ref)
        assert true - 2 * error - 2 / GRID <= row.distance <= true + 2 * error + 1 / GRID
        assert row.n == len(days[d])


def test_a_change_of_shape_with_the_same_mean(spark):
    """And a strange day neither hides the next nor makes the calm days after it strange."""
    rng = random.Random(2)
    days = {d: calm(rng) for d in range(24)}
    for d in (15, 16, 20):
        days[d] = [50 + (v - 50) * 0.1 for v in days[d]]
    days[18] = [v + 1000 for v in days[18]]
    assert [d for d, r in enumerate(shifts(spark, days)) if r.is_shift] == [15, 16, 18, 20]


def test_silent_days_nulls_and_groups(spark):
    rng = random.Random(3)
    days = {d: calm(rng) for d in range(14) if d != 9}
    days[10] = [None] * 20
    days[13] = [0.0] * 400
    got = shifts(spark, days, ["grp"])
    assert len(got) == 28
    assert {(r.day.day, r.is_shift) for r in got if r.is_shift} == {(14, True)}
    assert all(r.n == 0 and r.distance is None for r in got if r.day.day in (10, 11))


@pytest.mark.parametrize("days", [{}, {0: [1.0]}, {0: [None, None]}])
def test_little_or_nothing(spark, days):
    assert [(r.distance, r.is_shift) for r in shifts(spark, days)] == [(None, False)] * len(days)


def test_values_are_not_shuffled(spark):
    big = spark.range(0, 200_000, 1, 4).selectExpr("timestamp_seconds(id % 10 * 86400) AS at", "rand(1) AS v")
    daily = daily_metrics(big, "at", {"sketch": sketch(F.col("v"))})
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in plan
