import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from stratalake.operators.aggregate_state import MaintainedAggregates, Measures

SCHEMA = "id long, user_id long, price decimal(12,2), returned_at timestamp, bought_at timestamp"
START = datetime(2024, 1, 1)
MEASURES = Measures(counts=("returned_at",), sums=("price",), least=("bought_at",), greatest=("bought_at",))
COLUMNS = ["user_id", "row_count", "count_returned_at", "count_price", "sum_price", "min_bought_at", "max_bought_at"]


def maintained(spark, folder, buckets=8):
    schema = spark.createDataFrame([], SCHEMA).schema
    return MaintainedAggregates(spark, str(folder), schema, ["id"], ["user_id"], MEASURES, buckets)


def changes(spark, data):
    return spark.createDataFrame(data, f"{SCHEMA}, deleted boolean, at int")


def load(spark, table, data):
    return table.load(changes(spark, data), [F.col("at").desc()])


def plain(*batches):
    state = {}
    for batch in batches:
        latest = {}
        for row in batch:
            if row[0] not in latest or row[6] > latest[row[0]][6]:
                latest[row[0]] = row
        for key, row in latest.items():
            state.pop(key, None)
            if not row[5]:
                state[key] = row
    by_user = {}
    for row in state.values():
        by_user.setdefault(row[1], []).append(row)
    out = []
    for user, bought in by_user.items():
        prices = [r[2] for r in bought if r[2] is not None]
        times = [r[4] for r in bought if r[4] is not None]
        extremes = (min(times), max(times)) if times else (None, None)
        returned = sum(r[3] is not None for r in bought)
        out.append((user, len(bought), returned, len(prices), sum(prices) if prices else None, *extremes))
    return sorted(out, key=str)


def shown(table):
    return rows(table.read().select(*COLUMNS))


def batch(rng, number, n=40, ids=60):
    def row(k):
        at = rng.choice([None, START + timedelta(days=rng.randrange(30))])
        price = rng.choice([None, Decimal(rng.randrange(10_000)).scaleb(-2)])
        user = rng.choice([None, 1, 1, 1, *range(2, 9)])  # one user has a third
        return (k, user, price, rng.choice([None, START]), at, rng.random() < 0.3, 100 * number + rng.randrange(100))

    drawn = {}
    for k in [rng.randrange(ids) for _ in range(n)] + [None]:
        new = row(k)
        drawn[new[0], new[6]] = new
    return list(drawn.values())


def test_loads_equal_the_full_build(spark, tmp_path):
    rng = random.Random(1)
    table, batches = maintained(spark, tmp_path), []
    for number in range(3):
        batches.append(batch(rng, number))
        load(spark, table, batches[-1])
        assert shown(table) == plain(*batches)
    load(spark, table, batches[-1])  # once more
    assert shown(table) == plain(*batches)


def test_only_groups_that_lost_an_extreme_are_computed_again(spark, tmp_path):
    day = lambda d: START + timedelta(days=d)
    first = [(100 * u + k, u, Decimal(k), None, day(k), False, 1) for u in range(40) for k in range(5)]
    table = maintained(spark, tmp_path, buckets=64)
    assert load(spark, table, first)["recomputed"] == 0
    middle = [(302, 3, Decimal(7), day(1), day(3), False, 2), (999, 5, Decimal(1), None, day(9), False, 2)]
    counts = load(spark, table, middle)
    assert counts["recomputed"] == 0 and counts["searched"] <= 2 < counts["buckets"]
    edge = [(304, 3, None, None, None, True, 3)]
    counts = load(spark, table, edge)
    assert counts["recomputed"] == 1 and counts["searched"] == 1
    assert shown(table) == plain(first, middle, edge)


def test_nothing_changes(spark, tmp_path):
    table = maintained(spark, tmp_path)
    assert load(spark, table, [])["recomputed"] == 0 and shown(table) == []
    load(spark, table, [(1, 1, None, None, None, False, 1)])
    load(spark, table, [(2, 1, None, None, None, True, 1)])
    assert shown(table) == [(1, 1, 0, 0, None, None, None)]
    load(spark, table, [(1, 1, None, None, None, True, 2)])
    assert shown(table) == []


def test_a_job_that_dies_before_the_aggregates(spark, tmp_path, monkeypatch):
    first = [(k, k % 7, Decimal(k), None, START + timedelta(days=k), False, 1) for k in range(50)]
    table = maintained(spark, tmp_path)
    load(spark, table, first)
    lost = [(k, 3, Decimal(1), None, START, False, 2) for k in range(0, 50, 9)]
    with monkeypatch.context() as patch:
        patch.setattr(table.state, "refresh", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load(spark, table, lost)
    again = maintained(spark, tmp_path)
    assert shown(again) == plain(first, lost)
    load(spark, again, lost)
    load(spark, again, [(0, 1, None, None, None, True, 3)])
    assert shown(again) == plain(first, lost, [(0, 1, None, None, None, True, 3)])
