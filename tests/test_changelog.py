import random
from datetime import datetime, timedelta

import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from stratalake.operators import snapshots

SCHEMA = "id long, part string, at timestamp, seq int, op string, city string, _at string"
START = datetime(2024, 1, 1)


def log_of(spark, data):
    return spark.createDataFrame([(*r, "x") for r in data], SCHEMA)


def history_of(spark, data, **options):
    return snapshots.from_changes(log_of(spark, data), ["id", "part"], "at", F.col("op") == "D", ["seq"], **options)


def plain(data):
    """Per key: the last change at each time, equal neighbours merged, each period up to the next step."""
    by_key = {}
    for key, part, at, seq, op, city in data:
        by_key.setdefault((key, part), {}).setdefault(at, []).append((seq is not None, seq or 0, op, city))
    out = []
    for key, times in by_key.items():
        steps, state = [], None
        for at in sorted(times, key=lambda t: (t is not None, t or START)):
            *_, op, city = max(times[at], key=lambda c: c[:2])
            now = None if op == "D" else (op, city)
            if now != state:
                steps.append((at, now))
            state = now
        for (at, now), (until, _) in zip(steps, [*steps[1:], (None, None)]):
            if now:
                out.append((*key, now[0], now[1], at, until))
    return sorted(out, key=str)


def shown(history):
    return rows(history.select("id", "part", "op", "city", "valid_from", "valid_to"))


def random_log(rng, n, keys=6):
    """No two different changes of a key agree in time and sequence."""
    data = {}
    for _ in range(n):
        at = rng.choice([None, *[START + timedelta(days=rng.randrange(120), hours=rng.randrange(3)) for _ in range(6)]])
        key = (rng.choice([None, *range(keys)]), rng.choice(["a", None]), at, rng.choice([None, 1, 2]))
        data[key] = (*key, rng.choice(["U", "U", "U", "D"]), rng.choice(["Bonn", "Oslo", None]))
    return list(data.values())


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_history_of_a_log(spark, unit):
    rng = random.Random(unit)
    data = random_log(rng, 300)
    data += rng.sample(data, 40)
    history = history_of(spark, data, slice_by=unit)
    assert shown(history) == plain(data)
    assert history.select("scd_id").distinct().count() == history.count()


def test_the_history_does_not_depend_on_batches(spark):
    rng = random.Random(9)
    data = random_log(rng, 120)
    want = plain(data)
    for _ in range(3):
        batches = [[] for _ in range(3)]
        for row in data:
            batches[rng.randrange(3)].append(row)
        batches.append(rng.sample(data, 10))  # some come twice
        log, history = log_of(spark, []), history_of(spark, [])
        for batch in batches:
            new = log_of(spark, batch)
            history = snapshots.merge_changes(history, log, new, ["id", "part"], "at", F.col("op") == "D", ["seq"])
            log = log.unionByName(new)
            history = spark.createDataFrame(history.collect(), history.schema)
        assert shown(history) == want


def test_a_hot_key_is_ordered_by_slices(spark):
    data = [(1, "a", START + timedelta(hours=k), 1, "U", f"c{k // 5 % 7}") for k in range(3000)]
    history = history_of(spark, data, slice_by="day")
    assert shown(history) == plain(data) and history.count() == 600
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_equal_changes_at_one_time_and_deletion_of_nothing(spark):
    day = timedelta(days=1)
    data = [(1, "a", START, 1, "D", "x"), (1, "a", START + day, 1, "U", "Bonn"), (1, "a", START + day, 1, "U", "Bonn")]
    data += [(1, "a", START + 2 * day, 1, "U", "Bonn"), (1, "a", START + 3 * day, 1, "D", None), (1, "a", START + 4 * day, 1, "D", None)]
    assert shown(history_of(spark, data)) == [(1, "a", "U", "Bonn", START + day, START + 3 * day)]
    assert shown(history_of(spark, [])) == []


def test_returning_keys_do_not_overlap(spark):
    """A key closed by deletion and seen again with its old time; an open version without a time."""
    schema = "id long, city string, updated_at timestamp"
    at = lambda d: datetime(2024, 1, d)
    look = lambda data: spark.createDataFrame(data, schema)
    literal = lambda d: F.lit(f"2024-01-{d:02d} 00:00:00").cast("timestamp")
    history = snapshots.first_snapshot(look([(1, "Bonn", at(5)), (2, "Rome", None)]), ["id"], F.col("updated_at"))
    options = {"updated_at": "updated_at", "close_deleted": True}
    history = snapshots.snapshot(history, look([(2, "Oslo", at(7))]), ["id"], literal(10), **options)
    history = snapshots.snapshot(history, look([(1, "Bonn", at(5)), (2, "Oslo", at(7))]), ["id"], literal(12), **options)
    got = rows(history.select("id", "city", "valid_from", "valid_to"))
    assert got == sorted(
        [(1, "Bonn", at(5), at(10)), (1, "Bonn", at(10), None), (2, "Rome", None, at(7)), (2, "Oslo", at(7), None)], key=str
    )
    assert history.select("scd_id").distinct().count() == 4
