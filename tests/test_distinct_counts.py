import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from stratalake.operators.distinct_counts import DistinctCounts, relative_error
from stratalake.sources.partitioned import PartitionedTable

START = date(2024, 3, 1)
SCHEMA = "grp string, v string, w double, day date"


def kept_table(spark, folder, data, by=("grp",), columns=("v", "w"), lg_k=14):
    frame = spark.createDataFrame(data, SCHEMA)
    table = PartitionedTable(spark, f"{folder}/rows", "day")
    table.replace(frame)
    return table, DistinctCounts(table, f"{folder}/sketches", frame.schema, columns, by, lg_k)


def sample(seed, n=400, days=12):
    rng = random.Random(seed)
    texts = [None, "", " ", "é", *[f"t{k}" for k in range(30)]]
    return [
        (
            rng.choice(["a", "a", "b", None]),
            rng.choice(texts),
            rng.choice([None, 0.0, -0.0, float("nan"), 1.5, 2.5]),
            rng.choice([None, *[START + timedelta(days=d) for d in range(days) if d not in (3, 4)]]),
        )
        for _ in range(n)
    ]


def distinct(values):
    return len({"nan" if x != x else x for x in values if x is not None})


def brute_rolling(data, days):
    ends = {d for *_, d in data if d is not None}
    out = []
    for end in ends:
        for grp in {g for g, *_ in data}:
            ago = [(v, w, (end - d).days) for g, v, w, d in data if g == grp and d is not None and d <= end]
            now = [(v, w) for v, w, a in ago if a < days]
            if now:
                before = [(v, w) for v, w, a in ago if days <= a < 2 * days]
                sides = [[{"nan" if x[k] != x[k] else x[k] for x in s if x[k] is not None} for s in (now, before)] for k in (0, 1)]
                out.append((end, grp, len(now), *[len(n) for n, _ in sides], *[len(n & b) for n, b in sides]))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_are_exact_where_values_are_few(spark, tmp_path, seed):
    data = sample(seed)
    _, counts = kept_table(spark, tmp_path, data)
    assert rows(counts.rolling(3)) == brute_rolling(data, 3)  # before any sketch is stored
    counts.refresh()
    assert rows(counts.rolling(3)) == brute_rolling(data, 3)
    first, last = START + timedelta(days=2), START + timedelta(days=8)
    inside = [r for r in data if r[3] is not None and first <= r[3] <= last]
    want = [(g, len(own), distinct(v for _, v, *_ in own), distinct(w for _, _, w, _ in own))
            for g in {g for g, *_ in inside} if (own := [r for r in inside if r[0] == g])]
    assert rows(counts.between(first, last)) == sorted(want, key=str)


def test_reports_read_sketches_and_refresh_reads_new_days_only(spark, tmp_path):
    data = sample(5)
    table, counts = kept_table(spark, tmp_path, data)
    assert len(counts.refresh()) == len({d for *_, d in data}) and counts.refresh() == []
    late = START + timedelta(days=2)
    changed = [r for r in data if r[3] == late][:3] + [("c", "new", 9.0, late)]
    for file in Path(f"{tmp_path}/rows/data").rglob("*.parquet"):
        file.unlink()  # a day that is read again would be empty or fail
    table.replace(spark.createDataFrame(changed, SCHEMA))
    now = [r for r in data if r[3] != late] + changed
    assert rows(counts.rolling(4)) == brute_rolling(now, 4)  # the new day is not yet sketched
    assert counts.refresh() == [str(late)]
    assert rows(counts.rolling(4)) == brute_rolling(now, 4)
    table.replace(spark.createDataFrame([], SCHEMA), [late])
    assert counts.refresh() == []
    assert rows(counts.rolling(4)) == brute_rolling([r for r in now if r[3] != late], 4)


def test_sketches_of_replaced_rows_do_not_count(spark, tmp_path):
    """A job that dies between the load and its sketches leaves right counts."""
    data = sample(6)
    table, counts = kept_table(spark, tmp_path, data)
    counts.refresh()
    table.replace(spark.createDataFrame([("a", "only", 1.0, START)], SCHEMA))
    got = counts.between(START, START).collect()
    assert [(r.grp, r.row_count, r.distinct_v) for r in got] == [("a", 1, 1)]


def test_many_values_stay_within_the_stated_error(spark, tmp_path):
    """One group has a third of all rows; spans overlap by half."""
    lg_k, n = 9, 6000
    data = [("hot" if k % 3 == 0 else f"g{k % 2}", f"v{d * n // 2 + k}", 1.0, START + timedelta(days=d)) for d in range(4) for k in range(n)]
    _, counts = kept_table(spark, tmp_path, data, by=(), lg_k=lg_k)
    counts.refresh()
    error = relative_error(lg_k)
    assert 0.1 < error < 0.14
    for r in counts.rolling(1).collect():
        assert abs(r.distinct_v - n) <= error * n and r.distinct_w == 1
        shared = n // 2 if r.day > START else 0
        assert abs(r.kept_v - shared) <= 1.5 * error * (1.5 * n * shared) ** 0.5
    total = counts.between().first()
    assert abs(total.distinct_v - 2.5 * n) <= error * 2.5 * n and total.row_count == 4 * n


@pytest.mark.parametrize("data", [[], [(None, None, None, START)], [("a", "x", 1.0, None)]])
def test_little_or_nothing(spark, tmp_path, data):
    _, counts = kept_table(spark, tmp_path, data)
    counts.refresh()
    got = [(r.row_count, r.distinct_v, r.kept_v) for r in counts.rolling(2).collect()]
    assert got == [(1, 0, 0)] * sum(d is not None for *_, d in data)


def test_values_are_not_shuffled(spark, tmp_path):
    _, counts = kept_table(spark, tmp_path, sample(7))
    plan = counts._derive(counts.table.read(counts.schema).withColumn("part", F.col("day").cast("string")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_theta_sketch" in text and text.count("Exchange") == 1
    counts.refresh()
    assert "/rows/data" not in counts.rolling(2)._jdf.queryExecution().optimizedPlan().toString()
    assert all("/sketches/" in f for f in counts.rolling(2).inputFiles())
