"""Random data against plain Python."""

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from core_helpers import rows
from pyspark.sql import functions as F

from stratalake.functions import cents_to_money, half_up_ratio, percent_of
from stratalake.operators import compare, incremental, snapshots
from stratalake.plans import gold


def test_ratios_match_decimal_arithmetic(spark):
    rng = random.Random(1)
    cases = [(i, Decimal(rng.randrange(10**rng.randrange(1, 13))) / 100, rng.randrange(0, 10 ** rng.randrange(1, 7)), 0) for i in range(2000)]
    cases = [(i, spent, n, rng.randrange(n + 1)) for i, spent, n, _ in cases]
    frame = spark.createDataFrame(cases, "id int, spent decimal(12,2), n bigint, k bigint")
    found = frame.select("id", half_up_ratio(F.col("spent"), F.col("n"), 2), percent_of(F.col("k"), F.col("n"), 1)).collect()
    for (_, spent, n, k), (_, mean, share) in zip(cases, sorted(found)):
        if n == 0:
            assert mean is None and share is None
        else:
            assert mean == (spent / n).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert share == (Decimal(100 * k) / n).quantize(Decimal("0.1"), ROUND_HALF_UP)


def test_cents(spark):
    cents = [0, 1, 99, 100, 12345, 9999999999, -250]
    frame = spark.createDataFrame([(c,) for c in cents], "cents bigint")
    assert [r[0] for r in frame.select(cents_to_money(F.col("cents"))).collect()] == [Decimal(c) / 100 for c in cents]


def test_latest_purchase(spark):
    rng = random.Random(2)
    start = datetime(2024, 1, 1)
    bought = [
        (i, rng.randrange(40), rng.choice(["A", "B", None]), "m", Decimal(rng.randrange(99)),
         None if rng.random() < 0.1 else start + timedelta(days=rng.randrange(5)))
        for i in range(1000)
    ]
    fact = spark.createDataFrame(bought, "purchase_id int, user_id int, product_make string, product_model string, product_price decimal(10,2), purchased_at timestamp")
    want = {}
    for number, user, make, _, price, at in bought:
        rank = (at is None, at or start, number)
        if user not in want or rank > want[user][0]:
            want[user] = (rank, None if make is None else f"{make} m", price)
    found = {r.user_id: (r.last_product, r.last_product_price) for r in gold.user_last_purchase(fact).collect()}
    assert found == {user: (label, price) for user, (_, label, price) in want.items()}


def states(rng, keys, steps):
    """Successive contents of a small table: rows change, appear and disappear."""
    table = {}
    for step in range(steps):
        for key in range(keys):
            if rng.random() < 0.3:
                table[key] = (rng.choice(["x", "y", None]), step)
            elif rng.random() < 0.1:
                table.pop(key, None)
        yield step, dict(table)


def test_history_over_many_snapshots(spark):
    schema = "id int, value string"
    moment = lambda step: datetime(2024, 1, 1) + timedelta(days=step)
    history, want, open_rows = None, [], {}
    for step, table in states(random.Random(3), 30, 6):
        source = spark.createDataFrame([(k, v) for k, (v, _) in table.items()], schema)
        at = F.lit(str(moment(step))).cast("timestamp")
        if history is None:
            history = snapshots.first_snapshot(source, ["id"], at)
        else:
            history = snapshots.snapshot(history, source, ["id"], at, check_columns=["value"], close_deleted=True)
        for key in list(open_rows):
            if key not in table or table[key][0] != open_rows[key][0]:
                value, since = open_rows.pop(key)
                want.append((key, value, since, moment(step)))
        for key, (value, _) in table.items():
            open_rows.setdefault(key, (value, moment(step)))
    want += [(key, value, since, None) for key, (value, since) in open_rows.items()]
    assert rows(history.select("id", "value", "valid_from", "valid_to")) == sorted(want, key=str)


def test_upsert_and_comparison(spark):
    rng = random.Random(4)
    schema = "k int, v int, t int"
    old = [(k, rng.randrange(5), 0) for k in range(60)]
    new = [(rng.randrange(90), rng.randrange(5), t) for t in range(1, 80)]
    target, delta = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    want = {k: (k, v, t) for k, v, t in old}
    want.update({k: (k, v, t) for k, v, t in new})  # later rows win
    merged = incremental.upsert(target, delta, ["k"], [F.col("t").desc()])
    assert sorted(map(tuple, merged.collect())) == sorted(want.values())

    replaced = {k for k, _, _ in new}
    inserted = incremental.delete_insert(target, delta, ["k"])
    assert sorted(map(tuple, inserted.collect())) == sorted([r for r in old if r[0] not in replaced] + new)

    both = {k for k, _, _ in old}
    status = dict(map(tuple, compare.compare_relations(target.drop("t"), merged.drop("t"), ["k"]).collect()))
    assert status.get("identical", 0) == sum(want[k][1] == v for k, v, _ in old)
    assert status.get("changed", 0) == sum(want[k][1] != v for k, v, _ in old)
    assert status.get("only_in_b", 0) == len(set(want) - both) and "only_in_a" not in status
