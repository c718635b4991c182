import random
from datetime import datetime, timedelta

from core_helpers import rows

from stratalake.operators.incremental import CursorTable
from stratalake.plans import lineage

START = datetime(2024, 5, 1)
SCHEMA = "id long, at timestamp, _n string"


def copied(spark, folder, days=5):
    schema = spark.createDataFrame([], SCHEMA).schema
    return CursorTable(spark, str(folder), schema, "at", timedelta(days=days))


def load(spark, table, data):
    return table.load(spark.createDataFrame([(*r, "x") for r in data], SCHEMA))


def shown(data):
    return sorted(((*r, "x") for r in data), key=str)


def test_every_row_arrives_once(spark, tmp_path):
    """Ties at the mark, late rows, rows without a time, repeated rows, in sources that only grow."""
    rng = random.Random(4)
    table, source = copied(spark, tmp_path), []
    for number in range(4):
        newest = START + timedelta(days=3 * number)
        for _ in range(40):
            at = rng.choice([None, newest, newest - timedelta(hours=rng.randrange(100))])
            source.append((rng.randrange(25), at))
        added = load(spark, table, source)
        assert added == 40 and rows(table.read()) == shown(source)
        assert load(spark, table, source) == 0
    assert table.mark() == START + timedelta(days=9)


def test_only_the_lookback_is_compared(spark, tmp_path):
    table = copied(spark, tmp_path, days=2)
    load(spark, table, [(1, START), (2, START + timedelta(days=10))])
    late = [(3, START + timedelta(days=8)), (4, START + timedelta(days=7))]
    assert load(spark, table, [(1, START), (2, START + timedelta(days=10)), *late]) == 1
    assert [r[0] for r in rows(table.read())] == [1, 2, 3]


def test_empty_source_and_no_times(spark, tmp_path):
    table = copied(spark, tmp_path)
    assert load(spark, table, []) == 0 and table.mark() is None and rows(table.read()) == []
    assert load(spark, table, [(1, None)] * 3) == 3 and load(spark, table, [(1, None)] * 4) == 1
    assert rows(table.read()) == shown([(1, None)] * 4)


def test_models_that_no_consumer_reaches(spark):
    edges = [("a", "b"), ("b", "c"), ("d", "e"), ("e", "d"), ("f", "d"), ("g", "f"), ("c", "a"), ("h", None), (None, "c")]
    models = spark.createDataFrame([(m,) for m in "abcdefghi"], "name string")
    frame = spark.createDataFrame(edges, "upstream string, downstream string")
    consumers = spark.createDataFrame([("c",), ("i",), (None,), ("none",)], "model string")
    unreached = [r[0] for r in lineage.unreached_models(models, frame, consumers).collect()]
    # d and e read each other, and f and g are read by them alone.
    assert unreached == ["d", "e", "f", "g", "h"]
    assert [r[0] for r in lineage.unused_models(models, frame, consumers).collect()] == []
    assert lineage.unreached_models(models, frame, consumers.limit(0)).count() == 9
