"""Incremental loads: high-water mark, upsert, delete+insert, partition overwrite, microbatch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.names import free_name
from stratalake.operators.dedup import latest_per_key
from stratalake.session import materialized
from stratalake.sources.partitioned import PartitionedTable


def _one_of(column: str, values: Sequence) -> Column:
    """Whether a column is one of some literals, NULL among them."""
    found = F.col(column).isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


def rows_after_high_water(source: DataFrame, target: DataFrame, cursor: str) -> DataFrame:
    """Source rows newer than anything in the target; all rows when it is empty.

    The mark is one value, fetched first so that the filter holds a plain literal: it
    reaches the Parquet scan and prunes row groups and partitions.
    """
    mark = target.agg(F.max(cursor)).first()[0]
    return source if mark is None else source.where(F.col(cursor) > F.lit(mark))


class CursorTable:
    """A table that a source with a cursor is copied to, by days; what is there says how far it came.

    The mark is the greatest cursor of the newest day, so rows and mark appear together. A load reads
    the source from ``lookback`` before the mark on, and the rows without a cursor, and adds what the
    table does not have: rows are compared as a whole and counted, so rows at the mark, late rows
    within the lookback, rows without a cursor and repeated rows arrive once each, however the source
    grows between loads. Rows that come later than the lookback are not seen.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, cursor: str, lookback: timedelta, day: str = "load_day"
    ):
        self.cursor, self.lookback, self.day = cursor, lookback, day
        self.columns = schema.names
        self.stored = T.StructType([*schema.fields, T.StructField(day, T.DateType())])
        self.table = PartitionedTable(spark, path, day)

    def read(self) -> DataFrame:
        return self.table.read(self.stored).drop(self.day)

    def mark(self):
        """The greatest cursor so far: only the newest day is read."""
        days = [d for d in self.table.loads() if d is not None]
        if not days:
            return None
        newest = self.table.read(self.stored).where(F.col(self.day) == F.lit(max(days)).cast("date"))
        return newest.agg(F.max(self.cursor)).first()[0]

    def load(self, source: DataFrame) -> int:
        """Add what is new in the source; returns the number of rows."""
        mark, existing = self.mark(), self.table.read(self.stored)
        candidates, known = source.select(*self.columns), existing
        if mark is not None:
            since = mark - self.lookback
            candidates = candidates.where(F.col(self.cursor).isNull() | (F.col(self.cursor) >= F.lit(since)))
            known = existing.where(F.col(self.day).isNull() | (F.col(self.day) >= F.lit(since.date())))
        # Equal rows are counted on both sides; as many are added as the source has more.
        n = free_name("_n", self.columns)
        both = candidates.withColumn(n, F.lit(1)).unionByName(known.drop(self.day).withColumn(n, F.lit(-1)))
        names = [F.col(f"`{c}`") for c in self.columns]
        more = both.groupBy(*names).agg(F.sum(n).alias(n)).where(F.col(n) > 0)
        fresh = more.select(*names, F.explode(F.sequence(F.lit(1), F.col(n))).alias(n)).drop(n)
        fresh = materialized(fresh.withColumn(self.day, F.to_date(self.cursor)).select(*self.stored.names))
        touched = [r[0] for r in fresh.select(self.day).distinct().collect()]
        if touched:
            self.table.replace(existing.where(_one_of(self.day, touched)).unionByName(fresh), touched)
        return fresh.count()


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row per key of target and delta together.

    A delta row older than what the target has changes nothing, and rows that are equally
    new are told apart by their content: the result does not depend on how rows were
    divided into deltas, in which order these came, or whether one came twice.
    """
    both = target.unionByName(delta)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in both.columns]).desc()
    return latest_per_key(both, keys, [*newest_first, content])


def delete_insert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the delta's keys, plus every row of the delta."""
    replaced = delta.select(*keys).distinct()
    return target.join(replaced, list(keys), "left_anti").unionByName(delta)


def overwrite_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions that occur in ``rows``; the others stay as they are."""
    PartitionedTable(rows.sparkSession, path, partition).replace(rows)


def read_partitions(spark: SparkSession, path: str, partition: str, schema: T.StructType) -> DataFrame:
    """The rows of a partitioned table as its last load left them."""
    return PartitionedTable(spark, path, partition).read(schema)


def upsert_partitions(
    delta: DataFrame, path: str, keys: Sequence[str], newest_first: Sequence[Column], partition: str
) -> None:
    """Upsert into a partitioned table, rewriting only the partitions the delta's keys are in.

    A key may move: the partitions that hold the delta's keys now are looked up (keys and
    partition are all that is read) and rewritten together with those it goes to. The
    values of touched partitions (a calendar's worth for daily partitions) are fetched
    first: as literals they prune the scan, which a join against the delta would not do.
    """
    table = PartitionedTable(delta.sparkSession, path, partition)
    existing = table.read(delta.schema)
    goes_to = delta.select(partition)
    is_in = existing.select(*keys, partition).join(delta.select(*keys).distinct(), list(keys), "left_semi").select(partition)
    touched = [row[0] for row in goes_to.union(is_in).distinct().collect()]
    affected = existing.where(_one_of(partition, touched))
    table.replace(upsert(affected, delta, keys, newest_first), touched)


def day_slice(source: DataFrame, event_time: str, start: date, end: date, lookback: int = 0) -> DataFrame:
    """Rows of the days ``[start - lookback, end)``, filtered on literals."""
    first = F.lit((start - timedelta(days=lookback)).isoformat()).cast("timestamp")
    return source.where((F.col(event_time) >= first) & (F.col(event_time) < F.lit(end.isoformat()).cast("timestamp")))


def microbatch(
    source: DataFrame,
    path: str,
    event_time: str,
    start: date,
    end: date,
    lookback: int = 3,
    day: str = "event_day",
    unique_key: Sequence[str] = (),
    newest_first: Sequence[Column] = (),
    isolate: bool = False,
) -> None:
    """Recompute the daily partitions ``[start - lookback, end)`` from the source.

    The lookback picks up rows that arrived after their day was first loaded; a day
    without source rows becomes empty, and days outside the range keep their files. With
    ``unique_key`` only the newest row of each key is kept, and rows of these keys on
    other days are taken out. All days of the range are one job and appear together;
    ``isolate`` loads each for itself, so that a failing day leaves those before it loaded.
    """
    days = [start - timedelta(days=lookback) + timedelta(days=k) for k in range((end - start).days + lookback)]
    for batch in [[d] for d in days] if isolate else [days]:
        rows = day_slice(source, event_time, batch[0], batch[-1] + timedelta(days=1)).withColumn(day, F.to_date(event_time))
        _load_days(rows, path, day, batch, unique_key, newest_first)


def _load_days(
    rows: DataFrame, path: str, day: str, days: Sequence[date], unique_key: Sequence[str], newest_first: Sequence[Column]
) -> None:
    table = PartitionedTable(rows.sparkSession, path, day)
    if not unique_key:
        return table.replace(rows, days)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).desc()
    rows = latest_per_key(rows, unique_key, [*newest_first, content])
    elsewhere = table.read(rows.schema).where(~F.coalesce(_one_of(day, days), F.lit(False)))
    keys = rows.select(*unique_key).distinct()
    moved = [r[0] for r in elsewhere.join(keys, list(unique_key), "left_semi").select(day).distinct().collect()]
    others = elsewhere.where(_one_of(day, moved)).join(keys, list(unique_key), "left_anti")
    return table.replace(rows.unionByName(others), [*days, *moved])


class SchemaChanged(ValueError):
    """The incoming columns differ and the policy is to fail."""


def evolve_schema(
    target: DataFrame, incoming: DataFrame, on_schema_change: str = "fail", widen: Sequence[str] = ()
) -> DataFrame:
    """Target rows followed by incoming rows under one schema.

    ``ignore`` keeps the target's columns, ``append_new_columns`` adds the new ones (NULL
    in old rows), ``sync_all_columns`` also drops those no longer delivered, and ``fail``
    raises :class:`SchemaChanged` on any difference. A column whose type has changed
    raises under every policy, unless ``widen`` names it: then both sides are cast to the
    incoming type.
    """
    old, new = ({f.name: f.dataType for f in frame.schema} for frame in (target, incoming))
    retyped = [c for c in old if c in new and old[c] != new[c] and c not in widen]
    added, removed = [c for c in new if c not in old], [c for c in old if c not in new]
    if retyped or on_schema_change == "fail" and (added or removed):
        raise SchemaChanged(f"added {added}, removed {removed}, of another type {retyped}")
    target = target.withColumns({c: F.col(f"`{c}`").cast(new[c]) for c in widen if c in old and c in new})
    if on_schema_change == "fail":
        return target.unionByName(incoming)
    if on_schema_change == "ignore":
        return target.unionByName(incoming.drop(*added), allowMissingColumns=True)
    if on_schema_change == "append_new_columns":
        return target.unionByName(incoming, allowMissingColumns=True)
    if on_schema_change == "sync_all_columns":
        return target.drop(*removed).unionByName(incoming, allowMissingColumns=True)
    raise ValueError(on_schema_change)


def versioned_projection(rows: DataFrame, exclude: Sequence[str] = (), include: Sequence[str] | None = None) -> DataFrame:
    """The columns one version of a model shows: all or ``include``, without ``exclude``."""
    columns = rows.columns if include is None else list(include)
    return rows.select(*[c for c in columns if c not in set(exclude)])
