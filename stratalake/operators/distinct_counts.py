"""Distinct counts over any span of days, from sketches kept per day instead of the rows.

Beside a table with a partition per day there is one row per day and group with a theta sketch of every
counted column. A count over a span merges the sketches of its days, so no value is shuffled and no
row of an earlier day is read again; only days loaded since are sketched. Sketches also intersect, which
tells how many values of a span were there in another one.

A span of fewer than ``2 ** lg_k`` different values is counted exactly. Beyond that a count is off by less than
``relative_error(lg_k)`` times the count in 99.7 % of all cases. An intersection of ``m`` spans that together have
``u`` values is off by about that share of ``sqrt(u * intersection)``, so small ones of large spans are rough.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.derived import PART, DerivedTable
from stratalake.sources.partitioned import PartitionedTable

LG_K = 14
ROWS = "row_count"


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """How far a count of more than ``2 ** lg_k`` values may be off, as a share of it."""
    return deviations / (2**lg_k - 1) ** 0.5


def sketch(column: str, lg_k: int = LG_K) -> Column:
    """Sketch of a column's values; NULL is none.

    Values enter by a 64-bit hash of their type, so that the empty text is a value like any other and every
    type but maps can be counted. Zero and negative zero are one value.
    """
    value = F.col(f"`{column}`")
    return F.theta_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), lg_k)


class DistinctCounts:
    """Different values of ``columns`` per day and ``by`` in a table with a date partition.

    ``schema`` is that of the table; ``path`` is where the sketches go. Rows without a day belong to no span.
    Groups are told apart by all of ``by``, NULL being a group. A day's sketches count only while the table has the rows
    that they were made from, so a job that dies between a load and :meth:`refresh` costs time, not results.
    """

    def __init__(
        self,
        table: PartitionedTable,
        path: str,
        schema: T.StructType,
        columns: Sequence[str],
        by: Sequence[str] = (),
        lg_k: int = LG_K,
    ):
        self.table, self.schema, self.columns, self.by, self.lg_k = table, schema, list(columns), list(by), lg_k
        self.state = DerivedTable(table, path, self._derive)

    def _derive(self, rows: DataFrame) -> DataFrame:
        counted = [sketch(c, self.lg_k).alias(f"sketch_{c}") for c in self.columns]
        return rows.groupBy(PART, *[F.col(f"`{c}`") for c in self.by]).agg(F.count("*").alias(ROWS), *counted)

    def refresh(self) -> list[str | None]:
        """Sketch the days that were loaded since, and return them."""
        stale = self.state.current(self.schema)[1]
        loaded = self.table.loads()
        gone = {r[0] for r in self.state.table.read(self.state._schema(self.schema)).select(PART).distinct().collect()}
        if changed := sorted({*stale, *(p for p in gone if p not in loaded)}, key=str):
            self.state.refresh(self.schema, changed)
        return stale

    def daily(self) -> DataFrame:
        """``day``, ``by``, number of rows and sketches; days not yet sketched are computed from their rows."""
        current, stale = self.state.current(self.schema)
        if stale:
            name = self.table.partition
            days = [F.lit(p).cast(self.schema[name].dataType) for p in stale if p is not None]
            rows = self.table.read(self.schema).where(F.col(name).isin(days))
            current = current.unionByName(self._derive(rows.withColumn(PART, F.col(name).cast("string"))))
        day = F.col(PART).cast("date").alias("day")
        sketches = [f"sketch_{c}" for c in self.columns]
        return current.where(F.col(PART).isNotNull()).select(day, *[f"`{c}`" for c in self.by], ROWS, *sketches)

    def _merged(self) -> list[Column]:
        return [F.theta_union_agg(f"sketch_{c}", self.lg_k).alias(f"sketch_{c}") for c in self.columns]

    def _counted(self) -> list[Column]:
        return [F.theta_sketch_estimate(f"sketch_{c}").alias(f"distinct_{c}") for c in self.columns]

    def between(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """``by``, number of rows and ``distinct_`` counts of the days from ``first`` to ``last``, both included."""
        days = self.daily()
        if first is not None:
            days = days.where(F.col("day") >= F.lit(first))
        if last is not None:
            days = days.where(F.col("day") <= F.lit(last))
        keys = [F.col(f"`{c}`") for c in self.by]
        return days.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS), *self._merged()).select(*keys, ROWS, *self._counted())

    def rolling(self, days: int = 7) -> DataFrame:
        """Counts of the ``days`` days up to each day that the table has, per group with rows in them.

        ``kept_`` counts are of the values that were there in the ``days`` days before those, too.
        A sketch goes to each of the spans it is part of, so sketches are shuffled, not values.
        """
        daily = self.daily()
        ends = daily.select("day").distinct()
        keys = [F.col(f"`{c}`") for c in self.by]
        offsets = F.explode(F.sequence(F.lit(0), F.lit(2 * days - 1))).alias("_ahead")
        sent = daily.select("*", offsets).withColumn("_end", F.expr("date_add(day, _ahead)")).drop("day")
        sent = sent.join(ends.withColumnRenamed("day", "_end"), "_end", "left_semi")
        now = F.col("_ahead") < days

        def part(inside: Column, column: str) -> Column:
            return F.theta_union_agg(F.when(inside, F.col(f"sketch_{column}")), self.lg_k)

        spans = sent.groupBy(F.col("_end").alias("day"), *keys).agg(
            F.sum(F.when(now, F.col(ROWS))).alias(ROWS),
            *[part(now, c).alias(f"sketch_{c}") for c in self.columns],
            *[part(~now, c).alias(f"before_{c}") for c in self.columns],
        )
        kept = [
            F.theta_sketch_estimate(F.theta_intersection(f"sketch_{c}", f"before_{c}")).alias(f"kept_{c}")
            for c in self.columns
        ]
        return spans.where(F.col(ROWS).isNotNull()).select("day", *keys, ROWS, *self._counted(), *kept)
