"""Aggregates per group that follow changes of their rows instead of being computed anew.

The rows are a partitioned table, divided by a hash of the group, with a summary of their keys beside
it; the aggregates are a table derived from it, a partition of one per partition of the other. A load
of changes finds the rows that it replaces by the key summary, and adds to each group what comes and
takes away what goes: counts and sums merge. A smallest or largest value merges too, unless the
group's present one is taken away; such groups, and only those, are computed from their rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.dedup import latest_per_key
from stratalake.operators.key_summary import SummarizedTable
from stratalake.session import materialized
from stratalake.sources.derived import PART, DerivedTable

BUCKET, DELETED, ROWS = "bucket", "deleted", "row_count"


@dataclass(frozen=True)
class Measures:
    """Columns of the rows to be counted (where not NULL), summed, and searched for the least and greatest.

    A sum of no value is NULL; next to it the number of values is kept, so that the last one can go.
    """

    counts: tuple[str, ...] = ()
    sums: tuple[str, ...] = ()
    least: tuple[str, ...] = ()
    greatest: tuple[str, ...] = ()

    def _signed(self, sign: Column) -> list[Column]:
        """Counts and sums of rows that come (1) or go (-1)."""
        counted = dict.fromkeys((*self.counts, *self.sums))
        return [
            F.sum(sign).cast("long").alias(ROWS),
            *[F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).cast("long").alias(f"count_{c}") for c in counted],
            *[F.sum(F.col(c) * sign).alias(f"sum_{c}") for c in self.sums],
        ]

    def of(self, rows: DataFrame, by: Sequence[str]) -> DataFrame:
        """The aggregates from the rows themselves."""
        extremes = [F.min(c).alias(f"min_{c}") for c in self.least] + [F.max(c).alias(f"max_{c}") for c in self.greatest]
        return rows.groupBy(*by).agg(*self._signed(F.lit(1)), *extremes)

    def change(self, old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
        """Per group what is added, and the extremes of what comes (``in_``) and of what goes (``out_``)."""
        both = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))
        sides = [("in", F.col("_sign") == 1), ("out", F.col("_sign") == -1)]
        extremes = [F.min(F.when(on, F.col(c))).alias(f"{s}_min_{c}") for s, on in sides for c in self.least]
        extremes += [F.max(F.when(on, F.col(c))).alias(f"{s}_max_{c}") for s, on in sides for c in self.greatest]
        return both.groupBy(*by).agg(*self._signed(F.col("_sign")), *extremes)


class MaintainedAggregates:
    """``measures`` per ``group`` of the rows with unique ``keys`` under ``path``.

    ``schema`` is that of the rows. Groups without rows have no aggregates.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        group: Sequence[str],
        measures: Measures,
        buckets: int = 64,
    ):
        self.schema, self.keys, self.group, self.measures, self.buckets = schema, list(keys), list(group), measures, buckets
        self.stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        self.rows = SummarizedTable(spark, path, keys, BUCKET, self.stored)
        self.state = DerivedTable(self.rows.table, f"{path}/aggregates", self._derive)

    def _derive(self, rows: DataFrame) -> DataFrame:
        return self.measures.of(rows, [PART, *self.group])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in self.group]), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        """The aggregates of every group."""
        current, stale = self.state.current(self.stored)
        rows = self.rows.of(stale).withColumn(PART, F.col(BUCKET).cast("string"))
        return (current.unionByName(self._derive(rows)) if stale else current).drop(PART)

    def load(self, changes: DataFrame, newest_first: Sequence[Column]) -> dict[str, int]:
        """Apply changes: rows of the table's columns with ``deleted``; the newest change of a key counts.

        Returns how many buckets there are, were searched for replaced rows, and were computed from
        their rows again for a lost extreme.
        """
        change = materialized(latest_per_key(changes, self.keys, newest_first).withColumn(BUCKET, self._bucket()))
        current, stale = self.state.current(self.stored)
        current = materialized(current)
        wanted = change.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(self.keys)])
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(self.keys)]
        candidates = self.rows.candidates(change)
        old = materialized(self.rows.of(candidates).join(wanted, same, "left_semi"))
        new = change.where(~F.coalesce(F.col(DELETED), F.lit(False))).select(*self.stored.names)
        touched = [str(r[0]) for r in old.select(BUCKET).union(new.select(BUCKET)).distinct().collect()]
        if not touched:
            return {"buckets": len(self.rows.table.loads()), "searched": len(candidates), "recomputed": 0}

        kept = self.rows.of(touched).join(wanted, same, "left_anti")
        self.rows.replace(kept.unionByName(new), [int(b) for b in touched])

        by = [PART, *self.group]
        with_part = [f.withColumn(PART, F.col(BUCKET).cast("string")) for f in (old, new)]
        merged, lost = self._merged(current.where(F.col(PART).isin(touched)), self.measures.change(*with_part, by))
        merged = materialized(merged)
        again = [r[0] for r in merged.where(lost).select(PART).distinct().collect()]
        groups = merged.where(lost).select(*[F.col(f"`{c}`").alias(f"_group_{i}") for i, c in enumerate(self.group)])
        of_group = [F.col(f"`{c}`").eqNullSafe(F.col(f"_group_{i}")) for i, c in enumerate(self.group)]
        rows = self.rows.of(again).withColumn(PART, F.col(BUCKET).cast("string"))
        whole = self._derive(rows.join(groups, of_group, "left_semi"))
        aggregates = merged.where(~lost & (F.col(ROWS) > 0)).select(*whole.columns).unionByName(whole)
        merging = [b for b in touched if b not in stale]
        self.state.refresh(self.stored, merging, aggregates.where(F.col(PART).isin(merging)))
        if rest := [b for b in stale if b is not None]:
            self.state.refresh(self.stored, rest)
        return {"buckets": len(self.rows.table.loads()), "searched": len(candidates), "recomputed": len(again)}

    def _merged(self, state: DataFrame, change: DataFrame) -> tuple[DataFrame, Column]:
        """Aggregates with the change merged in, and the condition on groups that lost an extreme."""
        by, m = [PART, *self.group], self.measures
        old, new = (f.select(F.struct(*by).alias(f"{s}_key"), F.struct("*").alias(s)) for s, f in (("o", state), ("n", change)))
        joined = old.join(new, F.col("o_key").eqNullSafe(F.col("n_key")), "full_outer")

        def added(name: str) -> Column:
            return F.coalesce(F.col(f"o.{name}"), F.lit(0)) + F.coalesce(F.col(f"n.{name}"), F.lit(0))

        counts = {name: added(name) for name in [ROWS, *[f"count_{c}" for c in dict.fromkeys((*m.counts, *m.sums))]]}
        sums = {
            f"sum_{c}": F.when(counts[f"count_{c}"] > 0, added(f"sum_{c}").cast(state.schema[f"sum_{c}"].dataType))
            for c in m.sums
        }
        least = {f"min_{c}": F.least(f"o.min_{c}", f"n.in_min_{c}") for c in m.least}
        greatest = {f"max_{c}": F.greatest(f"o.max_{c}", f"n.in_max_{c}") for c in m.greatest}
        gone = [F.col(f"n.out_min_{c}") <= F.col(f"o.min_{c}") for c in m.least]
        gone += [F.col(f"n.out_max_{c}") >= F.col(f"o.max_{c}") for c in m.greatest]
        lost = F.lit(False)
        for condition in gone:
            lost = lost | F.coalesce(condition, F.lit(False))
        key = F.coalesce("o_key", "n_key")
        columns = {**{c: key[c] for c in by}, **counts, **sums, **least, **greatest}
        merged = joined.select(*[v.alias(k) for k, v in columns.items()], (lost & (counts[ROWS] > 0)).alias("_lost"))
        return merged, F.col("_lost")
