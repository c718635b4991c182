"""Rows computed from the partitions of a table, each marked with the load it was computed from.

A load of the base table and of what is derived from it are two moments. Rows of a derived partition
count only while the base partition is still the one they were computed from, so a job that dies in
between leaves no wrong rows, only partitions to be derived anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.partitioned import PartitionedTable

PART, OF_LOAD = "part", "of_load"


def listed(column: str, parts: Iterable[str | None], kind: T.DataType) -> F.Column:
    """Whether a partition column has one of the values that a manifest names, NULL among them."""
    parts = list(parts)
    found = F.col(column).isin([F.lit(p).cast(kind) for p in parts if p is not None])
    return F.coalesce(found, F.lit(False)) | F.col(column).isNull() if None in parts else found


class DerivedTable:
    """What ``derive`` makes of a partition's rows; it keeps the column ``part`` and adds its own."""

    def __init__(self, base: PartitionedTable, path: str, derive: Callable[[DataFrame], DataFrame]):
        self.base, self.derive = base, derive
        self.table = PartitionedTable(base.spark, path, PART)
        self._known: dict[str, T.StructType] = {}

    def _schema(self, of_base: T.StructType) -> T.StructType:
        if (name := of_base.json()) not in self._known:
            rows = self.base.spark.createDataFrame([], of_base)
            derived = self.derive(rows.withColumn(PART, F.lit("")))
            fields = [f for f in derived.schema if f.name != PART]
            self._known[name] = T.StructType(fields).add(OF_LOAD, "string").add(PART, "string")
        return self._known[name]

    def current(self, schema: T.StructType) -> tuple[DataFrame, list[str | None]]:
        """The rows that still count, and the base's partitions without any.

        ``schema`` is that of the base; one row per partition comes to the driver.
        """
        loads = self.base.loads()
        rows = self.table.read(self._schema(schema))
        known = {tuple(r) for r in rows.select(PART, OF_LOAD).distinct().collect()}
        stale = [part for part, load in loads.items() if (part, load) not in known]
        by_load: dict[str, list] = {}
        for part, load in loads.items():
            if part not in stale:
                by_load.setdefault(load, []).append(part)
        valid = F.lit(False)
        for load, parts in by_load.items():
            valid = valid | ((F.col(OF_LOAD) == load) & listed(PART, parts, T.StringType()))
        return rows.where(valid).drop(OF_LOAD), stale

    def refresh(self, schema: T.StructType, parts: Sequence[str | None], rows: DataFrame | None = None) -> None:
        """Derive the named partitions anew, from the base or take ``rows`` for them; drop those that are gone."""
        loads = self.base.loads()
        here = [p for p in parts if p in loads]
        name = self.base.partition
        if rows is None:
            source = self.base.read(schema).where(listed(name, here, schema[name].dataType))
            rows = self.derive(source.withColumn(PART, F.col(name).cast("string")))
        of = F.lit(None).cast("string")
        for part in here:
            of = F.when(F.col(PART).eqNullSafe(F.lit(part)), loads[part]).otherwise(of)
        columns = [f.name for f in self._schema(schema)]
        self.table.replace(rows.withColumn(OF_LOAD, of).select(*columns), parts)
