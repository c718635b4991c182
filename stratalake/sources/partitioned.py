"""A partitioned Parquet table whose partitions are replaced together.

A load is written to a folder of its own. A manifest, one small file per load, then says
which load each partition's rows are in; the newest manifest counts. A job that dies before
its manifest is there leaves the table as it was, and readers never see half a load. One
writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.small import small_table

_MANIFEST = "part string, load string"
_LOAD = "__load"


class PartitionedTable:
    """The table under ``path`` with one partition column."""

    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition

    def _listed(self, folder: str) -> list[str]:
        """Names in a folder of the table; none where there is no such folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def _manifest(self) -> tuple[int, dict[str | None, str]]:
        """The newest version and the load of each partition: a row per partition comes to the driver."""
        versions = [int(f.split("=")[1]) for f in self._listed("manifest") if f.startswith("version=")]
        for version in sorted(versions, reverse=True):
            # A job that died while writing has left a folder without a file.
            if any(f.startswith("part-") for f in self._listed(f"manifest/version={version}")):
                rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/version={version}")
                # Every manifest has one row without a load, so that an empty table has a version too.
                return version, {r.part: r.load for r in rows.collect() if r.load}
        return 0, {}

    def loads(self) -> dict[str | None, str]:
        """The load that each partition's rows are in, by the partition's text."""
        return self._manifest()[1]

    def read(self, schema: T.StructType) -> DataFrame:
        """The rows of the newest manifest; none before the first load."""
        loads: dict[str, list] = {}
        for part, load in self._manifest()[1].items():
            loads.setdefault(load, []).append(part)
        if not loads:
            return self.spark.createDataFrame([], schema)
        kind = schema[self.partition].dataType
        condition = F.lit(False)
        for load, parts in loads.items():
            value = F.col(self.partition)
            listed = value.isin([F.lit(p).cast(kind) for p in parts if p is not None])
            if None in parts:
                listed = listed | value.isNull()
            condition = condition | ((F.col(_LOAD) == load) & listed)
        with_load = T.StructType([*schema.fields, T.StructField(_LOAD, T.StringType())])
        rows = self.spark.read.schema(with_load).parquet(f"{self.path}/data")
        return rows.where(condition).select(*[F.col(f"`{name}`") for name in schema.names])

    def replace(self, rows: DataFrame, emptied: Sequence = ()) -> None:
        """Replace the partitions that occur in ``rows``, and those listed even if they do not occur.

        ``rows`` may be computed from the table itself. Small partitions share a task and a
        large one is split over several.
        """
        version, current = self._manifest()
        load = f"{version + 1:08d}_{uuid.uuid4().hex[:8]}"
        folder = f"{self.path}/data/{_LOAD}={load}"
        rows.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder).select(F.col(self.partition).cast("string"))
        new = {r[0]: load for r in written.distinct().collect()}
        gone = {None if v is None else str(v) for v in emptied}
        kept = {part: old for part, old in current.items() if part not in new and part not in gone}
        listed = [(None, None), *(kept | new).items()]
        self._commit(small_table(self.spark, listed, _MANIFEST), version + 1)

    def _commit(self, manifest: DataFrame, version: int) -> None:
        """The moment a load becomes visible: one file appears in the manifest's folder."""
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")

    def drop_superseded(self) -> int:
        """Delete loads that no partition uses any more, and all manifests but the newest.

        Returns how many loads. Run it when nobody reads.
        """
        version, current = self._manifest()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        used = {f"{_LOAD}={load}" for load in current.values()}
        loads = [f"data/{f}" for f in self._listed("data") if f.startswith(f"{_LOAD}=") and f not in used]
        manifests = [f for f in self._listed("manifest") if f.startswith("version=") and int(f.split("=")[1]) < version]
        files = hadoop.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for folder in [f"manifest/{f}" for f in manifests] if version else []:
            files.delete(hadoop.Path(f"{self.path}/{folder}"), True)
        return sum(bool(files.delete(hadoop.Path(f"{self.path}/{folder}"), True)) for folder in loads)
