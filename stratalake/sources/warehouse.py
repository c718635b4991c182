"""Layered tables on plain Parquet in the session catalog.

Every write makes a new generation table; a view carries the public name and is repointed
once the generation is complete. Only appends add to a generation that is public already. Readers see the old rows or the new rows,
never a mixture; a job that dies leaves the public name untouched; and publishing an
audited table moves no data.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from stratalake.session import shared_root


_DEPRECATED = "deprecation_date"
_GENERATION = "generation"
_VERSION = "version"


class Warehouse:
    """Databases (one per layer) under the shared folder.

    ``namespace`` is put before each layer's name, for trial builds next to the real one;
    without it a layer's name is used as it is.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, namespace: str = ""):
        self.spark = spark
        self.root = (root or f"{shared_root(spark)}/warehouse").rstrip("/")
        self.namespace = namespace
        self._known: set[str] = set()

    def database(self, layer: str) -> str:
        name = f"{self.namespace}{layer}"
        if name not in self._known:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{self.root}/{name}'")
            self._known.add(name)
        return name

    def relation(self, layer: str, name: str, version: int | None = None) -> str:
        """Public name: ``layer.name`` resolves to the latest version, ``name_v2`` is pinned."""
        suffix = "" if version is None else f"_v{version}"
        return f"`{self.database(layer)}`.`{name}{suffix}`"

    def write_generation(
        self,
        rows: DataFrame,
        layer: str,
        name: str,
        version: int | None = None,
        partition_by: Sequence[str] = (),
    ) -> str:
        """Write rows to a new generation that no public name points to yet.

        Partitioned writes are rebalanced on the partition columns: small partitions share
        a task and a large one is split over several, so file sizes stay even.
        """
        suffix = "" if version is None else f"_v{version}"
        stamp = f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
        generation = f"`{self.database(layer)}`.`{name}{suffix}__{stamp}`"
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        writer = rows.write.format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(generation)
        return generation

    def publish(
        self,
        generation: str,
        layer: str,
        name: str,
        version: int | None = None,
        latest_version: int | None = None,
        deprecated_on: date | None = None,
    ) -> None:
        """Point the public name at a generation, and the bare name at the latest version.

        ``latest_version`` declares which one that is; undeclared it is the highest
        published so far, whichever was written last.
        """
        public = self.relation(layer, name, version)
        properties = {_GENERATION: generation.replace("`", "")}
        if deprecated_on:
            properties[_DEPRECATED] = str(deprecated_on)
        self._point(public, properties, generation)
        if version is None:
            return
        if latest_version is None:
            earlier = self._properties(layer, name, None).get(_VERSION) if self.exists(layer, name) else None
            latest_version = max(version, int(earlier or 0))
        if self.exists(layer, name, latest_version):
            newest = self.relation(layer, name, latest_version)
            self._point(self.relation(layer, name), {_VERSION: str(latest_version)}, newest)

    def _point(self, view: str, properties: dict[str, str], relation: str) -> None:
        listed = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({listed}) AS SELECT * FROM {relation}")

    def overwrite(
        self,
        rows: DataFrame,
        layer: str,
        name: str,
        version: int | None = None,
        partition_by: Sequence[str] = (),
        latest_version: int | None = None,
        deprecated_on: date | None = None,
    ) -> DataFrame:
        """Replace a table's rows (the rows may be computed from the table itself)."""
        generation = self.write_generation(rows, layer, name, version, partition_by)
        self.publish(generation, layer, name, version, latest_version, deprecated_on)
        return self.ref(layer, name, version)

    def append(self, rows: DataFrame, layer: str, name: str) -> None:
        """Add rows to the generation behind a name; the first rows make both."""
        if not self.exists(layer, name):
            self.overwrite(rows, layer, name)
            return
        generation = self._properties(layer, name, None).get(_GENERATION)
        if generation is None:
            raise ValueError(f"{self.relation(layer, name)} stands for a version; append to that")
        rows.write.format("parquet").mode("append").saveAsTable(generation)

    def ref(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """A table by its public name; a version with a deprecation date warns its readers."""
        relation = self.relation(layer, name, version)
        if version is not None and (retired := self.deprecated_on(layer, name, version)):
            warnings.warn(f"{relation} is deprecated as of {retired}", DeprecationWarning, stacklevel=2)
        return self.spark.table(relation)

    def deprecated_on(self, layer: str, name: str, version: int) -> str | None:
        return self._properties(layer, name, version).get(_DEPRECATED)

    def _properties(self, layer: str, name: str, version: int | None) -> dict[str, str]:
        listed = self.spark.sql(f"SHOW TBLPROPERTIES {self.relation(layer, name, version)}").collect()
        return {p.key: p.value for p in listed}

    def exists(self, layer: str, name: str, version: int | None = None) -> bool:
        return self.spark.catalog.tableExists(self.relation(layer, name, version))

    def create_view(self, layer: str, name: str, select: str) -> str:
        """A view in the catalog over public names: it follows every later publish."""
        view = self.relation(layer, name)
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {select}")
        return view

    def as_view(self, rows: DataFrame, name: str) -> DataFrame:
        """Register rows under a session-wide name without writing them."""
        rows.createOrReplaceTempView(name)
        return self.spark.table(name)

    def drop(self, layer: str | None = None) -> None:
        """Drop a layer's database with its tables, or all this object has used; for trial builds."""
        for name in [f"{self.namespace}{layer}"] if layer else sorted(self._known):
            self.spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
            self._known.discard(name)

    def drop_old_generations(self, layer: str, name: str, version: int | None = None, keep: int = 1) -> int:
        """Drop all but the published and the newest ``keep`` generations; returns how many.

        Run it when no reader still uses them and no build is under way.
        """
        suffix = "" if version is None else f"_v{version}"
        database = self.database(layer)
        prefix = f"{name}{suffix}__"
        published = self._properties(layer, name, version)[_GENERATION].split(".")[-1]
        tables = [r.tableName for r in self.spark.sql(f"SHOW TABLES IN `{database}`").collect()]
        generations = sorted(t for t in tables if t.startswith(prefix))
        old = [t for t in generations[: len(generations) - keep] if t != published]
        for table in old:
            self.spark.sql(f"DROP TABLE `{database}`.`{table}`")
        return len(old)
