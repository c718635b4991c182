"""A stream upserted by day that keeps its late rows: none is dropped, all are on record."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.key_summary import SummarizedTable
from stratalake.sources.partitioned import PartitionedTable
from stratalake.sources.small import small_table

BATCH = "batch_id"
_LOADS = "row_count long, late_count long, mark timestamp, newest timestamp, batch_id long"


class LateRowsTable:
    """A table upserted from micro-batches, with its late rows and the history of its loads.

    A batch's mark is the newest event time of the batches before it, less ``delay``. Rows behind the
    mark are late: they go to their day like all others, where the newest row of a key stays, and also
    to the table of late rows with the mark that they missed. So the table does not depend on how rows
    fall into batches; which of them count as late does. Rows without an event time are never late.

    Redelivered rows change nothing, by key and content, so nothing has to be dropped by a watermark
    and no state grows. Each batch reads only the partitions whose key summary may hold one of its
    keys. All three tables are written per batch, by its number: a batch that is done again after a
    failure replaces what it left. The stream's checkpoint belongs to the table.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        newest_first: Sequence[Column],
        partition: str,
        event_time: str,
        delay: timedelta,
    ):
        self.spark, self.path, self.event_time, self.delay = spark, path.rstrip("/"), event_time, delay
        self.newest_first = list(newest_first)
        self.rows = SummarizedTable(spark, f"{self.path}/table", keys, partition, schema)
        self.late_schema = T.StructType([*schema.fields]).add("missed_mark", "timestamp").add(BATCH, "long")
        self._late = PartitionedTable(spark, f"{self.path}/late", BATCH)
        self._loads = PartitionedTable(spark, f"{self.path}/loads", BATCH)
        self.loads_schema = small_table(spark, [], _LOADS).schema

    def read(self) -> DataFrame:
        return self.rows.read()

    def late(self) -> DataFrame:
        """Every row that came behind its batch's mark, with ``missed_mark`` and ``batch_id``."""
        return self._late.read(self.late_schema)

    def loads(self) -> DataFrame:
        """A row per batch: how many rows it had, how many of them were late, its mark, its newest event time."""
        return self._loads.read(self.loads_schema)

    def load(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch."""
        newest = self.loads().where(F.col(BATCH) < batch_id).agg(F.max("newest")).first()[0]
        mark = None if newest is None else newest - self.delay
        late = F.lit(False) if mark is None else F.coalesce(F.col(self.event_time) < F.lit(mark), F.lit(False))
        batch = batch.select(*self.rows.schema.names)
        batch.persist()  # read by several jobs; recomputed if an executor is lost
        try:
            counts = batch.agg(F.count("*"), F.count_if(late), F.max(F.col(self.event_time).cast("timestamp"))).first()
            missed = batch.where(late).withColumns({"missed_mark": F.lit(mark).cast("timestamp"), BATCH: F.lit(batch_id).cast("long")})
            self._late.replace(missed.select(*self.late_schema.names), [batch_id])
            self.rows.upsert(batch, self.newest_first)
        finally:
            batch.unpersist()
        self._loads.replace(small_table(self.spark, [(counts[0], counts[1], mark, counts[2], batch_id)], _LOADS), [batch_id])

    def start(self, rows: DataFrame) -> StreamingQuery:
        """Load what has arrived, batch by batch, then stop; the next start goes on from there."""
        return (
            rows.writeStream.foreachBatch(self.load)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
