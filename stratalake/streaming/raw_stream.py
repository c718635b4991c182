"""Raw records read as a stream, deduplicated and upserted into a daily table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.incremental import upsert_partitions
from stratalake.sources.envelope import ENVELOPE


def raw_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelope rows from the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def deduplicate(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row of each key; a key's state is dropped once ``delay`` has passed."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def upsert_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    partition: str,
) -> StreamingQuery:
    """Upsert every micro-batch into the partitioned table at ``path``.

    Only the partitions a batch touches are rewritten, so late rows update their own day.
    The table is the same however rows fall into batches, and a batch replayed after a
    failure changes nothing; ``read_partitions`` reads it. Processes what is there, then
    stops; the checkpoint lets the next start go on from it.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read by several jobs; recomputed if an executor is lost
        try:
            upsert_partitions(batch, path, keys, newest_first, partition)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
