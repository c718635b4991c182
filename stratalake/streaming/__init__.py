"""The raw layer as a stream."""

from stratalake.streaming.late_rows import LateRowsTable
from stratalake.streaming.raw_stream import deduplicate, raw_stream, upsert_stream

__all__ = ["LateRowsTable", "deduplicate", "raw_stream", "upsert_stream"]
