"""The raw layer: JSON records in a fixed three-column envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = "record_id string, data string, emitted_at timestamp"

#: How a payload writes a time; microseconds survive.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

_JSON_OPTIONS = {
    # Absent values are written as explicit nulls.
    "timestampFormat": TIME_FORMAT,
    "ignoreNullFields": "false",
}


def to_envelope(
    records: DataFrame, emitted_at: Column | None = None, random_ids: bool = False
) -> DataFrame:
    """Wrap typed records as raw envelope rows.

    ``record_id`` is by default the SHA-256 of the payload, so re-running a lost task
    gives the same row; ``random_ids`` asks for random identifiers instead.
    """
    payload = records.select(F.to_json(F.struct("*"), _JSON_OPTIONS).alias("data"))
    return with_envelope_defaults(payload, emitted_at, random_ids)


def with_envelope_defaults(
    payload: DataFrame, emitted_at: Column | None = None, random_ids: bool = False
) -> DataFrame:
    """Fill the record id and the emission time of rows that only carry ``data``."""
    record_id = F.expr("uuid()") if random_ids else F.sha2("data", 256)
    emitted = F.current_timestamp() if emitted_at is None else emitted_at
    return payload.select(
        record_id.alias("record_id"), "data", emitted.cast("timestamp").alias("emitted_at")
    )


def read_envelope(
    table: DataFrame, record_id: str, data: str, emitted_at: str
) -> DataFrame:
    """Map a loader's own envelope column names onto ours."""
    return table.select(
        F.col(record_id).alias("record_id"),
        F.col(data).alias("data"),
        F.col(emitted_at).alias("emitted_at"),
    )


def discover_schema(raw: DataFrame) -> DataFrame:
    """One row per payload field: merged type, rows carrying it, null values.

    Fields of nested objects follow as ``object.field``; what lies deeper is in the type of
    these. Each row is exploded into its own few fields in one pass; per-field types merge
    in a partial and a final aggregate, so only field names are shuffled.
    """
    tvf = raw.sparkSession.tvf
    documents = raw.where(F.col("data").isNotNull()).select(F.parse_json("data").alias("doc"))
    fields = documents.lateralJoin(tvf.variant_explode(F.col("doc").outer())).select(
        F.col("key").alias("field"), F.col("value").alias("content")
    )
    nested = fields.lateralJoin(tvf.variant_explode_outer(F.col("content").outer()))
    first = F.coalesce(F.col("pos") == 0, F.lit(True))  # the field itself counts once
    inner = F.struct(F.concat_ws(".", "field", "key").alias("field_name"), F.col("value"))
    entries = F.array(
        F.when(first, F.struct(F.col("field").alias("field_name"), F.col("content").alias("value"))),
        F.when(F.col("key").isNotNull(), inner),
    )
    return (
        nested.select(F.explode(F.array_compact(entries)).alias("e"))
        .groupBy(F.col("e.field_name").alias("field_name"))
        .agg(
            F.schema_of_variant_agg("e.value").alias("field_type"),
            F.count("*").alias("records"),
            F.count_if(F.is_variant_null("e.value")).alias("null_values"),
        )
    )
