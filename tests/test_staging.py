from decimal import Decimal

import pytest
from core_helpers import ts
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.functions import surrogate_key, text_struct
from stratalake.plans import staging
from stratalake.sources import synthetic
from stratalake.sources.envelope import discover_schema, read_envelope, to_envelope, with_envelope_defaults


def raw(spark, *payloads):
    return spark.createDataFrame([("r", p, ts("2024-02-01 00:00:00")) for p in payloads], "record_id string, data string, emitted_at timestamp")


def product(spark, payload):
    return staging.stg_products(raw(spark, payload)).first()


def test_typed_fields(spark):
    row = product(spark, '{"id": 7, "make": "M", "model": "X", "year": 2024, "price": 42990.00, "created_at": "2024-01-15T10:00:00Z"}')
    assert tuple(row) == (7, "M", "X", 2024, Decimal("42990.00"), ts("2024-01-15 10:00:00"), ts("2024-02-01 00:00:00"))


def test_numbers_as_strings_nulls_missing_and_unknown_keys(spark):
    row = product(spark, '{"id": "7", "price": "12.345", "make": null, "extra": [1, 2]}')
    assert (row.product_id, row.price, row.make, row.year) == (7, Decimal("12.35"), None, None)


def test_last_of_repeated_keys_wins(spark):
    assert product(spark, '{"id": 1, "id": 2}').product_id == 2


def test_long_decimals_keep_their_digits(spark):
    assert product(spark, '{"id": 123456789012345678, "price": 12345678.12}').price == Decimal("12345678.12")


def test_offsets_are_converted_to_utc(spark):
    row = product(spark, '{"id": 1, "created_at": "2024-01-15T10:00:00+02:00"}')
    assert row.created_at == ts("2024-01-15 08:00:00")


def test_nested_fields_of_a_scalar_are_null(spark):
    row = staging.stg_users(raw(spark, '{"id": 1, "address": "unknown"}')).first()
    assert (row.user_id, row.city, row.postal_code) == (1, None, None)


@pytest.mark.parametrize("payload", ["[1, 2]", "3", '"text"', None])
def test_a_payload_that_is_no_object_has_no_fields(spark, payload):
    row = staging.stg_products(raw(spark, payload)).first()
    assert tuple(row)[:-1] == (None,) * 6 and row.loaded_at == ts("2024-02-01 00:00:00")


def test_values_of_other_kinds_are_kept_as_text(spark):
    row = staging.stg_products(raw(spark, '{"make": {"a": [1, "x"]}, "model": true}')).first()
    assert (row.make, row.model) == ('{"a":[1,"x"]}', "true")


def test_paths_make_one_struct_type():
    assert text_struct(["id", "a.b", "a.c.d", "z"]) == "struct<`id`: string, `a`: struct<`b`: string, `c`: struct<`d`: string>>, `z`: string>"
    with pytest.raises(ValueError, match="both"):
        text_struct(["a", "a.b"])


@pytest.mark.parametrize(
    "payload",
    ['{"id": "abc"}', '{"id": 1, "year": 2024.6}', '{"id": 1, "price": 123456789.00}', '{"id": 1, "created_at": "soon"}', '{"id": '],
)
def test_bad_values_raise(spark, payload):
    with pytest.raises((PySparkException, Py4JJavaError)):  # a malformed document is not converted
        staging.stg_products(raw(spark, payload)).collect()


def test_bad_values_can_be_quarantined_instead(spark):
    payloads = ['{"id": 1, "year": 2024}', '{"id": "abc", "price": "x", "year": 2024}', '{"id": ', None]
    found = staging.stage_with_errors(raw(spark, *payloads), staging.PRODUCT_FIELDS).select("product_id", "year", "errors", "data").collect()
    by_payload = {r.data: (r.product_id, r.year, r.errors) for r in found}
    assert by_payload[payloads[0]] == (1, 2024, [])
    assert by_payload[payloads[1]] == (None, 2024, ["product_id", "price"])
    assert by_payload[payloads[2]] == (None, None, ["data"])
    assert by_payload[None] == (None, None, [])


def test_envelope_round_trip(spark):
    records = spark.createDataFrame(
        [(1, None, Decimal("0.10"), ts("2024-01-01 10:20:30.123456"))], "id bigint, make string, price decimal(10,2), created_at timestamp"
    )
    row = staging.stg_products(to_envelope(records)).first()
    assert (row.product_id, row.make, row.price, row.created_at) == (1, None, Decimal("0.10"), ts("2024-01-01 10:20:30.123456"))
    assert to_envelope(records).first().record_id == to_envelope(records).first().record_id
    ids = with_envelope_defaults(records.select(F.lit("{}").alias("data")).union(records.select(F.lit("{}"))), random_ids=True)
    assert len({r.record_id for r in ids.collect()}) == 2


def test_foreign_envelope_columns(spark):
    loaded = spark.createDataFrame([("a", "{}", ts("2024-01-01 00:00:00"))], "_id string, _payload string, _loaded timestamp")
    assert read_envelope(loaded, "_id", "_payload", "_loaded").columns == ["record_id", "data", "emitted_at"]


def test_schema_discovery_merges_types(spark):
    found = {r.field_name: (r.field_type, r.records, r.null_values) for r in discover_schema(raw(spark, '{"a": 1, "b": null}', '{"a": 2, "b": "x"}', '{"c": {"d": true}}')).collect()}
    assert found == {"a": ("BIGINT", 2, 0), "b": ("STRING", 2, 1), "c": ("OBJECT<d: BOOLEAN>", 1, 0), "c.d": ("BOOLEAN", 1, 0)}


def test_generated_rows_do_not_depend_on_partitioning(spark):
    def everything(**options):
        streams = synthetic.synthetic_raw(spark, 500, emitted_at=F.lit("2024-01-01"), **options)
        return {name: sorted(r.data for r in rows.collect()) for name, rows in streams.items()}

    assert everything(parallelism=1) == everything(parallelism=7) == everything(records_per_slice=64)
    assert everything(seed=1) != everything(seed=2)
    assert synthetic.ids(spark, 1000, records_per_slice=300).rdd.getNumPartitions() == 4


def test_surrogate_key_tells_null_from_empty(spark):
    keys = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None), ("a|=b", None), ("a", "b")], "x string, y string").select(surrogate_key(["x", "y"]).alias("k"))
    assert keys.distinct().count() == 5
