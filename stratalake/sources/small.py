"""Small driver-side facts (declarations, reports, history rows) as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows as a local relation, handed over through Arrow without a Python task."""
    fields = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], fields)
    columns = list(zip(*rows))
    arrow_types = {"timestamp": pa.timestamp("us", tz="UTC"), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    arrays = [
        pa.array(values, type=arrow_types.get(field.dataType.simpleString(), pa.string()))
        for values, field in zip(columns, fields)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=fields.names), fields)
