"""Keys made from column values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over the columns' text, each behind its length, so that no two rows give one text.

    A NULL and an empty string hash differently.
    """
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.sha2(F.concat(*parts), 256)
