"""Column expressions shared by the layers."""

from stratalake.functions.json_fields import json_texts, text_struct
from stratalake.functions.numeric import cents_to_money, half_up_ratio, percent_of, zero_if_null
from stratalake.functions.keys import surrogate_key
from stratalake.functions.sql_text import literal, quoted

__all__ = [
    "cents_to_money",
    "half_up_ratio",
    "json_texts",
    "literal",
    "percent_of",
    "quoted",
    "surrogate_key",
    "text_struct",
    "zero_if_null",
]
