"""Fields out of JSON payloads.

All wanted fields of a document are read in one pass, as text, and cast afterwards. So a
number given as a JSON string is accepted, decimals keep every digit (``from_json`` would
render them through a double), JSON null, missing paths and members of a value that is no
object give NULL, and a value that does not fit its type (``2024.6`` as an integer) raises
under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_struct(paths: Sequence[str]) -> str:
    """The struct type with a string at every dotted path."""
    members: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        members.setdefault(head, []).append(rest)
    fields = []
    for name, inner in members.items():
        if "" in inner and len(inner) > 1:
            raise ValueError(f"{name} is wanted both as a value and as an object")
        fields.append(f"`{name}`: {'string' if inner == [''] else text_struct(inner)}")
    return f"struct<{', '.join(fields)}>"


def json_texts(document: str, paths: Sequence[str]) -> Column:
    """A struct with the text at each dotted path of a VARIANT column.

    Any value has a text, so the only thing ``try`` lets pass is a value where an object
    was expected; its members are NULL.
    """
    return F.try_variant_get(document, "$", text_struct(paths))
