"""Values and names inside SQL text."""

from __future__ import annotations


def literal(value: str | None) -> str:
    """A string as a SQL literal, whatever it contains."""
    if value is None:
        return "CAST(NULL AS STRING)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def quoted(name: str) -> str:
    """A column name in backticks, whatever it contains."""
    return f"`{name.replace('`', '``')}`"
