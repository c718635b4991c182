"""Names of columns."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(name: str, taken: Iterable[str]) -> str:
    """The name, with as many underscores behind it as tell it from those that are taken."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name
