"""Column names that a table does not have yet."""

from __future__ import annotations

from collections.abc import Iterable


def free(columns: Iterable[str], *wanted: str) -> list[str]:
    """``wanted`` with underscores in front until no column is called so, in whatever case."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
