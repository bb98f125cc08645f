"""Names for helper columns beside columns of any name."""

from __future__ import annotations

from collections.abc import Iterable


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores before it until no column has it. Case does not tell names apart."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
