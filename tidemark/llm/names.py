"""Names for helper columns that the caller's table does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column of ``df`` is called so in either case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
