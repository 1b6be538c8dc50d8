"""Column names that no input column has, so that operators can add their own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores before it as it takes to differ from every column.

    Spark resolves names without regard to case by default, so case makes no difference.
    """
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
