"""Column names of an operator's own, whatever the inputs' columns are called."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, wanted: str, *others: DataFrame) -> str:
    """``wanted`` or a longer name that no column of ``df`` and ``others`` has (names compare without case)."""
    taken = {c.lower() for d in (df, *others) for c in d.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
