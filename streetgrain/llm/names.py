"""Column names that an operator may add to a caller's table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or the first of base_2, base_3, ... that no column has in either case."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 1
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name
