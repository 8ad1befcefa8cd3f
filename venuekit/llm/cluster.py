"""What the operators need of the cluster, and column names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from venuekit.sources.cluster import ship

__all__ = ["fresh", "ship"]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
