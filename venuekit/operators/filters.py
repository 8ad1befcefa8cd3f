"""Row filters and deterministic splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOW, HIGH = "low", "high"


def contains_all(c: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [c.contains(p) for p in parts])


def city_filter(df: DataFrame, city: str | None, match: str = "equals") -> DataFrame:
    """Rows of one city, or all without one; ``match="like"`` accepts names that contain it."""
    if match not in ("equals", "like"):
        raise ValueError(f"match must be 'equals' or 'like', not {match!r}")
    if city is None:
        return df
    c = F.col("City")
    return df.where(c == city if match == "equals" else c.contains(city))


def without_placeholders(df: DataFrame, column: str, placeholders: Sequence[str]) -> DataFrame:
    """Drop listed values; NULL rows drop with them."""
    return df.where(~F.col(column).isin(list(placeholders)))


def rating_cohort(stars: Column, threshold: float = 3) -> Column:
    """``low`` up to the threshold, ``high`` above it, NULL for no rating."""
    return F.when(stars <= threshold, LOW).when(stars > threshold, HIGH)


def hash_percent(*columns: str, seed: int = 0) -> Column:
    """A number in 0..99 that any engine with MD5 can repeat from the key alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100


def split_by_key(
    df: DataFrame, *columns: str, train_percent: int = 75, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Split rows by a hash of their key.

    A recomputed partition gives the same split, and so does another row order.
    """
    in_train = hash_percent(*columns, seed=seed) < train_percent
    return df.where(in_train), df.where(~in_train)
