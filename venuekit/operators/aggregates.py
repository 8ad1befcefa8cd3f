"""Aggregations that stay safe when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_apart(df: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """``groupBy(keys).agg(measures)`` whose result is not tied to the keys' partitioning.

    Grouping by the keys as one struct gives the rows their own shuffle, after the
    usual map-side fold.  A plain ``groupBy`` reuses the partitioning of a join by
    one of its keys, and a join reuses that of a grouping.  Spark then cannot split
    the join's oversized partitions, and a hot key stays in one task.
    """
    grouped = df.groupBy(F.struct(*keys).alias("_key"))
    folded = grouped.agg(*measures) if measures else df.select(F.struct(*keys).alias("_key")).distinct()
    return folded.select("_key.*", *folded.columns[1:])


def collect_distinct_text(df: DataFrame, key: str, text: str, alias: str) -> DataFrame:
    """Rows (key, alias), one per distinct text of a key, and one with NULL for a key that has a NULL or no text.

    A key's texts are never merged into one value, which no size of group would bound.
    """
    # Duplicates fold map-side, and the shuffle is on both columns.
    return df.select(key, F.col(text).alias(alias)).distinct()


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row (rmse, r2) from a single pass over the rows that have both values."""
    error = F.avg(F.pow(F.col(label) - F.col(prediction), 2))
    spread = F.var_pop(F.when(F.col(prediction).isNotNull(), F.col(label)))
    return df.agg(
        F.sqrt(error).alias("rmse"),
        (F.lit(1.0) - F.try_divide(error, spread)).alias("r2"),
    )


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of pre-aggregated values; rows without a value carry no weight."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))
