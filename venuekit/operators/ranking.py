"""Top-n operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuekit.sources.scratch import materialise


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_n_per_group(df: DataFrame, n: int, group: str, *order: Column, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group.

    ``order`` must end in a unique column.  Spark cuts every input partition to
    ``n`` rows per group before the shuffle, so a hot group never travels whole.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def numbered(df: DataFrame, alias: str, *order: Column) -> DataFrame:
    """``df`` with each row's place in ``order`` from 0, worked out by all tasks.

    Rows are sorted by range into a stored table; a row's place is its place in its
    partition plus the rows of the partitions before.  ``order`` must end in a unique column.
    """
    stored = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", 33)
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = counts.select("_part", (before - F.col("_n")).alias("_before"))  # a row per partition
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.withColumn("_part", part).join(offsets, "_part").withColumn(alias, place).drop("_part", "_before", "_at")


def string_index(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Distinct values numbered from 0, most frequent first, ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return numbered(counts, alias, F.desc("n"), F.asc(column))
