"""File writers.  These run a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.sources.scratch import materialise


def out_path(folder: str, name: str) -> str:
    """Join an output folder and a dataset name with exactly one slash."""
    return f"{folder.rstrip('/')}/{name}"


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write a table; fail if the path already holds one."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> None:
    """Write a report as CSV.

    ``single_file`` is for reports whose row count is bounded by construction
    (topic key words, top-n lists).  It shuffles the finished rows into one
    partition; ``coalesce(1)`` would also squeeze the work above it into one task.
    """
    if single_file:
        df = df.repartition(1)
    df.write.option("header", header).mode("errorifexists").csv(path)


def write_ordered_csv(df: DataFrame, path: str, *order: Column, parts: int | None = None) -> None:
    """Write rows in ``order`` as CSV parts by range, the header in the first only.

    The parts, put together in order of their names, are the file that one task would have written, but many
    tasks write them.  ``order`` should end in a unique column; ``parts`` bounds their number.  The
    rows are stored first, as the ranges are drawn from a look at all of them.
    """
    stored = materialise(df, "ordered")
    first = "_head"
    while first in stored.columns:
        first += "_"
    names = F.to_csv(F.struct(*(F.lit(c).alias(f"c{n}") for n, c in enumerate(stored.columns))))
    head = stored.sparkSession.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema), F.lit(0).alias(first))
    rows = head.unionByName(stored.withColumn(first, F.lit(1)))
    by = (F.col(first), *order)
    dealt = rows.repartitionByRange(*by) if parts is None else rows.repartitionByRange(parts, *by)
    line = F.when(F.col(first) == 0, names).otherwise(F.to_csv(F.struct(*stored.columns)))
    dealt.sortWithinPartitions(*by).select(line.alias("value")).write.mode("errorifexists").text(path)
