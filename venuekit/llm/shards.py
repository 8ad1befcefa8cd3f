"""Shuffle a table of documents into shards of equal length, in two passes.

Pass one scatters the rows by a seeded hash into buckets that fit in memory.  Pass two
shuffles each bucket by Fisher and Yates' method and writes it.  The buckets one after the
other are a random order of all rows; row ``g`` of it is row ``g // shards`` of shard
``g % shards``, so that the numbers of rows differ by one at most.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.llm.cluster import fresh, ship
from venuekit.sources.scratch import materialise

#: Bytes of text in a bucket, on average.
BUCKET_BYTES = 16 << 20
#: Buckets whose counts one task adds up.
CHUNK = 1 << 12


def text_bytes(name: str = "text") -> F.Column:
    """Bytes in UTF-8, none for null, plus 1."""
    return F.coalesce(F.octet_length(name), F.lit(0)).cast("long") + 1


def _fisher_yates(bucket: str, position: str, key: str, seed: int) -> Callable[[pa.Table], pa.Table]:
    def shuffle(table: pa.Table) -> pa.Table:
        table = table.sort_by(key)  # rows arrive in any order
        n = table.num_rows
        number = table[bucket][0].as_py()
        order = np.arange(n)
        random = np.random.default_rng([seed, number])
        swaps = random.integers(0, np.arange(n, 0, -1)) if n else order
        for i, j in zip(range(n - 1, 0, -1), swaps.tolist()):
            order[i], order[j] = order[j], order[i]
        return table.take(order).drop_columns([key]).append_column(position, pa.array(np.arange(n), pa.int64()))

    return shuffle


def shuffled(
    docs: DataFrame, seed: int = 1, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, str, str]:
    """All rows in shuffled buckets, as a table in the shared folder, and the names of its columns
    for the bucket and the position in it.

    Copies of a text and repeated ids are scattered like other rows: the hash also takes in the
    input partition, so rows that agree in everything share a bucket only within a partition.
    Nulls and empty texts count one byte and are hashed like values.
    """
    ship(docs.sparkSession)
    bucket, position, key = (fresh(docs, n) for n in ("bucket", "position", "row_key"))
    total = docs.agg(F.sum(text_bytes(text_col))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    # a null and its absence hash alike, hence the struct's null flags
    identity = F.xxhash64(F.lit(seed), id_col, F.col(id_col).isNull(), text_col, F.col(text_col).isNull())
    scattered = docs.withColumn(key, identity).withColumn(
        bucket, F.pmod(F.xxhash64(key, F.spark_partition_id()), F.lit(buckets))
    )
    schema = T.StructType([*docs.schema.fields, T.StructField(bucket, T.LongType()), T.StructField(position, T.LongType())])
    table = scattered.groupBy(bucket).applyInArrow(_fisher_yates(bucket, position, key, seed), schema)
    return materialise(table, "shuffled"), bucket, position


def offsets(table: DataFrame, bucket: str) -> DataFrame:
    """For each bucket the number of rows in the buckets before it, added up in two levels."""
    counts = table.groupBy(bucket).agg(F.count("*").alias("n")).withColumn("chunk", F.floor(F.col(bucket) / CHUNK))
    of_chunk = counts.groupBy("chunk").agg(F.sum("n").alias("n"))
    before = of_chunk.select(
        "chunk", (F.sum("n").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base")
    )
    inside = F.sum("n").over(Window.partitionBy("chunk").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumn("inside", inside - F.col("n")).join(before, "chunk").select(
        bucket, (F.col("inside") + F.col("base")).alias("offset")
    )


def equal_shards(docs: DataFrame, shards: int = 8, **options) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard) in random order.

    An empty table gives an empty result.  Columns of the input that are called ``shard`` or
    ``slot`` keep their names and the new ones get an underscore in front.
    """
    table, bucket, position = shuffled(docs, **options)
    shard, slot = fresh(docs, "shard"), fresh(docs, "slot")
    # a table of known size, so that the texts need no second shuffle while the buckets are few
    starts = materialise(offsets(table.select(bucket), bucket), "offsets").withColumnRenamed("offset", offset := fresh(table, "offset"))
    place = F.col(offset) + F.col(position)
    return (
        table.join(starts, bucket)
        .withColumn(shard, F.pmod(place, F.lit(shards)).cast("int"))
        .withColumn(slot, F.floor(place / F.lit(shards)).cast("long"))
        .drop(bucket, position, offset)
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, **options) -> None:
    """Write one folder of Parquet files per shard, its rows sorted by slot."""
    placed = equal_shards(docs, shards, **options)
    shard, slot = fresh(docs, "shard"), fresh(docs, "slot")
    placed.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
