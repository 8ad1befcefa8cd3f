"""Intermediate tables that outlive the executors that wrote them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: What the open scopes own, the innermost last.  Threads of a fit belong to the scope that the driver has open.
_owned: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else by the context.

    Where both are unset a fresh temporary folder serves, but only in local mode:
    on a cluster a folder of one machine would be lost with that machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="venuekit-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table, in whatever store it lies; one that is gone already is no error."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def owned_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Owns every table that ``materialise`` writes within it and deletes them at its end, also after a failure.

    Whatever reads them must have been written by then: a lost executor is
    replaced while the scope is open, so that retried tasks still find them.
    """
    own: list[str] = []
    _owned.append(own)
    try:
        yield own
    finally:
        _owned.remove(own)
        for path in own:
            remove(spark, path)


def owned_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that the innermost open scope of ``owned_tables`` owns; without one it stays."""
    path = f"{shared_folder(spark)}/{name}"
    if _owned:
        _owned[-1].append(path)
    return path


def materialise(df: DataFrame, name: str, schema: T.StructType | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    The scan has no lineage above it, so a lost executor costs a re-read and not
    a re-run, and it knows its size, so the optimiser can pick a join by it.
    ``schema`` replaces the read schema where the stored layout is the same, and columns ``by`` become folders.
    The innermost open scope of ``owned_tables`` owns the table; without one it stays.
    """
    spark = df.sparkSession
    path = owned_folder(spark, f"{name}-{uuid.uuid4().hex}")
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)
