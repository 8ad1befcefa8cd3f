"""File readers.  They are lazy, but for the checked ones, which read the file once into a stored table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.sources.scratch import materialise

_UNREAD = "_unread"


class Checked(NamedTuple):
    rows: DataFrame
    unread: DataFrame  # File, Text: lines that don't fit the schema, as they stand


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a given schema, so that no inference pass is made."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line.  Without a schema every column is a string."""
    reader = spark.read.option("header", True)
    if schema is not None:
        # Take columns by position from the schema but check them against the header.
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def _checked(reader: DataFrameReader, schema: T.StructType, read) -> Checked:
    both = T.StructType([*schema.fields, T.StructField(_UNREAD, T.StringType())])
    parsed = read(reader.schema(both).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _UNREAD))
    stored = materialise(parsed.withColumn("_file", F.col("_metadata.file_path")), "read")
    rows = stored.where(F.col(_UNREAD).isNull()).drop(_UNREAD, "_file")
    return Checked(rows, stored.where(F.col(_UNREAD).isNotNull()).select(F.col("_file").alias("File"), F.col(_UNREAD).alias("Text")))


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType) -> Checked:
    """JSON lines with a given schema, and apart from them the lines that don't fit it; both come from one read.

    A line fits if it is one JSON object whose values have the schema's types; fields may be missing.
    A blank line is no record.
    """
    return _checked(spark.read, schema, lambda r: r.json(path))


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> Checked:
    """CSV with a header line and a given schema by position, and apart from it the records that don't fit.

    A record fits if it has as many fields as the schema and values of its types.
    """
    return _checked(spark.read.option("header", True), schema, lambda r: r.csv(path))


def normalise_headers(df: DataFrame, squeeze: bool = False) -> DataFrame:
    """Strip outer spaces from column names; ``squeeze`` removes inner ones too."""
    fix = (lambda c: c.replace(" ", "")) if squeeze else (lambda c: c.strip(" "))
    return df.toDF(*[fix(c) for c in df.columns])
