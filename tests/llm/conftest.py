import pytest
from pyspark.sql import functions as F

TEXTS = [None, "", " \n\t ", "the same text of a few words", "the same text of a few words", "x" * 300_000, "wörd日本 " * 4000, "a<|endoftext|>b"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, 5, "z") for i, t in enumerate(TEXTS)]
    rows.append(rows[4])
    schema = "doc_id long, text string, lang string, score int, spans string"
    return spark.createDataFrame(rows, schema).withColumns(
        {n: F.lit(1) for n in ("shard", "slot", "bucket", "position", "row_key", "text_key", "fingerprint", "ids", "start")}
    )


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
