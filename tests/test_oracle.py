"""Every query with a SQL twin gives the twin's names, types and rows."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import DATA
from workload import queries as workload

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/sf0.001/{t}.parquet'")
    yield con
    con.close()


def content(table):
    names = sorted(table.column_names)
    types = [str(table.schema.field(n).type).replace("large_", "") for n in names]

    def plain(v):
        return repr(v + 0.0) if isinstance(v, float) and not math.isnan(v) else repr(v)

    cells = [[plain(v) for v in table[n].to_pylist()] for n in names]
    return names, types, sorted(zip(*cells))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, duck, small, name):
    ours = content(QUERIES[name](spark, small).toArrow())
    assert ours == content(duck.execute(ORACLE[name]).to_arrow_table())


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(workload.queries()) - set(ORACLE) == {"lda_topics", "lda_distribution", "gbt_recommend"}


def test_entry(spark):
    assert entry(spark).count() == 10


def test_placeholders_of_more_businesses(spark):
    """The smallest tables have no business whose attributes don't parse."""
    con = duckdb.connect()
    con.execute(f"create view supplier as select * from '{DATA}/sf0.01/supplier.parquet'")
    ours = content(QUERIES["placeholder_filter"](spark, f"{DATA}/sf0.01").toArrow())
    assert ours == content(con.execute(ORACLE["placeholder_filter"]).to_arrow_table())
