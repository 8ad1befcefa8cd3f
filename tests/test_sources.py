"""Stored tables with an owner, lines that don't fit, ordered files."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.sources import readers, scratch, writers

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


@pytest.fixture
def shared(monkeypatch, tmp_path):
    folder = tmp_path / "shared"
    folder.mkdir()
    monkeypatch.setattr(scratch, "shared_folder", lambda spark: str(folder))
    return folder


def test_a_scope_deletes_what_it_owns(spark, shared):
    outer = scratch.materialise(spark.range(3), "outer")
    with scratch.owned_tables(spark) as own:
        table = scratch.materialise(spark.range(5), "own")
        with scratch.owned_tables(spark):
            scratch.materialise(spark.range(7), "inner")
            assert len(list(shared.iterdir())) == 3
        assert len(own) == 1 and len(list(shared.iterdir())) == 2
        assert table.count() == 5
    assert outer.count() == 3 and len(list(shared.iterdir())) == 1


def test_a_scope_deletes_after_a_failure_and_what_is_gone_is_no_error(spark, shared):
    with pytest.raises(RuntimeError), scratch.owned_tables(spark) as own:
        scratch.materialise(spark.range(5), "own")
        scratch.remove(spark, own[0])
        scratch.materialise(spark.range(5), "own")
        raise RuntimeError
    assert not list(shared.iterdir())


def test_json_lines_that_do_not_fit(spark, shared, tmp_path):
    text = ['{"a": 1, "b": "x"}', "{", "", '{"a": "one"}', '{"b": "only"}', '{"a": 2, "c": 3}', "12", '{"a": 9000000000000000000000}']
    (tmp_path / "in.json").write_text("\n".join(text))
    found = readers.read_json_checked(spark, str(tmp_path / "in.json"), SCHEMA)
    assert sorted(map(tuple, found.rows.collect()), key=str) == [(1, "x"), (2, None), (None, "only")]
    assert sorted(r.Text for r in found.unread.collect()) == sorted(["{", '{"a": "one"}', "12", '{"a": 9000000000000000000000}'])
    assert found.rows.columns == ["a", "b"] and {Path(r.File).name for r in found.unread.collect()} == {"in.json"}


def test_csv_records_that_do_not_fit(spark, shared, tmp_path):
    (tmp_path / "in.csv").write_text('a,b\n1,x\none,y\n2\n3,"z, q"\n4,u,v\n')
    found = readers.read_csv_checked(spark, str(tmp_path / "in.csv"), SCHEMA)
    assert sorted(map(tuple, found.rows.collect())) == [(1, "x"), (3, "z, q")]
    assert sorted(r.Text for r in found.unread.collect()) == ["2", "4,u,v", "one,y"]


@pytest.mark.parametrize("parts", [None, 5])
def test_ordered_parts_equal_one_file(spark, shared, tmp_path, parts):
    rows = [(n * 37 % 1000, None if n % 9 == 0 else "" if n % 9 == 1 else f'a,"{n}"\n x ', n / 7, n) for n in range(1000)]
    df = spark.createDataFrame(rows, "key long, `te,xt` string, v double, _head int").repartition(7)
    writers.write_ordered_csv(df, f"{tmp_path}/many", F.desc("key"), F.asc("_head"), parts=parts)
    df.orderBy(F.desc("key")).coalesce(1).write.option("header", True).csv(f"{tmp_path}/one")
    bytes_of = lambda name: [p.read_bytes() for p in sorted(Path(f"{tmp_path}/{name}").glob("part-*"))]
    many = bytes_of("many")
    assert b"".join(many) == bytes_of("one")[0] and (parts is None or len(many) == parts)


def test_an_empty_table_is_a_header(spark, shared, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    writers.write_ordered_csv(df, f"{tmp_path}/out", F.asc("a"))
    assert [p.read_text() for p in Path(f"{tmp_path}/out").glob("part-*")] == ["a,b\n"]
