import itertools
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from venuekit.functions import numbers, text
from venuekit.operators import aggregates, blocks, filters, joins, ranking
from venuekit.plans import recommend
from venuekit.sources import readers, scratch, writers
from venuekit.sources.schemas import RAW_PROVINCE


def values(spark, column, *items, kind="string"):
    df = spark.createDataFrame([(i,) for i in items], f"c {kind}")
    return [r[0] for r in df.select(column(F.col("c"))).collect()]


def test_features_go_in_order(spark):
    got = values(
        spark,
        text.remove_features,
        "see http://www.a.co/b/c/ now",
        "it's 24/7!",
        "https://x.org/" + "/".join(["seg"] * 20000) + " end",
        None,
    )
    assert got == ["see   now", "it s" + " " * 5, "  end", None]


def test_ascii_and_tokens(spark):
    assert values(spark, text.strip_non_ascii, "café \x7f~\x01\U0001f600", None) == ["caf ~\x01", None]
    assert values(spark, text.tokens, "Don't STOP_me 2day", "", None) == [
        ["don", "t", "stop_me", "2day"],
        [],
        None,
    ]


def test_items_and_characters(spark):
    assert values(spark, lambda c: text.item(c, ":", 1), "a:b:c", "a", None) == ["b", None, None]
    assert values(spark, lambda c: text.strip_chars(c, "[]"), "[1,2]") == ["1,2"]
    look = values(
        spark, lambda c: text.look_up(c, F.array(F.lit("x"), F.lit("y"))), [1, 0, 2], kind="array<int>"
    )
    assert look == [["y", "x", None]]


def test_numbers(spark):
    assert values(spark, lambda c: numbers.clamp(c, 0.0, 5.0), -1.0, 2.5, 7.0, None, kind="double") == [
        0.0,
        2.5,
        5.0,
        None,
    ]
    assert values(spark, lambda c: numbers.number(c, "int"), "12", "1,234", "", None) == [12, None, None, None]
    assert values(spark, lambda c: numbers.bucket_start(c, 10), 9, 10, 19, kind="long") == [0, 10, 10]


def test_cohorts(spark):
    assert values(spark, filters.rating_cohort, 3.0, 3.5, None, kind="double") == ["low", "high", None]


def test_city_match(spark):
    df = spark.createDataFrame([("Toronto",), ("North Toronto",), (None,)], "City string")
    assert filters.city_filter(df, "Toronto").count() == 1
    assert filters.city_filter(df, "Toronto", "like").count() == 2
    assert filters.city_filter(df, None).count() == 3
    with pytest.raises(ValueError):
        filters.city_filter(df, "Toronto", "starts")


def test_split_is_whole_disjoint_and_repeatable(spark):
    df = spark.range(2000)
    train, rest = filters.split_by_key(df, "id", seed=1)
    again, _ = filters.split_by_key(df.repartition(13), "id", seed=1)
    kept = {r.id for r in train.collect()}
    assert kept == {r.id for r in again.collect()}
    assert kept.isdisjoint({r.id for r in rest.collect()}) and train.count() + rest.count() == 2000
    assert 0.7 < len(kept) / 2000 < 0.8
    assert kept != {r.id for r in filters.split_by_key(df, "id", seed=2)[0].collect()}


# --- a key with a third of all rows ------------------------------------------------------
@pytest.fixture(scope="module")
def skewed(spark):
    """3000 texts, a third of them of one key, each text twice."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    texts = spark.range(3000).select(key.alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    return texts.unionAll(texts)


def test_distinct_texts_keep_keys_without_text(spark, skewed, rows):
    found = aggregates.collect_distinct_text(skewed, "k", "t", "text")
    assert rows(found) == rows(skewed.distinct())
    none = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, t string")
    assert rows(aggregates.collect_distinct_text(none, "k", "t", "text")) == [("a", None), ("b", "x")]


def test_hot_texts_are_spread_over_tasks(spark, skewed):
    df = aggregates.collect_distinct_text(skewed, "k", "t", "text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = df.where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 3


def test_top_n_equals_brute_force_and_cuts_before_the_shuffle(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("g"),
        (F.hash("id") % 7).alias("s"),
        "id",
    )
    best = ranking.top_n_per_group(df, 4, "g", F.desc("s"), F.asc("id"))
    physical = best._jdf.queryExecution().executedPlan().toString()
    assert physical.count("WindowGroupLimit") == 2  # before and after the shuffle
    got = {(r.g, r["rank"], r.id) for r in best.collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append((-r.s, r.id))
    want = {(g, n, i) for g, v in groups.items() for n, (_, i) in enumerate(sorted(v)[:4], start=1)}
    assert got == want


def test_string_index(spark, rows):
    df = spark.createDataFrame([(v,) for v in ("b", "a", "c", "c", None)], "v string")
    got = ranking.string_index(df, "v", "i")
    assert rows(got.select("i", "v")) == [(0, "c"), (1, "a"), (2, "b")]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    rmse, r2 = aggregates.regression_metrics(df, "y", "p").first()
    assert rmse == pytest.approx((1.25 / 3) ** 0.5)
    assert r2 == pytest.approx(1 - 1.25 / (14 / 3))


def test_metrics_leave_out_rows_without_a_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (10.0, None)], "y double, p double")
    assert aggregates.regression_metrics(df, "y", "p").first()[1] == pytest.approx(-1.0)


def test_numbering_equals_a_sort_and_runs_in_parallel(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("v"), (F.col("id") % 3).alias("g"))
    got = [r.v for r in ranking.numbered(df, "at", F.desc("g"), F.asc("v")).orderBy("at").collect()]
    assert got == [r.v for r in df.orderBy(F.desc("g"), "v").collect()]
    assert [r["at"] for r in ranking.numbered(df, "at", F.asc("v")).select("at").orderBy("at").collect()] == list(range(5000))


# --- joins -------------------------------------------------------------------------------
def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def visits(spark):
    users = spark.createDataFrame([(u, f"n{u}") for u in range(1, 7)], "UserID int, UserName string")
    places = spark.createDataFrame([(b, f"p{b}") for b in "abcd"], "BusinessID string, Name string")
    seen = [(None, 1, "a"), ("r", 1, "a"), ("r", 1, "b"), ("r", 2, "d"), ("r", 6, "a"), ("r", 3, "zz")]
    reviews = spark.createDataFrame(seen, "ReviewID string, UserID int, BusinessID string")
    return users, places, reviews


@pytest.mark.parametrize("sizes", [(512, 4096), (2, 3), (1, 1)])
def test_unvisited_pairs_equal_brute_force(visits, sizes):
    users, places, reviews = visits
    served = users.where("UserID <> 5")
    pairs = joins.unvisited_pairs(served, places, reviews, *sizes)
    seen = {(r.UserID, r.BusinessID) for r in reviews.collect()}
    want = {(u, b) for u in (1, 2, 3, 4, 6) for b in "abcd"} - seen
    got = [(r.UserID, r.BusinessID) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert pairs.columns == ["BusinessID", "Name", "UserID", "UserName"]
    assert joins.unvisited_pairs(served, places, None, *sizes).count() == 20
    assert joins.unvisited_pairs(served.limit(0), places, reviews, *sizes).count() == 0
    assert joins.unvisited_pairs(served, places.limit(0), reviews, *sizes).count() == 0


def test_pairs_need_no_product_join(visits):
    users, places, reviews = visits
    pairs = joins.unvisited_pairs(users, places, reviews)
    for df in (pairs, joins.unvisited_counts(users, places, reviews)):
        assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


def test_users_are_not_shuffled_with_the_businesses(spark, visits):
    """Arrays of users lie below no exchange but that of the users themselves."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = joins.unvisited_pairs(*visits)
        tree = pairs._jdf.queryExecution().sparkPlan().toString()
        text = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_users" in tree
    for line in text.splitlines():
        if "Exchange hashpartitioning(" in line and "_visited" in line:
            assert "_users" not in line
    by_business = [n for n, line in enumerate(text.splitlines()) if "Exchange hashpartitioning(BusinessID" in line]
    assert by_business and all("_users" not in line for line in text.splitlines()[by_business[0] :] if "Project" in line and "BusinessID" in line)


def test_unvisited_counts(visits, rows):
    assert rows(joins.unvisited_counts(*visits)) == [(1, 2), (2, 3), (3, 4), (4, 4), (5, 4), (6, 3)]


def test_present_in_folds_the_other_side(spark, visits):
    users, _, reviews = visits
    kept = joins.present_in(users, "UserID", reviews, "UserID")
    assert sorted(r.UserID for r in kept.collect()) == [1, 2, 3, 6]
    assert "partial" in plan(kept) or "HashAggregate" in plan(kept)


def test_absent_from_equals_the_outer_join_with_a_null_test(spark, visits, rows):
    _, _, reviews = visits
    pairs = spark.createDataFrame([(u, b) for u in range(1, 7) for b in "abcd"], "UserID int, BusinessID string")
    got = joins.absent_from(pairs, ("UserID", "BusinessID"), reviews)
    outer = pairs.join(reviews.withColumn("hit", F.lit(1)), ["UserID", "BusinessID"], "left")
    assert rows(got) == rows(outer.where("hit is null").select("UserID", "BusinessID"))
    # Keys that are NULL match nothing.
    unknown = pairs.limit(1).select(F.lit(None).cast("int").alias("UserID"), "BusinessID")
    assert joins.absent_from(unknown, ("UserID", "BusinessID"), reviews).count() == 1


# --- files -------------------------------------------------------------------------------
def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, `b c` int")
    assert readers.normalise_headers(df).columns == ["a", "b c"]
    assert readers.normalise_headers(df, squeeze=True).columns == ["a", "bc"]


def test_round_trips(spark, tmp_path, rows):
    df = spark.createDataFrame([("ON", 'a "quoted", text'), ("AB", None)], "code string, note string")
    folder = str(tmp_path) + "/"
    writers.write_parquet(df, writers.out_path(folder, "t"), ("code",))
    assert rows(readers.read_parquet(spark, f"{tmp_path}/t").select("code", "note")) == rows(df)
    with pytest.raises(PySparkException):
        writers.write_parquet(df, f"{tmp_path}/t")
    writers.write_csv(df, f"{tmp_path}/c", single_file=True)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 1
    assert rows(readers.read_csv(spark, f"{tmp_path}/c")) == rows(df)
    assert rows(readers.read_csv(spark, f"{tmp_path}/c", df.schema)) == rows(df)
    (tmp_path / "j.json").write_text('{"code": "ON", "x": 1}\n{"code": "QC"}\n')
    assert rows(readers.read_json(spark, f"{tmp_path}/j.json", RAW_PROVINCE)) == [("ON",), ("QC",)]


def test_materialise_reads_back_from_the_shared_folder(spark):
    df = scratch.materialise(spark.range(5).withColumn("x", F.col("id") * 2), "probe")
    assert df.agg(F.sum("x")).first()[0] == 20
    assert scratch.shared_folder(spark) in df.inputFiles()[0]


def test_filters_and_columns_reach_the_scan(spark, small):
    from workload.inputs import Inputs

    wanted = Inputs(spark, small).table("lineitem").where("l_shipdate > '1998-01-01'").select("l_suppkey")
    text_plan = plan(wanted)
    assert "GreaterThan(l_shipdate" in text_plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in text_plan


def test_pairs_are_built_by_many_tasks(spark):
    """Blocks and slices are small, but what they grow to is not for one task."""
    users, businesses = spark.range(2000).toDF("UserID"), spark.range(300).toDF("BusinessID")
    visits = spark.range(500).selectExpr("id as UserID", "id % 300 as BusinessID")
    pairs = joins.unvisited_pairs(users, businesses, visits, block_users=100, block_businesses=30)
    per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(per_task) == 2000 * 300 - 500 and len(per_task) > 4


def test_blocks_of_users_are_not_broadcast(spark):
    """Grouped, the users are few bytes; repeated for each slice they are not, and Spark sees the first size only."""
    users, businesses = spark.range(3000).toDF("UserID"), spark.range(2000).toDF("BusinessID")
    visits = spark.range(500).selectExpr("id as UserID", "id % 300 as BusinessID")
    for best in (None, blocks.Best(blocks.product("UserID", "BusinessID"), 3, 5.0)):
        pairs = joins.unvisited_pairs(users, businesses, visits, block_users=100, block_businesses=10, best=best)
        assert len(pairs.agg(F.count("*")).collect()) == 1
        counted = pairs.groupBy().count()
        counted.collect()
        lines = plan(counted).split("Initial Plan")[0].splitlines()
        assert any("SortMergeJoin" in x or "FlatMapCoGroupsInArrow" in x for x in lines)
        sent = [n for n, x in enumerate(lines) if "BroadcastExchange" in x]
        depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
        for n in sent:
            below = [x for x in itertools.takewhile(lambda x: depth(x) > depth(lines[n]), lines[n + 1 :])]
            assert not any("_users" in x for x in below)


@pytest.mark.parametrize("sizes", [(512, 4096), (7, 5), (1, 1)])
@pytest.mark.parametrize("cells", [blocks.CELLS, 20])
def test_the_best_pairs_of_blocks_hold_the_best_of_all(spark, rows, sizes, cells, monkeypatch):
    """Ids that come twice, users and businesses without a score, ties, and users who were nearly everywhere."""
    monkeypatch.setattr(blocks, "CELLS", cells)
    r = random.Random(5)
    people = [(u, r.choice([None, 1.0, 1.5, 2.25])) for u in range(40)] + [(3, 2.0), (4, None)]
    places = [(b, r.choice([None, 1.0, 2.0, 4.5])) for b in range(30)] + [(7, 2.0), (8, 4.5)]
    seen = [(r.randrange(44), r.randrange(33)) for _ in range(300)] + [(5, b) for b in range(27)] + [(None, 1), (1, None)]
    users = spark.createDataFrame(people, "UserID long, AverageStars double")
    businesses = spark.createDataFrame(places, "BusinessID long, BusinessStars double")
    reviews = spark.createDataFrame(seen, "UserID long, BusinessID long")
    score = F.col("AverageStars") * F.col("BusinessStars")
    lists = []
    for best in (None, recommend.first_of_block(blocks.product("AverageStars", "BusinessStars"), 4)):
        for met in (reviews, None):
            pairs = joins.unvisited_pairs(users, businesses, met, *sizes, best=best)
            lists.append(rows(recommend.best_per_user(pairs.withColumn("score", score), "score", 4).select("UserID", "BusinessID", "FinalStar", "rank")))
            assert pairs.columns == ["BusinessID", "BusinessStars", "UserID", "AverageStars"]
    assert lists[:2] == lists[2:] and len(lists[0]) > 150
    for none in (users.limit(0), businesses), (users, businesses.limit(0)):
        assert joins.unvisited_pairs(*none, reviews, *sizes, best=best).count() == 0
