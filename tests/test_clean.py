import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from venuekit.operators.rows import flatten_attributes, unread_attributes
from venuekit.plans import clean
from venuekit.sources import schemas

BASE = {
    "address": "1 Road",
    "attributes": None,
    "business_id": "b",
    "categories": "Restaurants, Food, Fast Food",
    "city": "Toronto",
    "hours": None,
    "is_open": 1,
    "latitude": 43.0,
    "longitude": -79.0,
    "name": "Name",
    "postal_code": "M5V 1A1",
    "review_count": 3,
    "stars": 4.0,
    "state": "ON",
}
REQUIRED = ("postal_code", "stars", "latitude", "longitude", "review_count", "categories")


def business_rows():
    yield BASE | {"business_id": "kept"}
    yield BASE | {"business_id": "closed", "is_open": 0}
    yield BASE | {"business_id": "abroad", "state": "NV"}
    yield BASE | {"business_id": "shop", "categories": "Food, Shopping"}
    for field in REQUIRED:
        yield BASE | {"business_id": f"no-{field}", field: None}


@pytest.fixture(scope="module")
def tables(spark):
    raw = spark.createDataFrame(list(business_rows()), schemas.RAW_BUSINESS)
    provinces = spark.createDataFrame([("AB",), ("ON",), ("QC",)], schemas.RAW_PROVINCE)
    return clean.build_business(clean.open_businesses(raw, provinces))


def test_only_open_complete_restaurants_are_kept(tables, rows):
    assert [r.BusinessID for r in tables.business.collect()] == ["kept"]
    assert tables.business.columns == list(clean.BUSINESS_COLUMNS)


def test_categories_cover_all_open_businesses_and_lose_every_space(tables, rows):
    assert rows(tables.categories) == [
        ("kept", "FastFood"),
        ("kept", "Food"),
        ("kept", "Restaurants"),
        ("shop", "Food"),
        ("shop", "Shopping"),
    ]


def test_nan_is_a_present_value(spark):
    raw = spark.createDataFrame([BASE | {"stars": float("nan")}], schemas.RAW_BUSINESS)
    provinces = spark.createDataFrame([("ON",)], schemas.RAW_PROVINCE)
    assert clean.open_businesses(raw, provinces).count() == 1


def attributes(spark, **by_id):
    return spark.createDataFrame(list(by_id.items()), "BusinessID string, Attributes string")


def test_attributes(spark, rows):
    df = attributes(
        spark,
        nested=json.dumps(
            {"Ambience": "{'casual': True, u'romantic': False, 'none': None}", "Alcohol": "u'none'"}
        ),
        flat=json.dumps({"Price": "2", "WiFi": "u'free'", "Dogs": "None", "Hours": "9:30"}),
        quoted=json.dumps({"Music": "{\"it's\": True, 'dj': False}"}),
        empty=json.dumps({"Parking": "{}"}),
        missing=None,
    )
    assert rows(flatten_attributes(df, "BusinessID", "Attributes")) == [
        ("flat", "Hours", "9:30"),
        ("flat", "Price", "2"),
        ("flat", "WiFi", "free"),
        ("nested", "Ambience_casual", "True"),
        ("nested", "Ambience_romantic", "False"),
        ("quoted", "Music_dj", "False"),
        ("quoted", "Music_its", "True"),
    ]


def test_unread_attributes_are_reported_and_do_not_hide_the_others(spark, rows):
    df = attributes(spark, b=json.dumps({"Bad": "{'a': ", "Price": "2"}))
    assert rows(flatten_attributes(df, "BusinessID", "Attributes")) == [("b", "Price", "2")]
    assert rows(unread_attributes(df, "BusinessID", "Attributes")) == [("b", "Bad", "{'a': ")]


def test_attributes_that_do_not_parse_are_reported(spark, rows):
    df = attributes(spark, a='{"WiFi": "free", ', b="not json", c=json.dumps({"WiFi": "free"}), d="")
    assert rows(flatten_attributes(df, "BusinessID", "Attributes")) == [("c", "WiFi", "free")]
    assert rows(unread_attributes(df, "BusinessID", "Attributes")) == [("a", None, '{"WiFi": "free", '), ("b", None, "not json")]


@pytest.fixture(scope="module")
def reviews(spark):
    data = [
        ("r1", "u1", "kept", "2018-12-31 23:59:59", 4.0, "two\nlines", 1),
        ("r2", "u1", "kept", "2018-02-30", 4.0, " ", 0),
        ("r3", "u2", "kept", None, 2.0, None, 0),
        ("r4", "u3", "other", "2018-01-01", 1.0, "x", 0),
    ]
    return spark.createDataFrame(data, schemas.RAW_REVIEW)


def test_reviews_keep_their_text(tables, reviews, rows):
    built = clean.build_reviews(reviews, tables.business)
    assert built.columns == ["ReviewID", "UserID", "BusinessID", "ReviewStars", "Review", "useful", "Date"]
    got = rows(built.select("ReviewID", "Review", "Date"))
    assert got == [("r1", "two\nlines", dt.date(2018, 12, 31)), ("r2", " ", None), ("r3", None, None)]


def test_clean_text_removes_newlines_and_blank_texts(tables, reviews, rows):
    built = clean.build_reviews(reviews, tables.business, clean_text=True)
    assert rows(built.select("ReviewID", "Review")) == [("r1", "twolines")]


def test_checkins(spark, tables, rows):
    raw = spark.createDataFrame(
        [
            ("kept", "2018-12-31 10:00:00, 2019-01-01 11:30:00, bad, 2019-02-30 00:00:00"),
            ("kept", None),
            ("other", "2018-12-31 10:00:00"),
        ],
        schemas.RAW_CHECKIN,
    )
    built = clean.build_checkins(raw, tables.business)
    at = F.date_format("CheckinDate", "yyyy-MM-dd HH:mm:ss")
    assert rows(built.select("BusinessID", at)) == [
        ("kept", "2018-12-31 10:00:00"),
        ("kept", "2019-01-01 11:30:00"),
    ]


def test_users_without_reviews_are_dropped(spark, tables, reviews):
    kept = clean.build_reviews(reviews, tables.business)
    raw = spark.createDataFrame(
        [(u, u, 0, 0, 0, 9, "2010-05-06 07:08:09", 3.5) for u in ("u1", "u2", "u3")], schemas.RAW_USER
    )
    users = clean.build_users(raw, kept)
    assert sorted(r.UserID for r in users.collect()) == ["u1", "u2"]
    assert users.first().YelpingSince == dt.date(2010, 5, 6)
