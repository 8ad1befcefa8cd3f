"""Raw records to clean tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.functions.dates import parse_time
from venuekit.functions.text import without_spaces
from venuekit.operators.filters import contains_all
from venuekit.operators.joins import present_in
from venuekit.operators.rows import explode_list, flatten_attributes, unread_attributes

# What makes a business a restaurant, and the fields it must carry.
RESTAURANT_WORDS = ("Restaurant", "Food")
REQUIRED = ("PostalCode", "BusinessStars", "Latitude", "Longitude", "ReviewCount", "Categories")
# Raw field names and the columns they become.
BUSINESS_FIELDS = {
    "business_id": "BusinessID",
    "name": "Name",
    "city": "City",
    "state": "State",
    "postal_code": "PostalCode",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "stars": "BusinessStars",
    "categories": "Categories",
    "review_count": "ReviewCount",
}
BUSINESS_COLUMNS = tuple(BUSINESS_FIELDS.values())
REVIEW_FIELDS = {
    "review_id": "ReviewID",
    "user_id": "UserID",
    "business_id": "BusinessID",
    "stars": "ReviewStars",
    "text": "Review",
    "useful": "useful",
    "date": "Date",
}
USER_FIELDS = {
    "user_id": "UserID",
    "name": "UserName",
    "useful": "Useful",
    "funny": "Funny",
    "cool": "Cool",
    "review_count": "ReviewCount",
    "yelping_since": "YelpingSince",
    "average_stars": "AverageStars",
}


def renamed(raw: DataFrame, fields: dict[str, str], *extra: Column) -> DataFrame:
    return raw.select(*[F.col(name).alias(alias) for name, alias in fields.items()], *extra)


def with_date(df: DataFrame, column: str) -> DataFrame:
    """Text to date; malformed text gives NULL."""
    return df.withColumn(column, F.col(column).try_cast("date"))


class BusinessTables(NamedTuple):
    business: DataFrame
    attributes: DataFrame
    categories: DataFrame
    unread: DataFrame  # attributes that do not parse


def open_businesses(raw: DataFrame, provinces: DataFrame) -> DataFrame:
    """Open businesses of the listed provinces that carry all required fields."""
    opened = raw.where("is_open = 1")
    named = renamed(opened, BUSINESS_FIELDS, F.col("attributes").alias("Attributes"))
    return present_in(required_fields(named), "State", provinces, "code")


def required_fields(businesses: DataFrame) -> DataFrame:
    # Not dropna: that also drops NaN, which is a present value here.
    for column in REQUIRED:
        businesses = businesses.where(F.col(column).isNotNull())
    return businesses


def restaurants(businesses: DataFrame) -> DataFrame:
    return businesses.where(contains_all(F.col("Categories"), RESTAURANT_WORDS))


def categories(businesses: DataFrame) -> DataFrame:
    """One row per listed category, with every space removed."""
    rows = explode_list(businesses, "Categories", "Category", "BusinessID")
    return rows.withColumn("Category", without_spaces(F.col("Category")))


def build_business(businesses: DataFrame) -> BusinessTables:
    """The business tables from the result of ``open_businesses``.

    Categories cover all of its rows, the others only restaurants.  The caller
    may persist the input, which all of them read.
    """
    food = restaurants(businesses)
    return BusinessTables(
        business=food.select(*BUSINESS_COLUMNS),
        attributes=flatten_attributes(food, "BusinessID", "Attributes"),
        categories=categories(businesses),
        unread=unread_attributes(food, "BusinessID", "Attributes"),
    )


def build_reviews(raw: DataFrame, businesses: DataFrame, clean_text: bool = False) -> DataFrame:
    """Reviews of the given businesses.

    ``clean_text`` removes newlines and drops blank texts; without it texts stay
    as they were written.
    """
    if clean_text:
        raw = raw.withColumn("text", F.regexp_replace("text", "\n", "")).where("text <> ' '")
    known = present_in(raw, "business_id", businesses, "BusinessID")
    return with_date(renamed(known, REVIEW_FIELDS), "Date")


def build_checkins(raw: DataFrame, businesses: DataFrame) -> DataFrame:
    """One row per visit out of a comma list of times; malformed times drop."""
    known = present_in(raw, "business_id", businesses, "BusinessID")
    visits = explode_list(known, "date", "CheckinDate", F.col("business_id").alias("BusinessID"))
    return visits.withColumn("CheckinDate", parse_time(F.col("CheckinDate"))).where(
        F.col("CheckinDate").isNotNull()
    )


def build_users(raw: DataFrame, reviews: DataFrame) -> DataFrame:
    """Users that wrote at least one of the given reviews."""
    known = present_in(raw, "user_id", reviews, "UserID")
    return with_date(renamed(known, USER_FIELDS), "YelpingSince")
