"""Aggregate reports.  Every sort ends in a key, so that ties have one order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.functions import dates
from venuekit.functions.numbers import bucket_start, range_label
from venuekit.functions.text import item, without_spaces
from venuekit.operators.filters import city_filter
from venuekit.operators.ranking import top_k
from venuekit.operators.rows import explode_list

# Category names, without spaces, that count as a cuisine.
CUISINES = (
    "Canadian(New)", "Chinese", "American(Traditional)", "Italian", "Mexican",
    "MiddleEastern", "Japanese", "Indian", "Mediterranean", "AsianFusion", "French",
    "American(New)", "Vietnamese", "Korean", "Taiwanese", "Caribbean", "Greek",
    "Filipino", "LatinAmerican", "Lebanese", "Portuguese", "Pakistani", "Hawaiian",
    "Persian/Iranian", "British", "African", "ModernEuropean", "Afghan", "Turkish",
    "Irish", "Arabian", "Belgian", "German", "Spanish", "Brazilian",
    "Himalayan/Nepalese", "International", "Russian", "Colombian", "SriLankan",
    "Ukrainian", "Venezuelan", "Argentine", "Australian", "Ethiopian", "Hungarian",
    "Malaysian", "Singaporean", "SouthAfrican", "Bangladeshi", "Egyptian", "Mongolian",
)
REVIEW_RANGE = 10


def _count(of: str, alias: str) -> Column:
    return F.count(of).alias(alias)


# --- businesses -----------------------------------------------------------------
def cuisines_by_state(
    business: DataFrame, state: str, cuisines: Sequence[str] = CUISINES, k: int = 10
) -> DataFrame:
    listed = explode_list(
        business.where(F.col("State") == state), "Categories", "Categories", "BusinessID", "State"
    ).withColumn("Categories", without_spaces(F.col("Categories")))
    counts = (
        listed.where(F.col("Categories").isin(list(cuisines)))
        .groupBy("Categories", "State")
        .agg(_count("BusinessID", "BusinessCount"))
        .select("BusinessCount", "State", "Categories")
    )
    return top_k(counts, k, F.desc("BusinessCount"), F.asc("Categories"))


def city_star_map(business: DataFrame, city: str) -> DataFrame:
    return city_filter(business, city).select(
        "BusinessID",
        "Name",
        without_spaces(F.col("PostalCode")).alias("ZipCode"),
        "Latitude",
        "Longitude",
        F.floor("BusinessStars").alias("Stars"),
    )


def top_categories(categories: DataFrame, k: int = 10) -> DataFrame:
    counts = categories.groupBy("Category").agg(_count("BusinessID", "CategoryCount"))
    return top_k(counts, k, F.desc("CategoryCount"), F.asc("Category"))


def city_counts(business: DataFrame) -> DataFrame:
    counts = business.groupBy("State", "City").agg(_count("BusinessID", "BusinessCount"))
    return counts.orderBy(F.desc("BusinessCount"), "State", "City")


def state_avg_stars(business: DataFrame) -> DataFrame:
    return business.groupBy("State").agg(F.avg("BusinessStars").alias("AverageStar")).orderBy("State")


def attr_value_counts(attributes: DataFrame, key: str) -> DataFrame:
    """Businesses per value of the attributes whose key contains ``key``."""
    return (
        attributes.where(F.col("attr_key").contains(key))
        .groupBy(F.col("attr_val").alias(key))
        .agg(_count("BusinessID", "Count"))
    )


def attr_flag_counts(attributes: DataFrame, key: str, flag: str = "True") -> DataFrame:
    """Businesses per sub-attribute (``key_sub``) that is set."""
    return (
        attributes.where(F.col("attr_key").contains(key) & (F.col("attr_val") == flag))
        .groupBy(item(F.col("attr_key"), "_", 1).alias(key))
        .agg(_count("BusinessID", "Count"))
    )


# --- check-ins ------------------------------------------------------------------
def _checkin_counts(checkins: DataFrame, **parts: Column) -> DataFrame:
    return checkins.groupBy(*[c.alias(name) for name, c in parts.items()]).agg(
        _count("BusinessID", "CheckinCount")
    )


def checkin_heatmap(checkins: DataFrame) -> DataFrame:
    at = F.col("CheckinDate")
    return _checkin_counts(
        checkins,
        CheckinWeekDayNo=dates.weekday_no(at),
        CheckinWeekDayName=dates.weekday_name(at),
        CheckinHour=dates.hour(at),
    ).orderBy("CheckinWeekDayNo", "CheckinHour")


def checkin_months(checkins: DataFrame) -> DataFrame:
    at = F.col("CheckinDate")
    return _checkin_counts(
        checkins, MonthNo=dates.month_no(at), MonthName=dates.month_name(at)
    ).orderBy("MonthNo")


def checkin_days(checkins: DataFrame) -> DataFrame:
    at = F.col("CheckinDate")
    return _checkin_counts(
        checkins, DayNo=dates.weekday_no(at), DayName=dates.weekday_name(at)
    ).orderBy("DayNo")


def checkin_hours(checkins: DataFrame) -> DataFrame:
    return _checkin_counts(checkins, Hour=dates.hour(F.col("CheckinDate"))).orderBy("Hour")


# --- users ----------------------------------------------------------------------
def users_by_year(users: DataFrame) -> DataFrame:
    by_year = users.groupBy(F.year("YelpingSince").alias("Year"))
    return by_year.agg(_count("UserID", "UsersCount")).orderBy("Year")


def users_by_review_range(users: DataFrame, width: int = REVIEW_RANGE) -> DataFrame:
    start = F.col("StartRange")
    counts = users.groupBy(bucket_start(F.col("ReviewCount"), width).alias("StartRange")).agg(
        _count("UserID", "UserCount")
    )
    return counts.select(range_label(start, width).alias("ReviewNo"), "UserCount").orderBy(
        counts["StartRange"]
    )


def users_by_star(users: DataFrame) -> DataFrame:
    by_star = users.groupBy(F.floor("AverageStars").alias("Stars"))
    return by_star.agg(_count("UserID", "UsersCount")).orderBy("Stars")


# --- reviews --------------------------------------------------------------------
def reviews_by_year(reviews: DataFrame) -> DataFrame:
    by_year = reviews.groupBy(F.year("Date").alias("Year"))
    return by_year.agg(_count("BusinessID", "ReviewCount")).orderBy("Year")


def reviews_by_rating_date(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("ReviewStars", "Date").agg(_count("ReviewStars", "Count"))
