"""Businesses against neighbourhood statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuekit.functions.numbers import number
from venuekit.functions.text import postcode_area
from venuekit.operators.aggregates import weighted_mean
from venuekit.operators.filters import city_filter, without_placeholders
from venuekit.operators.rows import html_table
from venuekit.sources.readers import normalise_headers
from venuekit.sources.schemas import LABOUR_COUNTS, POPULATION_GROUPS

# Marker of an empty directory entry and columns of no interest.
NOT_ASSIGNED = "Not assigned"
DIRECTORY_COLUMNS = ("Postcode", "Borough", "Neighbourhood")
UNUSED_LABOUR = ("CombinedIndicators", "Borough", "TotalPopulation")


def clean_directory(directory: DataFrame) -> DataFrame:
    """Postcode directory without entries that name no borough or neighbourhood."""
    directory = normalise_headers(directory)
    for column in ("Borough", "Neighbourhood"):
        directory = without_placeholders(directory, column, [NOT_ASSIGNED])
    return directory


def directory_from_pages(pages: DataFrame, key: str, html: str) -> DataFrame:
    """The directory out of stored HTML pages that hold it as their first table."""
    table = html_table(pages, key, html, DIRECTORY_COLUMNS)
    return clean_directory(table.select(*DIRECTORY_COLUMNS))


def share_of_total(df: DataFrame, total: str, groups: Sequence[str] = POPULATION_GROUPS) -> DataFrame:
    """Divide each listed group that the table has by its total; zero gives NULL."""
    present = [c for c in df.columns if c in groups]
    return df.withColumns(
        {c: F.try_divide(number(F.col(c)), number(F.col(total))) for c in present}
    )


def with_area(business: DataFrame) -> DataFrame:
    return business.withColumn("PostCode", postcode_area(F.col("PostalCode")))


def _located(statistics: DataFrame, directory: DataFrame) -> DataFrame:
    """Statistics with the postcode of their neighbourhood; several rows if it has several."""
    named = directory.withColumnRenamed("Postcode", "PostCode")
    return statistics.join(named, "Neighbourhood", "left")


def cuisine_area_share(
    business: DataFrame,
    directory: DataFrame,
    ethnicity: DataFrame,
    city: str | None,
    cuisine: str,
    group: str,
    total: str = "Total Population",
    groups: Sequence[str] = POPULATION_GROUPS,
) -> DataFrame:
    """Businesses of one cuisine with a population group's share of their area, best first."""
    stats = _located(normalise_headers(ethnicity), directory)
    shares = share_of_total(stats.select("Neighbourhood", total, group, "PostCode"), total, groups)
    chosen = city_filter(business, city, match="like").where(F.col("Categories").contains(cuisine))
    return (
        with_area(chosen)
        .join(shares, "PostCode", "left")
        .select(
            "BusinessID", "Name", "Latitude", "Longitude", "BusinessStars", "Neighbourhood", group
        )
        # Stars have few values: the other keys give the range sort something to cut by.
        .orderBy(F.desc("BusinessStars"), "BusinessID", "Neighbourhood")
    )


def area_employment_stars(
    business: DataFrame, directory: DataFrame, labour: DataFrame, city: str | None
) -> DataFrame:
    """Mean stars and mean share in work per neighbourhood.

    Only rows count in which no column of either side is NULL.  Businesses are
    folded to one row per postcode area before the join, so an area that holds
    most of them is no larger than another.
    """
    located = _located(normalise_headers(labour, squeeze=True), directory).drop(*UNUSED_LABOUR)
    counts = [c for c in LABOUR_COUNTS if c in located.columns]
    located = located.withColumns({c: number(F.col(c), "int") for c in counts}).dropna("any")
    per_area = (
        with_area(city_filter(business, city, match="like"))
        .dropna("any")
        .groupBy("PostCode")
        .agg(F.sum(F.col("BusinessStars").cast("double")).alias("stars"), F.count("*").alias("n"))
    )
    ratio = F.try_divide(F.col("InLabourForce"), F.col("LabourForceCategory"))
    return (
        per_area.join(located, "PostCode")
        .withColumn("ratio", ratio)
        .groupBy("Neighbourhood")
        .agg(
            F.try_divide(F.sum("stars"), F.sum("n")).alias("BusinessStars"),
            weighted_mean(F.col("ratio"), F.col("n")).alias("ratio_emply"),
        )
    )
