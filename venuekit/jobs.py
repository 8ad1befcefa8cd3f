"""Command line: ``python -m venuekit.jobs <name> ...`` or through spark-submit.

Each job reads its inputs, calls one plan and writes the result.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from venuekit.operators.joins import present_in
from venuekit.plans import areas, clean, recommend, reports, sentiment, topics
from venuekit.sources import schemas
from venuekit.sources.readers import read_csv, read_csv_checked, read_json_checked, read_parquet
from venuekit.sources.scratch import materialise, owned_tables
from venuekit.sources.writers import out_path, write_csv, write_ordered_csv, write_parquet

# City and states of the reports, names of the written datasets.
CITY = "Toronto"
STATES = ("AB", "ON", "QC")
STAR_MAP = "BusinessTorontoStars"
STATE_CUISINES = "BusinessCusinesProvince_{state}"
TOP_CATEGORIES = "BusinessTopTenCategories"
CITY_COUNTS = "BusinessCities"
STATE_STARS = "BusinessProvinceAvgStars"
ATTRIBUTE = "Business{key}"
CHECKIN_MONTHS = "CheckinMonths"
CHECKIN_DAYS = "CheckinDays"
CHECKIN_HOURS = "CheckinHours"
CHECKIN_HEATMAP = "CheckinHeatMap"
USER_YEARS = "UserYears"
USER_RANGES = "UserReviewCounts"
USER_STARS = "UserStarCounts"
REVIEW_YEARS = "ReviewYears"
REVIEW_RATINGS = "ReviewOverYears"
DIRECTORY = "postcode"
AREA_SHARE = "CuisineAreaShare"
AREA_EMPLOYMENT = "AreaEmploymentStars"
REVIEW_SCORES = "Sentiment_for_alltext"
BUSINESS_SCORES = "BusinessSentiment"
LEXICON_UNREAD = "LexiconUnread"
TOPIC_SHARES = "Topic_{cohort}_business_topic_dist"
TOPIC_WORDS = "Topic_{cohort}_rating_topic"
TOPIC_ROWS = "Topic_{cohort}_topic_exploded"
MODEL = "TrainedModel"
RECOMMENDATIONS = "TestModel"
LEFT_OUT = "TrainingLeftOut"
UNSCORED = "Unscored"

UNREAD = "Unread"

Job = Callable[[SparkSession, argparse.Namespace], None]


def _records(spark: SparkSession, path: str, schema: StructType, output: str) -> DataFrame:
    """The records of a raw file; its lines that are none are written beside the output."""
    found = read_json_checked(spark, path, schema)
    write_parquet(found.unread, output + UNREAD)
    return found.rows


def business(spark: SparkSession, a: argparse.Namespace) -> None:
    raw = _records(spark, a.business, schemas.RAW_BUSINESS, a.output)
    provinces = _records(spark, a.province, schemas.RAW_PROVINCE, a.output + "Provinces")
    kept = materialise(clean.open_businesses(raw, provinces), "businesses")  # read by four writes
    tables = clean.build_business(kept)
    write_parquet(tables.business, a.output)
    write_parquet(tables.attributes, a.output + "Attributes")
    write_parquet(tables.categories, a.output + "Categories")
    write_parquet(tables.unread, a.output + "UnreadAttributes")


def review(spark: SparkSession, a: argparse.Namespace) -> None:
    raw = _records(spark, a.review, schemas.RAW_REVIEW, a.output)
    write_parquet(clean.build_reviews(raw, read_parquet(spark, a.business), a.clean_text), a.output)


def checkin(spark: SparkSession, a: argparse.Namespace) -> None:
    raw = _records(spark, a.checkin, schemas.RAW_CHECKIN, a.output)
    write_parquet(clean.build_checkins(raw, read_parquet(spark, a.business)), a.output)


def user(spark: SparkSession, a: argparse.Namespace) -> None:
    raw = _records(spark, a.user, schemas.RAW_USER, a.output)
    write_parquet(clean.build_users(raw, read_parquet(spark, a.review)), a.output)


def business_report(spark: SparkSession, a: argparse.Namespace) -> None:
    table = read_parquet(spark, a.business)
    categories = read_parquet(spark, a.business + "Categories")
    attributes = read_parquet(spark, a.business + "Attributes")
    products = [
        (STAR_MAP, reports.city_star_map(table, a.city)),
        *[(STATE_CUISINES.format(state=s), reports.cuisines_by_state(table, s)) for s in STATES],
        (TOP_CATEGORIES, reports.top_categories(categories)),
        (CITY_COUNTS, reports.city_counts(table)),
        (STATE_STARS, reports.state_avg_stars(table)),
        *[(ATTRIBUTE.format(key=k), reports.attr_value_counts(attributes, k)) for k in a.values],
        *[(ATTRIBUTE.format(key=k), reports.attr_flag_counts(attributes, k)) for k in a.flags],
    ]
    for name, df in products:
        write_csv(df, out_path(a.output, name))


def checkin_report(spark: SparkSession, a: argparse.Namespace) -> None:
    table = read_parquet(spark, a.checkin)
    write_csv(reports.checkin_months(table), out_path(a.output, CHECKIN_MONTHS))
    write_csv(reports.checkin_days(table), out_path(a.output, CHECKIN_DAYS))
    write_csv(reports.checkin_hours(table), out_path(a.output, CHECKIN_HOURS))
    write_csv(reports.checkin_heatmap(table), out_path(a.output, CHECKIN_HEATMAP))


def user_report(spark: SparkSession, a: argparse.Namespace) -> None:
    table = read_parquet(spark, a.user)
    write_csv(reports.users_by_year(table), out_path(a.output, USER_YEARS))
    write_csv(reports.users_by_review_range(table), out_path(a.output, USER_RANGES))
    write_csv(reports.users_by_star(table), out_path(a.output, USER_STARS))


def review_report(spark: SparkSession, a: argparse.Namespace) -> None:
    table = read_parquet(spark, a.review)
    write_csv(reports.reviews_by_year(table), out_path(a.output, REVIEW_YEARS))
    write_csv(reports.reviews_by_rating_date(table), out_path(a.output, REVIEW_RATINGS))


def directory(spark: SparkSession, a: argparse.Namespace) -> None:
    pages = read_parquet(spark, a.pages)
    found = areas.directory_from_pages(pages, a.key, a.html)
    write_csv(found, out_path(a.output, DIRECTORY))


def area_share(spark: SparkSession, a: argparse.Namespace) -> None:
    df = areas.cuisine_area_share(
        read_parquet(spark, a.business),
        read_csv(spark, a.postcode),
        read_csv(spark, a.ethnicity),
        a.city,
        a.cuisine,
        a.group,
    )
    write_csv(df, out_path(a.output, AREA_SHARE))


def employment(spark: SparkSession, a: argparse.Namespace) -> None:
    df = areas.area_employment_stars(
        read_parquet(spark, a.business),
        read_csv(spark, a.postcode),
        read_csv(spark, a.labour),
        a.city,
    )
    write_csv(df, out_path(a.output, AREA_EMPLOYMENT))


def sentiment_scores(spark: SparkSession, a: argparse.Namespace) -> None:
    reviews, table = read_parquet(spark, a.review), read_parquet(spark, a.business)
    words = read_csv_checked(spark, a.lexicon, schemas.LEXICON)
    write_csv(words.unread, out_path(a.output, LEXICON_UNREAD))
    scores = materialise(sentiment.city_scores(reviews, table, words.rows, a.city), "scores")  # read by two writes
    write_csv(sentiment.with_texts(scores, reviews, table, a.city), out_path(a.output, REVIEW_SCORES))
    means = sentiment.business_means(scores, table, a.city)
    write_csv(means, out_path(a.output, BUSINESS_SCORES))


def topic_model(spark: SparkSession, a: argparse.Namespace) -> None:
    found = topics.cohort_topics(
        read_parquet(spark, a.review), read_parquet(spark, a.business), a.city
    )
    for cohort, model in found.items():
        shares = topics.distribution_text(model.distribution)
        write_csv(shares, out_path(a.output, TOPIC_SHARES.format(cohort=cohort)))
        words = model.words.withColumn(
            "topic_word", F.concat(F.lit("["), F.array_join("topic_word", ", "), F.lit("]"))
        )
        write_csv(words, out_path(a.output, TOPIC_WORDS.format(cohort=cohort)), single_file=True)


def topic_long(spark: SparkSession, a: argparse.Namespace) -> None:
    for cohort, path in (("low", a.low), ("high", a.high)):
        rows = topics.topic_long_form(read_csv(spark, path))
        write_csv(rows, out_path(a.output, TOPIC_ROWS.format(cohort=cohort)))


def train(spark: SparkSession, a: argparse.Namespace) -> None:
    features = recommend.training_features(
        read_parquet(spark, a.review), read_parquet(spark, a.user), read_csv(spark, a.sentiment), every=True
    )
    trained = recommend.train(features, a.seed)
    recommend.save_model(trained.model, out_path(a.output, MODEL))
    write_csv(trained.left_out, out_path(a.output, LEFT_OUT))
    trained.metrics.show()


def recommendations(spark: SparkSession, a: argparse.Namespace) -> None:
    users = read_parquet(spark, a.user)
    if a.only:
        wanted = read_csv(spark, a.only).select("UserID")
        users = present_in(users, "UserID", wanted, "UserID")
    missing = recommend.unscored(users, read_csv(spark, a.sentiment))
    write_csv(missing, out_path(a.output, UNSCORED))
    best = recommend.recommend(
        recommend.load_model(a.model),
        users,
        read_parquet(spark, a.review),
        read_csv(spark, a.sentiment),
        a.as_of,
    )
    write_ordered_csv(best, out_path(a.output, RECOMMENDATIONS), F.asc("UserID"), F.asc("rank"))


# name -> (job, positional arguments)
JOBS: dict[str, tuple[Job, tuple[str, ...]]] = {
    "business": (business, ("business", "province", "output")),
    "review": (review, ("business", "review", "output")),
    "checkin": (checkin, ("business", "checkin", "output")),
    "user": (user, ("review", "user", "output")),
    "business-report": (business_report, ("business", "output")),
    "checkin-report": (checkin_report, ("checkin", "output")),
    "user-report": (user_report, ("user", "output")),
    "review-report": (review_report, ("review", "output")),
    "directory": (directory, ("pages", "output")),
    "area-share": (area_share, ("business", "postcode", "ethnicity", "output")),
    "employment": (employment, ("business", "labour", "postcode", "output")),
    "sentiment": (sentiment_scores, ("review", "business", "lexicon", "output")),
    "topics": (topic_model, ("review", "business", "output")),
    "topic-long": (topic_long, ("low", "high", "output")),
    "train": (train, ("sentiment", "user", "review", "output")),
    "recommend": (recommendations, ("sentiment", "user", "review", "model", "output")),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="venuekit.jobs", description=__doc__)
    names = top.add_subparsers(dest="job", required=True)
    sub = {}
    for name, (_, arguments) in JOBS.items():
        sub[name] = names.add_parser(name)
        for argument in arguments:
            sub[name].add_argument(argument)
    for name in ("business-report", "area-share", "employment", "sentiment", "topics"):
        sub[name].add_argument("--city", default=CITY)
    sub["review"].add_argument("--clean-text", action="store_true")
    sub["business-report"].add_argument("--values", nargs="*", default=[])
    sub["business-report"].add_argument("--flags", nargs="*", default=[])
    sub["directory"].add_argument("--key", default="page_id")
    sub["directory"].add_argument("--html", default="html")
    sub["area-share"].add_argument("--cuisine", default="Indian")
    sub["area-share"].add_argument("--group", default="South Asian")
    sub["train"].add_argument("--seed", type=int, default=42)
    sub["recommend"].add_argument("--only", help="CSV file with a column UserID: the users to serve, else all")
    sub["recommend"].add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    return top


def _run(spark: SparkSession, arguments: argparse.Namespace) -> None:
    # what a job stores on its way is deleted once its products are written
    with owned_tables(spark):
        JOBS[arguments.job][0](spark, arguments)


def run(spark: SparkSession, argv: list[str]) -> None:
    _run(spark, parser().parse_args(argv))


def main(argv: list[str] | None = None) -> None:
    arguments = parser().parse_args(argv)
    _run(SparkSession.builder.appName(f"venuekit-{arguments.job}").getOrCreate(), arguments)


if __name__ == "__main__":
    main()
