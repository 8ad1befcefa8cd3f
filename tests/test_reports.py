import datetime as dt

import pytest
from pyspark.sql import functions as F

from venuekit.operators.rows import html_table
from venuekit.plans import areas, reports

T = dt.datetime


def test_there_are_52_cuisines():
    assert len(set(reports.CUISINES)) == len(reports.CUISINES) == 52


@pytest.fixture(scope="module")
def business(spark):
    data = [
        ("b1", "One", "Toronto", "ON", "M5V 1A1", 43.0, -79.0, 4.5, "Food, Asian Fusion, Indian", 5),
        ("b2", "Two", "Toronto", "ON", "M5V 2B2", 43.1, -79.1, 3.0, "Food, Italian", 7),
        ("b3", "Three", "North Toronto", "ON", "M1B 2B2", 43.2, -79.2, 2.0, "Indian, Food", 1),
        ("b4", "Four", "Calgary", "AB", "T2P 1A1", 51.0, -114.0, 5.0, "Italian, Food", 9),
    ]
    schema = (
        "BusinessID string, Name string, City string, State string, PostalCode string, Latitude double, "
        "Longitude double, BusinessStars double, Categories string, ReviewCount long"
    )
    return spark.createDataFrame(data, schema)


def test_cuisines_are_counted_per_state_with_ties_by_name(business):
    got = [tuple(r) for r in reports.cuisines_by_state(business, "ON").collect()]
    assert got == [(2, "ON", "Indian"), (1, "ON", "AsianFusion"), (1, "ON", "Italian")]


def test_star_map(business, rows):
    got = reports.city_star_map(business, "Toronto")
    assert rows(got.select("BusinessID", "ZipCode", "Stars")) == [("b1", "M5V1A1", 4), ("b2", "M5V2B2", 3)]


def test_counts_and_means(business):
    assert [tuple(r) for r in reports.city_counts(business).collect()] == [
        ("ON", "Toronto", 2),
        ("AB", "Calgary", 1),
        ("ON", "North Toronto", 1),
    ]
    means = [tuple(r) for r in reports.state_avg_stars(business).collect()]
    assert means == [("AB", 5.0), ("ON", pytest.approx(9.5 / 3))]


def test_attribute_reports(spark, rows):
    attributes = spark.createDataFrame(
        [
            ("b1", "WiFi", "free"),
            ("b2", "WiFi", "free"),
            ("b3", "WiFi", "paid"),
            ("b1", "Ambience_casual", "True"),
            ("b2", "Ambience_casual", "False"),
            ("b3", "Ambience", "True"),
        ],
        "BusinessID string, attr_key string, attr_val string",
    )
    assert rows(reports.attr_value_counts(attributes, "WiFi")) == [("free", 2), ("paid", 1)]
    # A flag without a sub-name counts under NULL.
    assert rows(reports.attr_flag_counts(attributes, "Ambience")) == [("casual", 1), (None, 1)]


def test_checkin_reports(spark):
    checkins = spark.createDataFrame(
        [("b", T(2018, 12, 31, 9)), ("b", T(2019, 1, 6, 9)), ("b", T(2019, 1, 6, 22))],
        "BusinessID string, CheckinDate timestamp",
    )
    assert [tuple(r) for r in reports.checkin_heatmap(checkins).collect()] == [
        (1, "Mon", "09", 1),
        (7, "Sun", "09", 1),
        (7, "Sun", "22", 1),
    ]
    assert [tuple(r) for r in reports.checkin_months(checkins).collect()] == [("01", "Jan", 2), ("12", "Dec", 1)]
    assert [tuple(r) for r in reports.checkin_days(checkins).collect()] == [(1, "Mon", 1), (7, "Sun", 2)]
    assert [tuple(r) for r in reports.checkin_hours(checkins).collect()] == [("09", 2), ("22", 1)]


def test_calendar_year_is_not_the_week_year(spark):
    reviews = spark.createDataFrame([("b", dt.date(2018, 12, 31))], "BusinessID string, Date date")
    assert [tuple(r) for r in reports.reviews_by_year(reviews).collect()] == [(2018, 1)]


def test_user_ranges_sort_by_number(spark):
    counts = (9, 10, 19, 100, 25)
    users = spark.createDataFrame([(str(n), n) for n in counts], "UserID string, ReviewCount long")
    got = [tuple(r) for r in reports.users_by_review_range(users).collect()]
    assert got == [("0-9", 1), ("10-19", 2), ("20-29", 1), ("100-109", 1)]


@pytest.fixture(scope="module")
def directory(spark):
    data = [
        ("M5V", "Downtown", "Harbour"),
        ("M5V", "Downtown", "Island"),
        ("M1B", "East", "Rouge"),
        ("M9Z", "Not assigned", "Nowhere"),
        ("M9Y", "West", "Not assigned"),
    ]
    raw = spark.createDataFrame(data, "` Postcode` string, `Borough ` string, Neighbourhood string")
    return areas.clean_directory(raw)


def test_directory(directory, rows):
    assert directory.columns == ["Postcode", "Borough", "Neighbourhood"]
    assert [r[0] for r in rows(directory)] == ["M1B", "M5V", "M5V"]


def test_directory_from_pages(spark, rows):
    html = """<h1>x</h1><table class="w"><tr><th>Postcode</th><th>Borough</th><th>Neighbourhood</th></tr>
      <tr><td>M1A</td><td>Not assigned</td><td>Not assigned</td></tr>
      <TR><td>M3A</td><td><a href="/n">North
      York</a></td><td>Parkwoods &amp; Sons &amp;lt;</td></TR></table>
      <table><tr><td>h</td></tr><tr><td>other</td></tr></table>"""
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "id int, html string")
    assert rows(areas.directory_from_pages(pages, "id", "html")) == [("M3A", "North York", "Parkwoods & Sons &lt;")]


TABLES = {
    "plain": ("<table><tr><th>h</th></tr><tr><td>a</td><td>b</td></tr></table>", [("a", "b", None)]),
    "nested": (
        "<table><tr><td>h</td></tr><tr><td>x<table><tr><td>1</td><td>2</td></tr></table>y</td><td>z</td></tr><tr><td>w</td></tr></table>",
        [("x 1 2 y", "z", None), ("w", None, None)],
    ),
    "spans": (
        "<table><tr><th colspan=3>h</th></tr><tr><td rowspan=3>a</td><td colspan='2'>b</td></tr><tr><td>c</td><td rowspan=\"2\">d</td></tr><tr><td>e</td></tr><tr><td>f</td></tr></table>",
        [("a", "b", "b"), ("a", "c", "d"), ("a", "e", "d"), ("f", None, None)],
    ),
    "to the end": ("<table><tr><td rowspan=0>h</td><td>i</td></tr><tr><td>a</td></tr><tr></tr><tr><td>b</td></tr></table>", [("h", "a", None), ("h", None, None), ("h", "b", None)]),
    "no end tags": ("<table><tr><td>h<tr><td>a<td>b<tr><td>c", [("a", "b", None), ("c", None, None)]),
    "stray end": ("</table></td><table><tr><td>h</td></tr><tr><td>a</td></tr></table>", [("a", None, None)]),
    "not a table": ("<!-- <table><tr><td>h</td></tr><tr><td>a</td></tr></table> --><script>'<table>'</script><p>x", []),
    "between": ("<table>no<tr>no<td>h</td>no</tr>no<tr><td>a</td>no<td>b</td></tr></table>", [("a", "b", None)]),
    "second": ("<table><tr><td>h</td></tr></table><table><tr><td>i</td></tr><tr><td>a</td></tr></table>", []),
    "none": (None, []),
    "empty": ("", []),
}


def test_tables_as_they_nest(spark):
    pages = spark.createDataFrame([(k, html) for k, (html, _) in TABLES.items()], "id string, html string")
    found = {k: [] for k in TABLES}
    # pages of one key are pages of their own
    for r in html_table(pages.unionAll(pages), "id", "html", ("x", "y", "z")).orderBy("id", "pos").collect():
        found[r.id].append((r.x, r.y, r.z))
    assert found == {k: [row for row in rows for _ in range(2)] for k, (_, rows) in TABLES.items()}
    assert [r.x for r in html_table(pages.where("id = 'second'"), "id", "html", ("x",), number=2).collect()] == ["a"]


def test_a_long_table_is_read_whole(spark):
    body = "".join(f"<tr><td>{n}</td><td rowspan=2>{n}</td></tr>" for n in range(3000))
    pages = spark.createDataFrame([(1, f"<table><tr><td>h</td></tr>{body}</table>" + "<" * 100_000)], "id int, html string")
    found = html_table(pages, "id", "html", ("x", "y"))
    assert found.count() == 3000 and found.where("pos = 3000").first().x == "2999"


def test_cuisine_share(spark, business, directory):
    ethnicity = spark.createDataFrame(
        [("Harbour", "200", "50"), ("Island", "0", "5"), ("Rouge", None, "5")],
        "Neighbourhood string, ` Total Population` string, `South Asian ` string",
    )
    got = areas.cuisine_area_share(business, directory, ethnicity, "Toronto", "Indian", "South Asian")
    # One postcode may have several neighbourhoods; a zero or unknown total gives no share.
    assert [(r.BusinessID, r.Neighbourhood, r["South Asian"]) for r in got.collect()] == [
        ("b1", "Harbour", 0.25),
        ("b1", "Island", None),
        ("b3", "Rouge", None),
    ]


@pytest.mark.parametrize("headers", [("Labour Force Category ", " In Labour Force"), ("LabourForceCategory", "InLabourForce")])
def test_employment(spark, business, directory, rows, headers):
    labour = spark.createDataFrame(
        [("Harbour", "1", "100", "60"), ("Island", "2", "0", "5"), ("Rouge", "3", "1,234", "5")],
        "Neighbourhood string, Id string, a string, b string",
    ).toDF("Neighbourhood", "Neighbourhood Id", *headers)
    got = areas.area_employment_stars(business, directory, labour, "Toronto")
    # Division by zero gives no ratio; a number that does not parse drops its row.
    assert rows(got) == [("Harbour", 3.75, 0.6), ("Island", 3.75, None)]


def test_employment_equals_the_unfolded_form(spark, business, directory, rows):
    labour = spark.createDataFrame(
        [("Harbour", 100, 60), ("Island", 50, 40), ("Rouge", 10, 5)],
        "Neighbourhood string, LabourForceCategory int, InLabourForce int",
    )
    got = areas.area_employment_stars(business, directory, labour, "Toronto")
    joined = areas.with_area(business.where(F.col("City").contains("Toronto"))).join(
        labour.join(directory.withColumnRenamed("Postcode", "PostCode"), "Neighbourhood"), "PostCode"
    )
    plain = joined.groupBy("Neighbourhood").agg(
        F.avg("BusinessStars"), F.avg(F.col("InLabourForce") / F.col("LabourForceCategory"))
    )
    assert [r[0] for r in rows(got)] == [r[0] for r in rows(plain)]
    for a, b in zip(rows(got), rows(plain)):
        assert a[1:] == pytest.approx(b[1:])
