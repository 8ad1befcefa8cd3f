"""All jobs, one after another, from raw files to recommendations."""

import json

import pytest

from venuekit import jobs
from venuekit.sources import scratch
from venuekit.sources.readers import read_csv

PHRASES = ("good soup and great service", "bad cold noodles", "slow kitchen but good cake", "not bad at all!")


BROKEN = {
    "business": ['{"business_id": "b99", "name": "Half', "not json at all", '{"business_id": "b98", "latitude": "north"}'],
    "review": ['{"review_id": "r999", "stars": {"a": 1}}', "[1, 2", "plain text"],
    "user": ['{"user_id": "u99", "review_count": "many"}'],
    "checkin": ['{"business_id": "b1", "date": "2018-12-31 10:00:00"'],
    "province": ["{"],
}


def lines(path, records):
    """Records with broken lines between them."""
    text = [json.dumps(r) for r in records]
    for n, line in enumerate(BROKEN.get(path.stem, [])):
        text.insert(n * 2 + 1, line)
    path.write_text("".join(f"{line}\n" for line in text))
    return str(path)


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    out = str(root / "out")
    business = [
        {
            "address": "x",
            "attributes": json.dumps({"WiFi": "u'free'", "Ambience": "{'casual': True}"}),
            "business_id": f"b{n}",
            "categories": "Restaurants, Food, Indian" if n % 2 else "Food, Restaurants, Fast Food",
            "city": "Toronto",
            "hours": None,
            "is_open": int(n != 0),
            "latitude": 43 + n / 100,
            "longitude": -79.0,
            "name": f"Name {n}",
            "postal_code": f"M{n % 3}V 1A{n % 10}",
            "review_count": n,
            "stars": 1 + n % 9 / 2,
            "state": "ON",
        }
        for n in range(24)
    ]
    reviews = [
        {
            "review_id": f"r{n}",
            "user_id": f"u{n % 40:02}",
            "business_id": f"b{n * 7 % 24}",
            "date": f"201{n % 9}-0{1 + n % 9}-1{n % 10} 10:00:00",
            "stars": float(1 + n % 5),
            "text": f"{PHRASES[n % 4]}, visit {n}",
            "useful": 0,
        }
        for n in range(400)
    ]
    users = [
        {
            "user_id": f"u{n:02}",
            "name": f"U{n}",
            "useful": 1,
            "funny": 1,
            "cool": 1,
            "review_count": n,
            "yelping_since": f"201{n % 9}-01-01 00:00:00",
            "average_stars": 1 + n % 9 / 2,
        }
        for n in range(50)
    ]
    checkins = [{"business_id": f"b{n}", "date": "2018-12-31 10:00:00, 2019-01-01 23:00:00"} for n in range(30)]
    path = {
        "business": lines(root / "business.json", business),
        "province": lines(root / "province.json", [{"code": c} for c in ("AB", "ON", "QC")]),
        "review": lines(root / "review.json", reviews),
        "user": lines(root / "user.json", users),
        "checkin": lines(root / "checkin.json", checkins),
    }
    files = {
        "lexicon": "token,valence\ngood,1.9\ngreat,3.1\nbad,-2.5\nodd,much\nslow,-1.2\n",
        "postcode": "Postcode,Borough,Neighbourhood\nM0V,West,A\nM1V,East,B\nM2V,North,C\n",
        "ethnicity": "Neighbourhood, Total Population,South Asian \nA,100,10\nB,200,50\nC,50,1\n",
        "only": "UserID\nu03\nu07\nnobody\n",
        "labour": "Neighbourhood,LabourForceCategory,InLabourForce\nA,100,60\nB,10,5\nC,x,5\n",
    }
    for name, text in files.items():
        (root / f"{name}.csv").write_text(text)
        path[name] = str(root / f"{name}.csv")
    table = {n: str(root / "parquet" / n) for n in ("Business", "Review", "Checkin", "User")}
    html = "<table><tr><th>p</th></tr><tr><td>M1V</td><td>East</td><td>B</td></tr></table>"
    spark.createDataFrame([(1, html)], "page_id int, html string").write.parquet(str(root / "pages"))

    patch = pytest.MonkeyPatch()
    patch.setattr(scratch, "shared_folder", lambda spark: str(root / "shared"))

    def run(*argv):
        jobs.run(spark, list(argv))
        assert not list((root / "shared").iterdir()), f"{argv[0]} left tables behind"

    (root / "shared").mkdir()

    run("business", path["business"], path["province"], table["Business"])
    run("review", table["Business"], path["review"], table["Review"], "--clean-text")
    run("checkin", table["Business"], path["checkin"], table["Checkin"])
    run("user", table["Review"], path["user"], table["User"])
    run("business-report", table["Business"], out, "--values", "WiFi", "--flags", "Ambience")
    run("checkin-report", table["Checkin"], out)
    run("user-report", table["User"], out)
    run("review-report", table["Review"], out)
    run("directory", str(root / "pages"), out)
    run("area-share", table["Business"], path["postcode"], path["ethnicity"], out)
    run("employment", table["Business"], path["labour"], path["postcode"], out)
    run("sentiment", table["Review"], table["Business"], path["lexicon"], out)
    run("topics", table["Review"], table["Business"], out)
    run("topic-long", f"{out}/Topic_low_business_topic_dist", f"{out}/Topic_high_business_topic_dist", out)
    run("train", f"{out}/BusinessSentiment", table["User"], table["Review"], out)
    run("recommend", f"{out}/BusinessSentiment", table["User"], table["Review"], f"{out}/TrainedModel", out, "--as-of", "2024-03-01")
    run("recommend", f"{out}/BusinessSentiment", table["User"], table["Review"], f"{out}/TrainedModel", str(root / "few"), "--as-of", "2024-03-01", "--only", path["only"])
    patch.undo()

    def read(name):
        return read_csv(spark, f"{out}/{name}")

    read.root, read.table = root, table
    return read


EXPECTED = {
    "BusinessTorontoStars": 23,
    "BusinessCusinesProvince_ON": 1,
    "BusinessCusinesProvince_AB": 0,
    "BusinessTopTenCategories": 4,
    "BusinessCities": 1,
    "BusinessProvinceAvgStars": 1,
    "BusinessWiFi": 1,
    "BusinessAmbience": 1,
    "CheckinMonths": 2,
    "CheckinDays": 2,
    "CheckinHours": 2,
    "CheckinHeatMap": 2,
    "UserYears": 9,
    "UserReviewCounts": 4,
    "ReviewYears": 9,
    "postcode": 1,
    "CuisineAreaShare": 12,
    "AreaEmploymentStars": 2,
    "BusinessSentiment": 23,
    "Topic_low_rating_topic": 6,
    "Topic_high_rating_topic": 6,
}


@pytest.mark.parametrize("name", EXPECTED)
def test_report(work, name):
    assert work(name).count() == EXPECTED[name]


def test_lines_that_are_no_records_come_back(work, spark):
    """Lines in = lines read + lines reported, in each job that reads raw files."""
    outputs = {name.lower(): path for name, path in work.table.items()} | {"province": work.table["Business"] + "Provinces"}
    for name, broken in BROKEN.items():
        found = spark.read.parquet(outputs[name] + jobs.UNREAD).collect()
        assert sorted(r.Text for r in found) == sorted(broken)
        assert all(r.File.endswith(f"/{name}.json") for r in found)
    assert [r.Text for r in work("LexiconUnread").collect()] == ["odd,much"]


def test_recommendations_for_the_users_asked_for(work, spark):
    every, few = work("TestModel"), read_csv(spark, str(work.root / "few" / "TestModel"))
    assert {r.UserID for r in few.collect()} == {"u03", "u07"} < {r.UserID for r in every.collect()}
    order = [f"{r.UserID}" for r in few.collect()]
    assert order == sorted(order)


def test_topic_rows(work):
    for cohort in ("low", "high"):
        shares = work(f"Topic_{cohort}_business_topic_dist")
        assert work(f"Topic_{cohort}_topic_exploded").count() == 6 * shares.count() > 0


def test_recommendations(work):
    got = work("TestModel").collect()
    assert got and all(0 <= float(r.FinalStar) <= 5 and 1 <= int(r["rank"]) <= 10 for r in got)


def test_every_job_ran_and_unknown_ones_fail():
    assert len(jobs.JOBS) == 16
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["nothing"])
