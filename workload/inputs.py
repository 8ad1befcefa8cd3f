"""The library's tables, derived from the given ones.

Each function has a SQL twin of the same name in ``oracle.INPUTS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ends of reviews, dealt out by their ids: a case of each rule of the sentiment model.
REMARKS = (
    "The food was never so good!",
    "The least good of them all, I say.",
    "Simply put kind of good :) but not that great",
    "Sure they cut the mustard, yeah right...",
    "Seen at least good and sort of bad!!",
    "It isn't no good, really very bad?",
    "That was really the bomb (so \"great\") ??",
    "'Kind' words? And this kind of great :( without good",
    "x y z great I",
    "Never was this good, hardly that bad ???",
    "good but bad but great",
    "very least good, so so bad!!!!!!",
)
#: Valences of words in the remarks.
VALENCES = (("good", 1.9), ("bad", -2.5), ("great", 3.1), ("kind", 2.4), ("no", -1.2), ("bomb", -2.2), ("mustard", 0.5),
            ("right", 1.0), (":)", 2.0), (":(", -1.9), ("so", 0.4), ("i", 3.0))


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def business(self) -> DataFrame:
        key = F.col("s_suppkey")
        kind = F.when(key % 4 == 0, "Restaurants, Food, Italian").when(
            key % 4 == 1, "Food, Restaurants, Asian Fusion"
        ).when(key % 4 == 2, "Shopping, Fast Food").otherwise("Restaurants, Fast Food, Chinese")
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("supplier")
            .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("BusinessID"),
                F.col("s_name").alias("Name"),
                F.col("n_name").alias("City"),
                F.col("r_name").alias("State"),
                F.concat(F.lit("M"), "n_nationkey", F.lit("A "), key % 10, F.lit("B1")).alias("PostalCode"),
                (F.lit(43.0) + (key % 50) / F.lit(100.0)).alias("Latitude"),
                (F.lit(-79.0) - (key % 40) / F.lit(100.0)).alias("Longitude"),
                ((key % 9 + 2) / F.lit(2.0)).alias("BusinessStars"),
                kind.alias("Categories"),
                (key % 97).alias("ReviewCount"),
                F.when(key % 5 == 0, 0).otherwise(1).alias("is_open"),
            )
        )

    def review(self) -> DataFrame:
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ReviewID"),
                F.col("o_custkey").alias("UserID"),
                F.col("l_suppkey").alias("BusinessID"),
                F.ceil(F.col("l_quantity") / 10).cast("int").alias("ReviewStars"),
                F.to_date("l_shipdate").alias("Date"),
            )
        )

    def user(self) -> DataFrame:
        spent = self.table("orders").groupBy("o_custkey").agg(
            F.count("o_orderkey").alias("n"),
            F.min("o_orderdate").alias("since"),
            F.avg("o_totalprice").alias("mean"),
        )
        return (
            self.table("customer")
            .join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(
                F.col("c_custkey").alias("UserID"),
                F.col("c_name").alias("UserName"),
                F.coalesce("n", F.lit(0)).cast("long").alias("ReviewCount"),
                F.to_date("since").alias("YelpingSince"),
                F.round(1 + F.col("mean") / 125000, 2).alias("AverageStars"),
            )
        )

    def checkin(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("BusinessID"), F.col("ts").alias("CheckinDate")
        )

    def text(self) -> DataFrame:
        """Every document is a review of the business its source is numbered after."""
        return self.table("documents").select(
            F.col("doc_id").alias("ReviewID"),
            F.replace("source", F.lit("src"), F.lit("")).cast("long").alias("BusinessID"),
            F.col("text").alias("Review"),
        )

    def spread_text(self) -> DataFrame:
        """The same reviews, dealt out over all businesses."""
        businesses = self.table("supplier").agg(F.count("*")).scalar()
        return self.text().withColumn("BusinessID", F.col("ReviewID") % businesses)

    def raw_reviews(self) -> DataFrame:
        """The reviews under the field names of the raw file, with bad dates, blank and missing texts and unknown businesses."""
        number = F.col("ReviewID")
        month, day = (F.lpad((number % n + 1).cast("string"), 2, "0") for n in (12, 28))
        written = F.concat(number % 14 + 2010, F.lit("-"), month, F.lit("-"), day, F.lit(" 10:00:00"))
        date = F.when(number % 6 == 0, "yesterday").when(number % 6 == 1, "2024-13-45").when(number % 6 != 2, written)
        text = (
            F.when(number % 8 == 0, F.concat(F.lit("line one\nline two "), "Review"))
            .when(number % 8 == 1, " ")
            .when(number % 8 == 2, "\n ")
            .when(number % 8 != 3, F.col("Review"))
        )
        return self.text().select(
            number.alias("review_id"),
            (number % 50).alias("user_id"),
            F.when(number % 10 == 0, -1).otherwise(F.col("BusinessID")).alias("business_id"),
            ((number % 9 + 1) / 2.0).alias("stars"),
            text.alias("text"),
            (number % 4).alias("useful"),
            date.alias("date"),
        )

    def raw_users(self) -> DataFrame:
        """The users under the field names of the raw file, with bad and missing dates and names."""
        number = F.col("UserID")
        since = F.when(number % 5 == 0, "soon").when(number % 7 != 0, F.concat(F.col("YelpingSince").cast("string"), F.lit(" 08:30:00")))
        return self.user().select(
            number.alias("user_id"),
            F.when(number % 9 != 0, F.col("UserName")).alias("name"),
            *((number % n).alias(c) for n, c in ((7, "useful"), (5, "funny"), (3, "cool"))),
            F.col("ReviewCount").alias("review_count"),
            since.alias("yelping_since"),
            F.col("AverageStars").alias("average_stars"),
        )

    def remarks(self) -> DataFrame:
        """The same reviews, each with a remark at its end."""
        ends = F.get(F.array(*map(F.lit, REMARKS)), (F.col("ReviewID") % len(REMARKS)).cast("int"))
        return self.text().withColumn("Review", F.concat("Review", F.lit(" "), ends))

    def area(self) -> DataFrame:
        """Neighbourhood statistics, counted over the customers of each nation."""
        counts = self.table("customer").groupBy("c_nationkey").agg(
            F.count("*").alias("TotalPopulation"),
            F.count_if(F.col("c_mktsegment") == "HOUSEHOLD").alias("SouthAsian"),
            F.count_if(F.col("c_acctbal") > 0).alias("LabourForceCategory"),
            F.count_if(F.col("c_acctbal") > 2500).alias("working"),
        )
        return counts.join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("n_name").alias("Neighbourhood"),
            F.concat(F.lit("M"), "n_nationkey", F.lit("A")).alias("PostCode"),
            "TotalPopulation",
            "SouthAsian",
            "LabourForceCategory",
            F.when(F.col("n_nationkey") != 3, F.col("working")).alias("InLabourForce"),
        )

    def directory_pages(self) -> DataFrame:
        """The pages, each with a directory in a table that has spans and a table inside, and another table after it."""
        number = F.col("page_id")
        name = F.when(number % 3 == 0, "Not assigned").otherwise("East")
        table = F.concat(
            F.lit("<!-- <table> --><TABLE class='a'><thead><tr><th>Postcode</th><th>Borough</th><th>Neighbourhood</th></tr></thead>"),
            F.lit("<tr><td rowspan='2'>M"), number, F.lit("A</td><td><b>West</b></td><td>Area <table><tr><td>inner "), number,
            F.lit("</td></tr></table> end</td></tr><tr><td>"), name, F.lit("</td><td>Second</td></tr>"),
            F.lit("<tr><td colspan=2>M"), number, F.lit("B</td><td>Third &amp; more</td></tr></TABLE><table><tr><td>x</td></tr><tr><td>y</td></tr></table>"),
        )
        return self.table("pages").select("page_id", F.concat("html", table).alias("html"))

    def whole_attributes(self) -> DataFrame:
        """Attributes of each business, as one text; of some an inner object does not parse."""
        key = F.col("s_suppkey")
        casual = F.when(key % 2 == 0, "True").otherwise("False")
        whole = F.concat(
            F.lit('{"Price":"'),
            key % 4,
            F.lit('","WiFi":"'),
            F.when(key % 3 == 0, "None").otherwise("free"),
            F.lit('","Ambience":"{\'casual\': '),
            casual,
            F.when(key % 11 == 0, '"}').otherwise(", u'quiet': u'none'}\"}"),
        )
        return self.table("supplier").select(key.alias("BusinessID"), whole.alias("Attributes"))

    def attributes(self) -> DataFrame:
        """The same attributes, but for some businesses a text that does not parse as a whole, or none."""
        key = F.col("BusinessID")
        text = F.when(key % 17 == 0, None).when(key % 13 == 0, "free WiFi").otherwise(F.col("Attributes"))
        return self.whole_attributes().select("BusinessID", text.alias("Attributes"))

    def lexicon(self) -> DataFrame:
        """Valences for frequent words of the documents and for those of the remarks."""
        listed = ", ".join(f"('{token}', {value}D)" for token, value in VALENCES)
        return self.spark.sql(
            f"""select * from values ('the', 1.5D), ('and', -1.0D), ('that', 2.0D), ('with', -2.5D),
                ('les', 0.8D), ('und', -1.7D), {listed} as t(token, valence)"""
        )

    def sentiment(self) -> DataFrame:
        """Business side of the recommender with scores averaged over its ratings."""
        means = self.review().groupBy("BusinessID").agg(
            F.round(F.avg(F.when(F.col("ReviewStars") <= 2, 1.0).otherwise(0.0)), 2).alias("avg_neg"),
            F.round(F.avg(F.when(F.col("ReviewStars") == 3, 1.0).otherwise(0.0)), 2).alias("avg_neu"),
            F.round(F.avg(F.when(F.col("ReviewStars") >= 4, 1.0).otherwise(0.0)), 2).alias("avg_pos"),
            F.round(F.avg(F.col("ReviewStars") / 5.0), 2).alias("avg_composite_score"),
        )
        places = self.business().select(
            "BusinessID",
            "Name",
            F.regexp_replace("PostalCode", " ", "").alias("ZipCode"),
            "Latitude",
            "Longitude",
        )
        return means.join(places, "BusinessID")
