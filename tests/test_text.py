import math
import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from venuekit.operators import runs
from venuekit.plans import lda, sentiment, topics
from workload.inputs import REMARKS, Inputs

RULES = sentiment.Rules()
LINES = pa.schema([("key", pa.string()), ("part", pa.int32()), ("words", pa.list_(pa.string()))])


def by_hand(text, lexicon, rules=RULES):
    """The model word by word, as a check on the join form."""
    if text is None:
        return None, None, None, None
    text = "".join(c for c in text.lower() if 0 < ord(c) < 127)
    words = []
    for token in re.split("[ \t\n\x0b\f\r]+", text):
        if len(token) > 1:
            bare = token.strip(string.punctuation)
            words.append(token if token in lexicon or len(bare) < 2 else bare)
    at = lambda k: words[k] if 0 <= k < len(words) else None
    total = up = down = flat = 0.0
    for n, word in enumerate(words):
        value = lexicon.get(word, 0.0)
        if word in rules.stronger or word in rules.weaker or (word, at(n + 1)) == ("kind", "of"):
            value = 0.0
        elif word in lexicon:
            for back, decay in ((1, 1.0), (2, 0.95), (3, 0.9)):
                before = at(n - back)
                if before is None or before in lexicon:
                    continue
                step = 0.293 * decay * (-1 if value < 0 else 1)
                value += step * ((before in rules.stronger) - (before in rules.weaker))
                raised = [at(n - k) in ("so", "this") for k in (1, 2)]
                if back == 2 and before == "never" and raised[0]:
                    value *= 1.5
                elif back == 3 and (before == "never" and raised[1] or raised[0]):
                    value *= 1.25
                elif before in rules.negations or "n't" in before:
                    value *= -0.74
                if back == 3:
                    runs = [words[n - 2 + k : n + 1 + k] for k in (2, 0, -1)] + [words[n - 1 + k : n + 1 + k] for k in (1, 0, -1, -2)]
                    found = [rules.idioms[p] for p in map(" ".join, runs) if p in rules.idioms]
                    value = found[0] if found else value
                    if {" ".join(words[n - 2 : n]), " ".join(words[n - 3 : n - 1])} & set(rules.weaker_phrases):
                        value -= 0.293
            if at(n - 1) == "least" and "least" not in lexicon and at(n - 2) not in ("at", "very"):
                value *= -0.74
        if "but" in words:
            value *= 0.5 if n < words.index("but") else 1.5 if n > words.index("but") else 1.0
        total += value
        up += value + 1 if value > 0 else 0
        down += 1 - value if value < 0 else 0
        flat += value == 0
    marks = text.count("?")
    emphasis = min(text.count("!"), 4) * 0.292
    emphasis += 0 if marks <= 1 else marks * 0.18 if marks <= 3 else 0.96
    total += math.copysign(emphasis, total) if total else 0
    up, down = up + emphasis * (up > down), down + emphasis * (down > up)
    whole = up + down + flat or 1.0
    return down / whole, flat / whole, up / whole, total / math.sqrt(total * total + 15)


LEXICON = {"good": 1.9, "bad": -2.5, "great": 3.1, "slow": -1.2, "no": -1.2, "kind": 2.4, "bomb": -2.2, "mustard": 0.5, ":)": 2.0, "i": 3.0, "so": 0.4, "(good": 9.0}
TEXTS = [
    "The food was good",
    "The food was not good!",
    "It isn't bad, very very GOOD!!!!!!",
    "slightly slow but really great??",
    "good bad",
    "café was never so good ????? bad",
    "plain words only",
    "good but bad but great",
    "",
    "!!!",
    None,
    *REMARKS,
    "good (good (good) :) :( (:) x",
    "I x i y",
    "\x0bgood\fgood\tgood\rgood",
]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "token string, valence double")


def test_scores_equal_the_model_by_hand(spark, lexicon):
    reviews = spark.createDataFrame(list(enumerate(TEXTS)), "ReviewID int, Review string")
    got = {r.ReviewID: tuple(r)[1:] for r in sentiment.review_scores(reviews, lexicon).collect()}
    assert len(got) == len(TEXTS)
    for n, text in enumerate(TEXTS):
        assert got[n] == pytest.approx(by_hand(text, LEXICON), abs=6e-4), text


def test_random_texts_equal_the_model_by_hand(spark, lexicon):
    r = random.Random(5)
    words = [*LEXICON, *RULES.negations[-8:], "isn't", "very", "hardly", "never", "so", "this", "least", "at", "kind of", "sort of", "the bomb", "cut the mustard",
             "yeah right", "but", "plain", "words", "good!", "'bad'", "x"]
    texts = [" ".join(r.choices(words, k=r.randint(0, 14))) for _ in range(400)]
    reviews = spark.createDataFrame(list(enumerate(texts)), "ReviewID int, Review string")
    got = {x.ReviewID: tuple(x)[1:] for x in sentiment.review_scores(reviews, lexicon).collect()}
    for n, text in enumerate(texts):
        assert got[n] == pytest.approx(by_hand(text, LEXICON), abs=6e-4), text


CASES = [
    ("it was good", 1.9),
    ("it was very good", 1.9 + 0.293),
    ("it was kinda good", 1.9 - 0.293),
    ("it was very bad", -2.5 - 0.293),
    ("it was not good", 1.9 * -0.74),
    ("it wasn't bad", 2.5 * 0.74),
    ("bad not bad good", -2.5 + 2.5 * 0.74 + 1.9 * -0.74),  # listed words before another are passed over
    ("no good", -1.2 + 1.9),
    ("never this good", 1.9 * 1.5),
    ("never that this good", 1.9 * 1.25),
    ("we call it least good", 1.9 * -0.74),
    ("we call it at least good", 1.9),
    ("it was sort of good", 1.9 - 0.293),
    ("what kind of thing", 0.0),
    ("this was really the bomb", 3.0),
    ("they really cut the mustard", 2.0),
    ("the bomb", -2.2),  # idioms are looked for from the fourth word on
    ("x I i good", 1.9),  # words of one letter do not count
    ("fine :) fine", 2.0),
    ("fine (good fine", 9.0),  # listed as it stands
    ("fine good) fine", 1.9),
    ("good, but bad", 0.5 * 1.9 + 1.5 * -2.5),
]


def test_each_rule(spark, lexicon):
    reviews = spark.createDataFrame([(n, text) for n, (text, _) in enumerate(CASES)], "ReviewID int, Review string")
    got = {r.ReviewID: r.Over_all for r in sentiment.review_scores(reviews, lexicon).collect()}
    for n, (text, want) in enumerate(CASES):
        # the sum that the score was squashed from
        assert got[n] * math.sqrt(15 / (1 - got[n] ** 2)) == pytest.approx(want, abs=0.01), text


def test_texts_are_not_shuffled(spark, lexicon):
    reviews = spark.createDataFrame([(1, "good")], "ReviewID int, Review string")
    plan = sentiment.review_scores(reviews, lexicon)._jdf.queryExecution().optimizedPlan().toString()
    windows = plan[: plan.index("Generate")]
    assert "Window" in windows and "Review#" not in windows and "_words" not in windows and "_bare" not in windows
    assert plan.count("Join LeftOuter") == 1


def test_long_and_repeated_texts_are_scored_whole(spark, lexicon):
    long = " ".join(["word"] * 30000 + ["bad"])
    reviews = spark.createDataFrame([(1, long), (2, "good"), (3, "good")], "ReviewID int, Review string")
    got = {r.ReviewID: r.Over_all for r in sentiment.review_scores(reviews, lexicon).collect()}
    assert got[1] < 0 and got[2] == got[3] > 0


def test_a_megabyte_of_apostrophes_is_scored(spark, lexicon):
    long = ["a'" * (1 << 19) + "a", "a" + "!" * (1 << 20) + "a", "'" * (1 << 20), "good " * (1 << 17) + "bad"]
    reviews = spark.createDataFrame([*enumerate(long), (9, "good")], "ReviewID int, Review string")
    got = {r.ReviewID: r.Over_all for r in sentiment.review_scores(reviews, lexicon).collect()}
    assert set(got) == {0, 1, 2, 3, 9} and got[0] == got[1] == got[2] == 0 and got[3] == 1.0


def test_a_token_listed_twice_counts_once(spark, lexicon, rows):
    reviews = spark.createDataFrame(list(enumerate(TEXTS)), "ReviewID int, Review string")
    twice = sentiment.review_scores(reviews, lexicon.unionAll(lexicon))
    assert rows(twice) == rows(sentiment.review_scores(reviews, lexicon))


def test_means_per_business_of_a_city(spark, lexicon, rows):
    business = spark.createDataFrame(
        [("b1", "One", "Toronto", "M5V 1A1", 43.0, -79.0), ("b2", "Two", "Calgary", "T2P 1A1", 51.0, -114.0)],
        "BusinessID string, Name string, City string, PostalCode string, Latitude double, Longitude double",
    )
    reviews = spark.createDataFrame(
        [("r1", "b1", "good"), ("r2", "b1", "bad"), ("r3", "b1", None), ("r4", "b2", "good")],
        "ReviewID string, BusinessID string, Review string",
    )
    scores = sentiment.city_scores(reviews, business, lexicon, "Toronto")
    got = sentiment.business_means(scores, business, "Toronto").collect()
    assert [(r.BusinessID, r.avg_neg, r.avg_neu, r.avg_pos, r.ZipCode) for r in got] == [
        ("b1", 0.5, 0.0, 0.5, "M5V1A1")
    ]
    each = sentiment.with_texts(scores, reviews, business, "Toronto")
    assert each.columns == [
        "BusinessID", "Business_Name", "Review", "Negative", "Neutral", "positive", "Over_all",
    ]
    assert sorted(str(r.Review) for r in each.collect()) == ["None", "bad", "good"]


# --- counts of words ----------------------------------------------------------------------
def _plainly(texts):
    return texts.select("k", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"\w+"), F.lit(0))).alias("term")).groupBy("k", "term").agg(F.count("*").alias("n"))


def test_words_of_single_texts_are_not_shuffled_by_text(spark, inputs):
    counts = topics.term_counts(inputs.text(), "ReviewID", "Review")
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    weights = topics.tfidf(counts, inputs.text())
    assert "hashpartitioning(ReviewID" not in weights._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("part", [topics.PART_BYTES, 60])
def test_counts_of_any_keys(spark, rows, monkeypatch, part):
    """Keys with one text, with many, with copies, without a key, without a text or words; some dealt out over parts."""
    monkeypatch.setattr(topics, "PART_BYTES", part)
    r = random.Random(7)
    lines = [(k, " ".join(r.choices("ab Ab cd e1 f_g hé".split(), k=r.randint(0, 9)))) for k in (1, 1, 2, None, 3) for _ in range(r.choice((1, 40)))]
    lines += [(4, "same same words")] * 30 + [(5, None), (6, ""), (7, "..."), (None, "ab ab")]
    texts = spark.createDataFrame(lines, "k int, t string").repartition(5)
    assert rows(topics.term_counts(texts, "k", "t").select("k", "term", "n")) == rows(_plainly(texts))
    once = texts.dropDuplicates(["k"])
    assert rows(topics.term_counts(once, "k", "t")) == rows(_plainly(once))


def test_runs_over_batches():
    """Batches that end within a run, and blocks of a few words."""
    lines = [("a", ["x", "y", "x"]), ("a", ["x"]), ("a", None), ("b", []), (None, ["y"]), (None, ["y"]), ("c", ["z", "x"])]
    lines = [(k, -1, w) for k, w in lines]
    want = [("a", -1, "x", 3), ("a", -1, "y", 1), (None, -1, "y", 2), ("c", -1, "x", 1), ("c", -1, "z", 1)]
    for size in range(1, 8):
        batches = [pa.record_batch([pa.array(c) for c in zip(*lines[n : n + size])], schema=LINES) for n in range(0, 7, size)]
        got = [tuple(r.values()) for b in runs.count_words(iter(batches)) for r in b.to_pylist()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_packed_counts_over_blocks(monkeypatch):
    """Blocks of a few words, one of them without any, give each key's weights in order of the index."""
    monkeypatch.setattr(runs, "WORDS", 3)
    lines = [("a", -1, ["x", "y", "x"]), ("a", -1, ["x", "w"]), ("b", -1, []), ("c", -1, None), ("d", -1, ["y"]), ("e", -1, ["z"]), ("f", -1, [])]
    batches = [pa.record_batch([pa.array(c) for c in zip(*lines[n : n + 2])], schema=LINES) for n in range(0, 7, 2)]
    index, got, total = {"x": 2, "y": 0, "z": 3, "w": 1}, {}, {}
    blocks = list(runs.pack_words(iter(batches)))
    assert len(blocks) > 1
    for b in blocks:
        row = b.to_pylist()[0]
        for term, df, n in zip(row["terms"], row["dfs"], row["totals"]):
            total[term] = tuple(map(sum, zip(total.get(term, (0, 0)), (df, n))))
        codes = range(len(row["terms"]))
        kinds = pa.schema([("code", pa.int32()), ("index", pa.int32()), ("idf", pa.float64())])
        terms = pa.Table.from_pylist([{"code": c, "index": index[row["terms"][c]], "idf": 0.5} for c in reversed(codes)], schema=kinds)
        got |= {r["BusinessID"]: (r["indices"], r["values"]) for r in runs.unpack_weights(pa.Table.from_batches([b]), terms).to_pylist()}
    empty = ([], [])
    assert got == {"a": ([0, 1, 2], [0.5, 0.5, 1.5]), "b": empty, "c": empty, "d": ([0], [0.5]), "e": ([3], [0.5]), "f": empty}
    assert total == {"x": (1, 3), "y": (2, 2), "z": (1, 1), "w": (1, 1)}


# --- topics ------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def inputs(spark, small):
    return Inputs(spark, small)


def test_vectors_equal_the_merged_text_through_mllib(spark, inputs):
    """Counting words per business gives what merging its texts first would."""
    business, reviews = inputs.business(), inputs.text()
    twice = reviews.unionAll(reviews)
    vectors, words = topics.business_vectors(topics.business_texts(twice, business), business)

    merged = (
        topics.business_texts(reviews, business)
        .groupBy("BusinessID")
        .agg(F.array_join(F.collect_set("Review"), " ").alias("text"))
    )
    fitted = topics.text_features("text").fit(merged)
    index = {t: n for n, t in enumerate(fitted.stages[2].vocabulary)}
    assert set(index) == {r.term for r in words.collect()}
    ours = {r["index"]: r.term for r in words.collect()}
    theirs = {r.BusinessID: r.idf_vec for r in fitted.transform(merged).collect()}
    got = vectors.collect()
    assert {r.BusinessID for r in got} == set(theirs)
    for r in got:
        want = theirs[r.BusinessID]
        assert r.features.size == want.size
        assert {ours[i]: pytest.approx(v) for i, v in zip(r.features.indices, r.features.values)} == {
            t: want[n] for t, n in index.items() if n in set(want.indices)
        }


def test_vectors_of_large_businesses(spark, monkeypatch):
    """Businesses with more text than a task counts at once get the same vectors, and only they are counted by rows."""
    r = random.Random(3)
    lines = [(n % 7, " ".join(r.choices([f"w{k}" for k in range(50)], k=20 if n % 7 < 2 else 3))) for n in range(200)]
    lines += [(0, "w1 w2"), (0, "w1 w2"), (8, "..."), (9, None)]
    business = spark.range(10).selectExpr("id as BusinessID", "string(id) as Name", "'X' as City", "2.0D as BusinessStars")
    texts = topics.business_texts(spark.createDataFrame(lines, "BusinessID long, Review string"), business)
    stored, plain = {}, topics.materialise
    monkeypatch.setattr(topics, "materialise", lambda df, name, *more: stored.setdefault(name, []).append(plain(df, name, *more)) or stored[name][-1])
    got = []
    for part in (topics.PART_BYTES, 500):
        monkeypatch.setattr(topics, "PART_BYTES", part)
        vectors, words = topics.business_vectors(texts, business, stopwords=())
        got.append((sorted((x.BusinessID, x.BusinessName, x.features) for x in vectors.collect()), sorted(map(tuple, words.collect()))))
    assert got[0] == got[1] and [x[0] for x in got[0][0]] == [*range(7), 8, 9]
    assert [x.count() for x in stored["large"]] == [0, 2]
    by_rows = [{x.BusinessID for x in t.select("BusinessID").distinct().collect()} for t in stored["term-counts"]]
    assert by_rows == [set(), {0, 1}]


@pytest.fixture(scope="module")
def found(inputs):
    return topics.cohort_topics(inputs.text(), inputs.business())


def test_topics(found, inputs):
    assert set(found) == {"low", "high"}
    total = 0
    for model in found.values():
        words = model.words.collect()
        assert len(words) == 6 and all(len(set(r.topic_word)) == 10 for r in words)
        mix = model.distribution.collect()
        total += len(mix)
        for r in mix:
            assert len(r.topic_distribution) == 6 and sum(r.topic_distribution) == pytest.approx(1)
    assert total == inputs.business().join(inputs.text(), "BusinessID", "left_semi").count()


def test_long_form_takes_both_layouts(found, rows):
    mix = found["low"].distribution
    text = topics.distribution_text(mix)
    assert text.first().topic_distribution.startswith("[")
    long, from_text = topics.topic_long_form(mix), topics.topic_long_form(text)
    assert long.count() == mix.count() * 6
    again = from_text.withColumn("TopicDistribution", F.col("TopicDistribution").cast("double"))
    assert rows(long) == rows(again)


def test_an_empty_cohort_has_no_model(spark, inputs):
    high_only = inputs.business().where("BusinessStars > 3")
    assert set(topics.cohort_topics(inputs.text(), high_only)) == {"high"}


def test_wordless_reviews_are_documents(spark):
    business = spark.createDataFrame(
        [("b", "B", "X", 2.0), ("c", "C", "X", 2.0)],
        "BusinessID string, Name string, City string, BusinessStars double",
    )
    reviews = spark.createDataFrame([("b", "soup soup cake"), ("c", "the and")], "BusinessID string, Review string")
    vectors, words = topics.business_vectors(topics.business_texts(reviews, business, "X"), business)
    got = {r.BusinessID: r.v for r in vectors.select("BusinessID", vector_to_array("features").alias("v")).collect()}
    idf = math.log(3 / 2)
    assert got["b"] == pytest.approx([2 * idf, idf]) and got["c"] == [0.0, 0.0]
    assert [(r.term, r["index"]) for r in words.orderBy("index").collect()] == [("soup", 0), ("cake", 1)]


def test_no_vocabulary_on_the_driver(spark, inputs, monkeypatch):
    """A fit brings batch sizes and sums per topic to the driver, whatever the vocabulary."""
    collected, plain = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: collected.append(plain(df)) or collected[-1])
    found = topics.cohort_topics(inputs.text(), inputs.business())
    assert set(found) == {"low", "high"} and max(map(len, collected)) <= lda.BATCHES
    with pytest.raises(AttributeError):
        topics.LDA  # MLlib's solver holds vocabulary times topics on the driver


def test_topics_come_apart(spark):
    """Businesses that write of one of two things get mixes by it, and the likeliest words are of one thing each."""
    things = [["soup", "bread", "cheese"], ["wheel", "engine", "brake"]]
    business = spark.range(200).selectExpr("id as BusinessID", "string(id) as Name", "'X' as City", "2.0D as BusinessStars")
    lines = [(n, " ".join(w for j, w in enumerate(things[n % 2]) for _ in range(5 + (n + j) % 3))) for n in range(200)]
    model = topics.cohort_topics(spark.createDataFrame(lines, "BusinessID long, Review string"), business, k=2)["low"]
    mixes = [(r.BusinessID % 2, max(range(2), key=r.topic_distribution.__getitem__)) for r in model.distribution.collect()]
    assert len(mixes) == 200 and len(set(mixes)) == 2 and len({m for _, m in mixes}) == 2
    assert sorted(sorted(r.topic_word[:3]) for r in model.words.collect()) == sorted(map(sorted, things))


def _mix_alone(weights, likely, alpha):
    """A document by itself, as the method is written down."""
    gamma = np.ones(len(alpha))
    while True:
        theta = np.exp(lda.digamma(gamma) - lda.digamma(gamma.sum()))
        new = theta * ((weights / (likely @ theta)) @ likely) + alpha
        change, gamma = np.abs(new - gamma).mean(), new
        if change <= lda.CHANGE:
            theta = np.exp(lda.digamma(gamma) - lda.digamma(gamma.sum()))
            return gamma, likely * theta * (weights / (likely @ theta))[:, None]


@pytest.mark.parametrize("together", [lda.TOGETHER, 40, 1])
def test_documents_of_a_block_settle_as_each_would_alone(monkeypatch, together):
    monkeypatch.setattr(lda, "TOGETHER", together)
    draw = np.random.default_rng(2)
    likely, alpha = draw.gamma(2.0, 1.0, (3, 50)), np.array([0.1, 0.5, 1.0])
    sizes = [1, 30, 7, 7, 50, 12, 1]
    codes = np.concatenate([draw.choice(50, n, replace=False) for n in sizes])
    weights, ends = draw.gamma(1.0, 3.0, len(codes)), np.cumsum(sizes)
    gamma, taken = lda.mixes_of(weights, codes, ends, likely, alpha)
    for j, (a, b) in enumerate(zip([0, *ends], ends)):
        alone, shares = _mix_alone(weights[a:b], likely.T[codes[a:b]], alpha)
        assert gamma[j] == pytest.approx(alone, rel=1e-9) and taken[:, a:b].T == pytest.approx(shares, rel=1e-9)


def test_topics_of_packed_blocks(spark, monkeypatch):
    """A term has one row in a block, and neither the size of blocks nor counting by rows changes the topics."""
    r = random.Random(4)
    business = spark.range(60).selectExpr("id as BusinessID", "string(id) as Name", "'X' as City", "1.0D + id % 5 as BusinessStars")
    business = business.unionAll(business.where("BusinessID = 6"))  # comes twice
    lines = [(n % 60, " ".join(r.choices([f"w{k}" for k in range(80)], k=30 if n % 60 < 3 else 6))) for n in range(400)] + [(61, "w1"), (59, "...")]
    reviews = spark.createDataFrame(lines, "BusinessID long, Review string")
    stored, plain = {}, topics.materialise
    monkeypatch.setattr(topics, "materialise", lambda df, name, *a, **b: stored.setdefault(name, []).append(plain(df, name, *a, **b)) or stored[name][-1])
    found = []
    for part, block, least in ((4 << 20, 8 << 20, 1), (400, 100, 3)):
        for name, value in (("PART_BYTES", part), ("BLOCK_BYTES", block), ("LEAST_BLOCKS", least)):
            monkeypatch.setattr(topics, name, value)
        models = topics.cohort_topics(reviews, business, k=2)
        found.append({c: (sorted(map(tuple, m.distribution.collect())), sorted(map(tuple, m.words.collect()))) for c, m in models.items()})
    assert set(found[0]) == {"low", "high"} and sum(len(m[0]) for m in found[0].values()) == 63
    for c, (mixes, words) in found[0].items():
        assert [x[:2] for x in mixes] == [x[:2] for x in found[1][c][0]] and words == found[1][c][1]
        assert [x[2] for x in mixes] == [pytest.approx(x[2], rel=1e-6) for x in found[1][c][0]]
    counts = [(t.count(), t.select("cohort", "batch", "block", "term").distinct().count(), t.select("block").distinct().count()) for t in stored["terms"]]
    assert counts[0][0] == counts[0][1] < counts[1][0] and counts[0][2] < counts[1][2]
    assert [x.count() for x in stored["large"]] == [0, 3]


def test_gamma_functions():
    assert lda.digamma(np.array([0.05, 1.0, 10.0])) == pytest.approx([-20.497845, -0.5772156649, 2.2517525890])
    assert lda.trigamma(np.array([0.05, 1.0, 10.0])) == pytest.approx([401.532360, 1.6449340668, 0.1051663357])


def test_features_by_stage_cut_texts_once(spark):
    cut = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        cut.add(1)
        return text

    texts = spark.range(60).select("id", F.concat(F.lit("word"), F.col("id") % 7, F.lit(" the end "), F.col("id") % 3).alias("text"))
    pipeline = topics.text_features("text")
    found = topics.features_by_stage(pipeline, texts.select("id", read("text").alias("text")), "id").collect()
    assert cut.value == 60
    plain = pipeline.fit(texts).transform(texts).select("id", "idf_vec").collect()
    # words found equally often have no order of their own in MLlib
    weights = [{r.id: sorted(r.idf_vec.values) for r in rows} for rows in (found, plain)]
    assert weights[0] == weights[1] and len(weights[0]) == 60
