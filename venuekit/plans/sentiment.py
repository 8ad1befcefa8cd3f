"""Rule-based sentiment from a lexicon.

Follows the model of Hutto and Gilbert (ICWSM 2014) as its public implementations apply it: a listed word's valence is
scaled by degree words and flipped by negations among the three words before it, unless these are listed themselves;
"never so", "least", "kind of" and a few idioms have rules of their own; clauses after "but" weigh more than
those before; exclamation and question marks add emphasis; and the sum is squashed to [-1, 1].  Capital emphasis cannot
occur, since texts are lower-cased first.  A word that occurs several times is judged at each of its places.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuekit.functions.text import strip_non_ascii, without_spaces
from venuekit.operators.aggregates import group_apart
from venuekit.operators.filters import city_filter

# Constants of the published model.
DEGREE_STEP = 0.293
DEGREE_DECAY = (1.0, 0.95, 0.9)
NEGATION_FACTOR = -0.74
NEVER_FACTORS = (1.5, 1.25)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_MAX, QUESTION_CAP = 0.18, 3, 0.96
NORMALISER = 15.0
# Words end at white space; punctuation at their edges is no part of them unless the lexicon lists it.
SPACE = r"[ \t\n\x0B\f\r]+"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Rules:
    """Word lists of the model; pass another instance for another language.

    Fixed values: the lists of the publication and its public implementations.
    """

    negations: Sequence[str] = (
        "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont", "hadnt",
        "hasnt", "havent", "isnt", "mightnt", "mustnt", "neednt", "neither", "never", "none", "nope",
        "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
        "without", "wont", "wouldnt", "rarely", "seldom", "despite",
    )
    negative_ending: str = "n't"
    stronger: Sequence[str] = (
        "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply",
        "effing", "enormously", "entirely", "especially", "exceptionally", "extremely", "fabulously",
        "flipping", "flippin", "fricking", "frickin", "frigging", "friggin", "fully", "fucking",
        "greatly", "hella", "highly", "hugely", "incredibly", "intensely", "majorly", "more", "most",
        "particularly", "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly",
        "totally", "tremendously", "uber", "unbelievably", "unusually", "utterly", "very",
    )
    weaker: Sequence[str] = (
        "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little", "marginally",
        "occasionally", "partly", "scarcely", "slightly", "somewhat", "sorta", "sortof", "sort-of",
    )
    weaker_phrases: Sequence[str] = ("just enough", "kind of", "sort of")
    idioms: Mapping[str, float] = field(
        default_factory=lambda: {
            "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0,
            "kiss of death": -1.5, "hand to mouth": -2.0,
        }
    )
    contrast: str = "but"
    never: str = "never"
    after_never: Sequence[str] = ("so", "this")
    least: str = "least"
    not_least: Sequence[str] = ("at", "very")
    no_words: Sequence[Sequence[str]] = (("kind", "of"),)  # words that have no valence before another


def analysed_text(review: Column) -> Column:
    """What is scored: the lower-cased ASCII text with its punctuation."""
    return strip_non_ascii(F.lower(review))


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _emphasis(text: Column) -> Column:
    questions = _occurrences(text, "?")
    loud = F.least(_occurrences(text, "!"), F.lit(EXCLAMATION_MAX)) * EXCLAMATION_STEP
    asking = (
        F.when(questions <= 1, 0.0)
        .when(questions <= QUESTION_MAX, questions * QUESTION_STEP)
        .otherwise(QUESTION_CAP)
    )
    return F.when(text.isNotNull(), loud + asking)


def _signed(valence: Column, amount: Column) -> Column:
    """An amount that moves the valence away from zero if it is positive."""
    return F.when(valence < 0, -amount).otherwise(amount)


def _degree(word: Column, decay: float, rules: Rules) -> Column:
    step = DEGREE_STEP * decay
    return F.when(word.isin(list(rules.stronger)), step).when(word.isin(list(rules.weaker)), -step).otherwise(0.0)


def _negated(word: Column, rules: Rules) -> Column:
    return word.isin(list(rules.negations)) | word.contains(rules.negative_ending)


def _words_before(rules: Rules) -> list[Column]:
    """Steps from the valence in ``_v`` to that after each of the three words before; each step reads the one before it.

    ``back1`` to ``back3`` are the words before, ``near1`` to ``near3`` whether these are listed themselves.
    """
    v, back = F.col("_v"), [F.col(f"back{d}") for d in (1, 2, 3)]
    raised = [b.isin(list(rules.after_never)) for b in back]
    never = [b == rules.never for b in back]
    exceptions = (None, never[1] & raised[0], (never[2] & raised[1]) | raised[0])
    steps = []
    for d, (word, decay) in enumerate(zip(back, DEGREE_DECAY)):
        scaled = v + _signed(v, _degree(word, decay, rules))
        factor = F.when(_negated(word, rules), NEGATION_FACTOR).otherwise(1.0)
        if exceptions[d] is not None:
            factor = F.when(exceptions[d], NEVER_FACTORS[d - 1]).otherwise(factor)
        steps.append(F.when(word.isNotNull() & ~F.col(f"near{d + 1}"), scaled * factor).otherwise(v))
    return steps


def _phrases(rules: Rules) -> Column:
    """The valence in ``_v`` after idioms in or right before the word, the longest first, and degree phrases before it."""
    one, two, three = (F.col(f"back{d}") for d in (1, 2, 3))
    word, then, later = F.col("word"), F.col("next1"), F.col("next2")
    runs = [(word, then, later), (two, one, word), (three, two, one), (word, then), (one, word), (two, one), (three, two)]
    valences = F.create_map(*(F.lit(x) for x in chain.from_iterable(rules.idioms.items()))) if rules.idioms else None
    v = F.col("_v")
    # concat, unlike concat_ws, gives NULL where a word is missing
    texts = [F.concat(*chain.from_iterable((w, F.lit(" ")) for w in run[:-1]), run[-1]) for run in runs]
    idiom = F.coalesce(*(valences[t] for t in texts), v) if valences is not None else v
    weakened = texts[5].isin(list(rules.weaker_phrases)) | texts[6].isin(list(rules.weaker_phrases))
    return F.when(three.isNotNull() & ~F.col("near3"), idiom - F.when(weakened, DEGREE_STEP).otherwise(0.0)).otherwise(v)


def _least(rules: Rules) -> Column:
    flips = (F.col("back1") == rules.least) & ~F.col("near1") & ~F.coalesce(F.col("back2").isin(list(rules.not_least)), F.lit(False))
    return F.when(flips, F.col("_v") * NEGATION_FACTOR).otherwise(F.col("_v"))


def _places(text: Column, reviews: DataFrame, rules: Rules) -> DataFrame:
    """One row per word and form of it, with its place and the words around it; a text without words has one row.

    Words of one character are left out.  A word's first form is as it stands, its second
    without the punctuation at its edges, if two characters or more are left.
    """

    def stripped(w: Column) -> Column:
        bare = F.btrim(w, F.lit(PUNCTUATION))
        return F.when(F.length(bare) > 1, bare).otherwise(w)

    split = reviews.select("_key", _emphasis(text).alias("_emphasis"), F.filter(F.split(text, SPACE), lambda w: F.length(w) > 1).alias("_raw"))
    split = split.withColumn("_bare", F.transform("_raw", stripped))
    words = F.col("_bare")

    def entry(word: Column, at: Column) -> Column:
        around = {f"back{d}": F.get(words, at - d) for d in (1, 2, 3)} | {f"next{d}": F.get(words, at + d) for d in (1, 2)}
        return F.struct(at.alias("at"), word.alias("word"), F.get("_raw", at).alias("raw"), *(c.alias(n) for n, c in around.items()))

    base = ("_key", "_emphasis", "_size", "_contrast")
    rows = split.select(
        "_key", "_emphasis", F.size(words).alias("_size"), F.array_position(words, rules.contrast).alias("_contrast"), F.transform(words, entry).alias("_words")
    ).select(*base, F.explode_outer("_words").alias("_w"))
    rows = rows.select(*base, "_w.*")
    forms = F.when(F.col("raw") == F.col("word"), F.array("word")).otherwise(F.array("raw", "word"))
    return rows.select("*", F.explode_outer(forms).alias("token"))


def review_scores(
    reviews: DataFrame,
    lexicon: DataFrame,
    rules: Rules = Rules(),
    keys: Sequence[str] = ("ReviewID",),
) -> DataFrame:
    """Scores (Negative, Neutral, positive, Over_all) per review.

    ``keys`` are carried along and identify a review; ``lexicon`` has (token, valence), and a token
    listed several times has its mean valence.  The words of a review become rows without the text and are joined to the
    lexicon once.  Only listed words, and the first word of each review, go on to be sorted by review and
    place, where a word sees which of those before it are listed.  A NULL text gives NULL scores.

    The keys go along as one struct, as in ``group_apart``: words are then dealt out by review, and not left where
    a join by one of the keys has put the reviews, which would be all of a business in one task.
    """
    rows = _places(F.col("_text"), reviews.select(F.struct(*keys).alias("_key"), analysed_text(F.col("Review")).alias("_text")), rules)
    valences = group_apart(lexicon, ["token"], F.avg(F.col("valence").cast("double")).alias("valence"))
    listed = F.col("valence").isNotNull()
    kept = rows.join(valences, "token", "left").where(listed | F.coalesce(F.col("at") == 0, F.lit(True)))
    # of the forms of a word the one as it stands comes first
    place = Window.partitionBy("_key").orderBy("at", F.desc(listed), F.desc(F.col("token") == F.col("raw")))
    single = kept.withColumn("_same", F.coalesce(F.lag("at").over(place) == F.col("at"), F.lit(False))).where("not _same")
    before = Window.partitionBy("_key").orderBy("at")
    marks = single.withColumn("_mark", F.when(listed, F.col("at")))
    marks = marks.select("*", *(F.lag("_mark", k).over(before).alias(f"_lag{k}") for k in (1, 2, 3)))
    seen = [F.coalesce(*(F.when(F.col(f"_lag{k}") == F.col("at") - d, True) for k in (1, 2, 3)), F.lit(False)).alias(f"near{d}") for d in (1, 2, 3)]
    silent = F.col("word").isin([*rules.stronger, *rules.weaker])
    for first, then in rules.no_words:
        silent |= (F.col("word") == first) & F.coalesce(F.col("next1") == then, F.lit(False))
    valued = marks.select("*", *seen, F.when(~silent, F.col("valence")).alias("_v"))
    # One step per projection: nested into one expression, each would repeat the last.
    for step in (*_words_before(rules), _phrases(rules), _least(rules)):
        valued = valued.withColumn("_v", F.when(F.col("_v").isNotNull(), step))
    nth = F.col("at") + 1
    shift = F.when((F.col("_contrast") == 0) | (nth == F.col("_contrast")), 1.0).when(nth < F.col("_contrast"), BEFORE_BUT).otherwise(AFTER_BUT)
    v = F.col("_value")
    # A review's rows lie together already, so that this is no further shuffle.
    sums = (
        valued.select("_key", "_emphasis", "_size", F.coalesce(F.col("_v") * shift, F.lit(0.0)).alias("_value"))
        .groupBy("_key")
        .agg(
            F.max("_emphasis").alias("emphasis"),
            F.sum(v).alias("total"),
            # One is added per word to weigh it against a neutral one, which counts one.
            F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("up"),
            F.sum(F.when(v < 0, 1 - v).otherwise(0.0)).alias("down"),
            (F.greatest(F.max("_size"), F.lit(0)) - F.count_if(v != 0)).alias("flat"),
        )
    )
    emphasis = F.col("emphasis")
    sums = sums.select(
        "_key.*",
        "emphasis",
        "flat",
        (F.col("total") + F.signum("total") * emphasis).alias("total"),
        (F.col("up") + F.when(F.col("up") > F.col("down"), emphasis).otherwise(0.0)).alias("up"),
        (F.col("down") + F.when(F.col("down") > F.col("up"), emphasis).otherwise(0.0)).alias("down"),
    )
    whole = F.col("up") + F.col("down") + F.col("flat")

    def share(part: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), 3)

    def unless_null(score: Column) -> Column:
        # Only a NULL text has no emphasis.
        return F.when(emphasis.isNotNull(), score)

    total = F.col("total")
    return sums.select(
        *keys,
        unless_null(share(F.col("down"))).alias("Negative"),
        unless_null(share(F.col("flat"))).alias("Neutral"),
        unless_null(share(F.col("up"))).alias("positive"),
        unless_null(F.round(total / F.sqrt(total * total + NORMALISER), 4)).alias("Over_all"),
    )


def city_scores(
    reviews: DataFrame,
    business: DataFrame,
    lexicon: DataFrame,
    city: str | None,
    rules: Rules = Rules(),
) -> DataFrame:
    """(ReviewID, BusinessID, scores) of one city; both products below start from it."""
    places = city_filter(business, city).select("BusinessID")
    chosen = reviews.select("ReviewID", "BusinessID", "Review").join(places, "BusinessID", "left_semi")
    return review_scores(chosen, lexicon, rules, ("ReviewID", "BusinessID"))


def with_texts(scores: DataFrame, reviews: DataFrame, business: DataFrame, city: str | None) -> DataFrame:
    """Scores next to the lower-cased text of each review."""
    names = city_filter(business, city).select("BusinessID", F.col("Name").alias("Business_Name"))
    texts = reviews.select("ReviewID", F.lower("Review").alias("Review"))
    return (
        scores.join(names, "BusinessID")
        .join(texts, "ReviewID")
        .select(
            "BusinessID", "Business_Name", "Review", "Negative", "Neutral", "positive", "Over_all"
        )
    )


def _mean(score: str, alias: str) -> Column:
    # Scores have four digits at most.  Adding them as decimals is exact, so a tie is
    # rounded the same way in whatever order the tasks finish.
    mean = F.avg(F.col(score).cast("decimal(6,4)"))
    return F.round(mean, 2).cast("double").alias(alias)


def business_means(scores: DataFrame, business: DataFrame, city: str | None) -> DataFrame:
    """Mean scores per business, with its name and place."""
    means = scores.groupBy("BusinessID").agg(
        _mean("Negative", "avg_neg"),
        _mean("Neutral", "avg_neu"),
        _mean("positive", "avg_pos"),
        _mean("Over_all", "avg_composite_score"),
    )
    places = city_filter(business, city).select(
        "BusinessID",
        "Name",
        without_spaces(F.col("PostalCode")).alias("ZipCode"),
        "Latitude",
        "Longitude",
    )
    return means.join(places, "BusinessID")
