"""A convolutional text classifier: hashed word embeddings, filters of several widths, max pooling.

A word's vector is the sum of the vectors of its hash and of the hash of its first letters, so that
words of a common stem help each other.  Filters of each width slide over the words of the whole
text, the largest response of each is kept, and a logistic unit joins them.  The threshold
is calibrated by the language that the text itself suggests.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.llm import flat, langid
from venuekit.llm.cluster import fresh, ship
from venuekit.sources.scratch import materialise

#: Documents, about, that one network learns from; the model is the mean of all networks.
PART = 4000
#: Documents, about, that one task counts words or logits of.
COUNTED = 1000
#: Steps to one that logits are counted by to set the thresholds, and the largest that is told apart.
GRID, LARGEST = 1000, 40
SLOTS = 1 << 15
#: Letters at the start of a word that its second hash covers.
STEM = 4
WIDTHS = (1, 2, 3)
FILTERS = 8
DIMENSIONS = 12
EPOCHS = 6
RATE = 0.05
SEED = 7
#: Documents that a word or stem must occur in to get a vector; others are zero, so that they can't be learnt by heart.
SEEN = 3
#: Calibration documents of the rarer class from which a language gets a threshold of its own.
LEAST = 10
#: Words of 64 bits of the filter of labelled ids: this many at least and at most.
LEAST_WORDS, MOST_WORDS = 1 << 10, 1 << 20


@dataclass
class Network:
    """Row ``SLOTS`` of the embeddings stands for no word and is zero."""

    words: np.ndarray
    stems: np.ndarray
    filters: list[np.ndarray]  # by width: width x dimensions x filters
    biases: np.ndarray  # widths x filters
    out: np.ndarray
    bias: float


@dataclass
class Model:
    network: Network
    languages: langid.Model
    thresholds: np.ndarray  # by language; the last is for texts without one


def word_slots(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all words and of their stems, and where each text begins; a text without words has one empty word."""
    points, text_starts = flat.code_points([(t or "").lower() for t in texts])
    starts, ends = flat.runs(flat.alphanumerics()[points])
    mask = np.uint64(SLOTS - 1)
    whole = (flat.run_hashes(points, starts, ends) & mask).astype(np.int64)
    stem = (flat.run_hashes(points, starts, np.minimum(ends, starts + STEM)) & mask).astype(np.int64)
    first = np.searchsorted(starts, text_starts)
    empty = np.flatnonzero(np.diff(first) == 0)
    whole, stem = (np.insert(x, first[empty], SLOTS) for x in (whole, stem))
    return whole, stem, first + np.searchsorted(empty, np.arange(len(first)), side="left")


def _start(counts: np.ndarray, sizes: np.ndarray) -> Network:
    """Random weights, but for the first dimensions: how much likelier a word and a stem are in class 1.

    ``counts`` has the documents of each class that each word and stem is in (words and stems x classes x slots),
    ``sizes`` the documents of each class.
    """
    random = np.random.default_rng(SEED)
    words, stems = (random.normal(0, 0.1, (SLOTS + 1, DIMENSIONS)).astype(np.float32) for _ in range(2))
    for table, part in ((words, 0), (stems, 1)):
        seen = counts[part]
        share = (seen + 0.3) / (sizes[:, None] + 1.0)
        n = seen.sum(axis=0)
        odds = np.log(share[1] / share[0]) * n / (n + 2)  # rare words say less
        table[:, part] = odds
        table[:, 1 - part] = 0
        table[n < SEEN] = 0
    filters = [random.normal(0, 0.1, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, 0] += 0.5
        f[:, 1, 0] += 0.5
        f[:, 0, 1] += 0.7
        f[:, 1, 2] += 0.7
    out = random.normal(0, 0.1, (len(WIDTHS), FILTERS))
    out[:, :3] = 0.2
    return Network(words, stems, filters, np.zeros((len(WIDTHS), FILTERS)), out, -1.0)


#: Each weight vector of the filters: the filter it is of, counted through all widths, and its place in a window.
_FILTER = np.concatenate([np.repeat(np.arange(FILTERS) + k * FILTERS, w) for k, w in enumerate(WIDTHS)])
_OFFSET = np.concatenate([np.tile(np.arange(w), FILTERS) for w in WIDTHS])


def _flat_filters(filters: list[np.ndarray]) -> np.ndarray:
    """The weight vectors of all filters, one below the other, as ``_FILTER`` and ``_OFFSET`` tell."""
    return np.concatenate([f.transpose(2, 0, 1).reshape(-1, DIMENSIONS) for f in filters])


def _by_width(weights: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum([FILTERS * w for w in WIDTHS])[:-1]
    return [np.ascontiguousarray(f.reshape(FILTERS, w, DIMENSIONS).transpose(1, 2, 0)) for f, w in zip(np.split(weights, ends), WIDTHS)]


def train(net: Network, docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray) -> Network:
    """Stochastic gradient descent from ``net`` with steps scaled by past gradients; ``weight`` is that of each class."""
    words, stems, filters = net.words.copy(), net.stems.copy(), _flat_filters(net.filters)
    biases, out, bias = net.biases.ravel().copy(), net.out.ravel().copy(), net.bias
    random = np.random.default_rng(SEED)
    past = [np.full(x.shape, 0.1) for x in (filters, biases, out)]
    past_words, past_stems, past_bias = np.full(SLOTS + 1, 0.1), np.full(SLOTS + 1, 0.1), 0.1
    tables = [(words, past_words, words.any(axis=1)), (stems, past_stems, stems.any(axis=1))]
    each, first = np.arange(len(biases)), _OFFSET == 0
    later = [(j, _FILTER[_OFFSET == j], _OFFSET == j) for j in range(1, max(WIDTHS))]

    def step(value: np.ndarray, seen: np.ndarray, gradient: np.ndarray) -> None:
        seen += gradient * gradient
        value -= RATE * gradient / np.sqrt(seen)

    for _ in range(EPOCHS):
        for i in random.permutation(len(docs)):
            own = docs[i]
            x = words.take(own[0], axis=0) + stems.take(own[1], axis=0)
            answers = filters @ x.T
            z = answers[first]  # filters x places, each row in one piece
            for j, of, rows in later:
                z[of, :-j] += answers[rows, j:]
            at = z.argmax(axis=1)
            pooled = z[each, at] + biases
            active = np.where(pooled > 0, pooled, 0.1 * pooled)
            p = 1 / (1 + math.exp(-min(max(out @ active + bias, -30.0), 30.0)))
            g = (p - y[i]) * weight[y[i]]
            inner = g * out * np.where(pooled > 0, 1.0, 0.1)
            t = at[_FILTER] + _OFFSET
            inside = t < len(x)
            strength = inner[_FILTER] * inside
            gradient = strength[:, None] * x[np.minimum(t, len(x) - 1)]
            change = (strength[:, None] * filters)[inside]
            t = t[inside]
            step(filters, past[0], gradient)
            step(biases, past[1], inner)
            step(out, past[2], g * active)
            past_bias += g * g
            bias -= RATE * g / math.sqrt(past_bias)
            for slots, (table, seen, known) in zip(own, tables):
                at_slots = slots[t]
                touched = np.unique(at_slots)
                touched = touched[known[touched]]
                gradient = (touched[:, None] == at_slots).astype(np.float64) @ change
                seen[touched] += (gradient * gradient).sum(axis=1) / DIMENSIONS
                table[touched] -= RATE * gradient / np.sqrt(seen[touched])[:, None]
    shape = net.biases.shape
    return Network(words, stems, _by_width(filters), biases.reshape(shape), out.reshape(shape), bias)


@dataclass
class Known:
    """Texts (doc_id, text) and labels (doc_id, toxic), not joined; parts meet one by one in tasks of their own.

    So a text is moved once for each use, and one that ``marks`` show to have no label not at all.
    """

    texts: DataFrame
    labels: DataFrame
    marks: DataFrame
    parts: int

    def apply(self, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        """What ``work`` makes of each part's labelled texts (doc_id, text, toxic)."""
        part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(self.parts)).cast("int")

        def meet(texts: pa.Table, labels: pa.Table) -> pa.Table:
            at = pc.index_in(texts.column("doc_id"), value_set=labels.column("doc_id").combine_chunks())
            joined = texts.append_column("toxic", labels.column("toxic").take(at))
            return work(joined.filter(pc.is_valid(at)).select(["doc_id", "text", "toxic"]))

        sides = [
            side.withColumn("_part", part).repartitionById(self.parts, "_part").groupBy("_part")
            for side in (self.texts.where(_marked(self.marks)), self.labels)
        ]
        return sides[0].cogroup(sides[1]).applyInArrow(meet, schema)


def _word_of(words: int) -> Column:
    return F.xxhash64(F.lit("mark"), "doc_id").bitwiseAND(F.lit(words - 1)).cast("int")


def _bits() -> Column:
    """Two of the 64 bits of a word, by the id."""
    h = F.xxhash64(F.lit("bits"), "doc_id")
    one = F.lit(1).cast("long")
    first, second = (F.pmod(F.shiftrightunsigned(h, n), F.lit(64)).cast("int") for n in (0, 32))
    return F.call_function("shiftleft", one, first).bitwiseOR(F.call_function("shiftleft", one, second))


def _marks(ids: DataFrame, n: int) -> DataFrame:
    """One row (marks): a Bloom filter of ``n`` ids, some eight bits for each, up to a bound.

    With more ids bits fill up, which only moves more texts.
    """
    words = min(MOST_WORDS, max(LEAST_WORDS, 1 << (n // 8).bit_length()))
    found = ids.groupBy(_word_of(words).alias("word")).agg(F.bit_or(_bits()).alias("bits"))
    empty = ids.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    whole = found.unionAll(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return whole.agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("marks"))


def _marked(marks: DataFrame) -> Column:
    """False for ids that are certainly not among those of the filter."""
    words = F.size(marks.scalar())
    at = F.xxhash64(F.lit("mark"), "doc_id").bitwiseAND((words - 1).cast("long")).cast("int")
    return F.get(marks.scalar(), at).bitwiseAND(_bits()) == _bits()


def _dense(net: Network) -> np.ndarray:
    """All weights but the vectors of words and stems, one after the other."""
    return np.concatenate([*(f.ravel() for f in net.filters), net.biases.ravel(), net.out.ravel(), [net.bias]])


def _with_dense(net: Network, values: np.ndarray) -> Network:
    shapes = [*(f.shape for f in net.filters), net.biases.shape, net.out.shape]
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    parts = [v.reshape(s) for v, s in zip(np.split(values[: ends[-1]], ends[:-1]), shapes)]
    filters = [f.astype(np.float32) for f in parts[: len(WIDTHS)]]
    return Network(net.words, net.stems, filters, parts[-2], parts[-1], float(values[ends[-1]]))


_VALUES = [f"v{d}" for d in range(DIMENSIONS)]
#: What is changed: vectors of words and of stems, all other weights.
_WORDS, _STEMS, _DENSE = range(3)


def _train_parts(known: Known, net: Network, sizes: np.ndarray) -> Network:
    """The mean of networks that each learn from one part of the documents, all from ``net`` on.

    A word's vector is changed by the mean over the networks that change it.  The driver gets one vector per slot.
    """
    weight = sizes.sum() / (2.0 * np.maximum(sizes, 1))

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        texts, y = table.column("text").to_pylist(), table.column("toxic").to_numpy().astype(np.int64)
        if not len(y):
            return pa.schema([("kind", pa.int32()), ("slot", pa.int32()), *((v, pa.float64()) for v in _VALUES)]).empty_table()
        own = train(net, _flat_docs(texts), y, weight)
        changes = []
        for kind, before, after in ((_WORDS, net.words, own.words), (_STEMS, net.stems, own.stems)):
            at = np.flatnonzero((before != after).any(axis=1))
            changes.append((kind, at, (after[at] - before[at]).astype(np.float64)))
        dense = _dense(own) - _dense(net)
        dense = np.append(dense, np.zeros(-len(dense) % DIMENSIONS)).reshape(-1, DIMENSIONS)
        changes.append((_DENSE, np.arange(len(dense)), dense))
        kinds = np.concatenate([np.full(len(at), kind, np.int32) for kind, at, _ in changes])
        slots = np.concatenate([at for _, at, _ in changes]).astype(np.int32)
        values = np.vstack([v for _, _, v in changes])
        return pa.table([pa.array(kinds), pa.array(slots), *(pa.array(values[:, d]) for d in range(DIMENSIONS))], names=["kind", "slot", *_VALUES])

    shape = "kind int, slot int, " + ", ".join(f"{v} double" for v in _VALUES)
    learnt = known.apply(learn, shape).groupBy("kind", "slot").agg(*(F.avg(v).alias(v) for v in _VALUES)).toArrow()
    kinds, slots = learnt.column("kind").to_numpy(), learnt.column("slot").to_numpy()
    values = np.column_stack([learnt.column(v).to_numpy() for v in _VALUES])
    words, stems = net.words.copy(), net.stems.copy()
    for kind, table in ((_WORDS, words), (_STEMS, stems)):
        table[slots[kinds == kind]] += values[kinds == kind]
    dense = values[kinds == _DENSE][np.argsort(slots[kinds == _DENSE])].ravel()
    start = _dense(net)
    return _with_dense(Network(words, stems, net.filters, net.biases, net.out, net.bias), start + dense[: len(start)])


class Scorer:
    """The filters' answer to each slot is worked out once; a window's response is then a sum of table rows."""

    def __init__(self, net: Network):
        self.net = net
        self.words = [[net.words @ f[j] for j in range(len(f))] for f in net.filters]
        self.stems = [[net.stems @ f[j] for j in range(len(f))] for f in net.filters]

    def logits(self, whole: np.ndarray, stem: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(whole)
        after = np.repeat(first[1:], np.diff(first))  # the end of the text that a word is in
        total = np.full(len(first) - 1, float(self.net.bias))
        for k, width in enumerate(WIDTHS):
            z = self.words[k][0][whole] + self.stems[k][0][stem]
            for j in range(1, width):
                inside = np.flatnonzero(np.arange(j, n + j) < after)
                z[inside] += self.words[k][j][whole[inside + j]] + self.stems[k][j][stem[inside + j]]
            peak = np.maximum.reduceat(z, first[:-1], axis=0) + self.net.biases[k]
            total += np.where(peak > 0, peak, 0.1 * peak) @ self.net.out[k]
        return total


def _threshold(logits: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The cut with the least weighted error, in the middle of the gap that it lies in."""
    order = np.argsort(logits)
    z, wrong = logits[order], np.where(y[order] == 1, weights[order], -weights[order])
    errors = np.concatenate([[0], np.cumsum(wrong)])  # positives below the cut less negatives below it
    errors[1:-1][np.diff(z) == 0] = np.inf
    at = int(np.argmin(errors))
    if at in (0, len(z)):
        return float(z[0] - 1 if at == 0 else z[-1] + 1)
    return float((z[at - 1] + z[at]) / 2)


def _flat_docs(texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots of the words and of the stems of each text."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for part in flat.pieces(texts):
        whole, stem, first = word_slots(texts[part])
        found += [(whole[a:b].astype(np.int32), stem[a:b].astype(np.int32)) for a, b in zip(first[:-1], first[1:])]
    return found


def _document_counts(known: Known) -> tuple[np.ndarray, np.ndarray]:
    """In how many documents of each class each word and stem is, and the documents of each class."""

    def count(table: pa.Table) -> pa.Table:
        counts, size = np.zeros((2, 2, SLOTS + 1), np.int64), np.zeros(2, np.int64)
        for doc, label in zip(_flat_docs(table.column("text").to_pylist()), table.column("toxic").to_pylist()):
            size[label] += 1
            for part in range(2):
                counts[part, label, np.unique(doc[part])] += 1
        part, label, slot = np.nonzero(counts)
        ids = np.concatenate([(part * 2 + label) * (SLOTS + 1) + slot, -1 - np.arange(2)])
        return pa.table({"id": pa.array(ids, pa.int64()), "n": pa.array(np.append(counts[part, label, slot], size), pa.int64())})

    found = known.apply(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = found.column("id").to_numpy(), found.column("n").to_numpy()
    counts, sizes = np.zeros(4 * (SLOTS + 1)), np.zeros(2)
    counts[ids[ids >= 0]] = n[ids >= 0]
    sizes[-1 - ids[ids < 0]] = n[ids < 0]
    return counts.reshape(2, 2, -1), sizes


def _logit_counts(known: Known, net: Network, languages: langid.Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Language (-1: none), logit in steps of one ``GRID``-th, label and number of all labelled documents."""

    def count(table: pa.Table) -> pa.Table:
        scorer = Scorer(net)
        texts, labels = table.column("text").to_pylist(), table.column("toxic").to_numpy()
        spoken, steps = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for part in flat.pieces(texts):
            logits = scorer.logits(*word_slots(texts[part]))
            spoken.append(langid.dominant(languages, texts[part]) if languages.langs else np.full(len(logits), -1))
            steps.append(np.rint(np.clip(logits, -LARGEST, LARGEST) * GRID).astype(np.int32))
        columns = {"lang": np.concatenate(spoken), "step": np.concatenate(steps), "toxic": labels}
        return pa.table({name: pa.array(values, pa.int32()) for name, values in columns.items()})

    scored = known.apply(count, "lang int, step int, toxic int")
    found = scored.groupBy("lang", "step", "toxic").agg(F.count("*").alias("n")).orderBy("lang", "step", "toxic").toArrow()
    lang, step, toxic, n = (found.column(c).to_numpy() for c in ("lang", "step", "toxic", "n"))
    return lang, step / float(GRID), toxic.astype(np.int64), n.astype(np.float64)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    lang_col: str = "lang",
) -> Model:
    """Fit on all labelled documents, of which a quarter, by a hash of the id, sets the thresholds.

    Words are counted, networks trained and documents scored by Spark; the driver gets numbers per slot and per step of
    the logits.  Rows with a null id, text or label, or a label other than 0 and 1, are left out; an id that is labelled
    both 0 and 1 counts as 1.  Languages are learnt from ``lang_col`` of ``docs``.  If a class has
    no document, every text gets the same low or high score.
    """
    ship(docs.sparkSession)
    known = (
        labels.select(F.col(id_col).try_cast(docs.schema[id_col].dataType).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    known = materialise(known, "fit-labels")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    languages = langid.fit(docs, text_col=text_col, lang_col=lang_col)
    held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(4)) == 3
    matched = texts.select("doc_id").join(known, "doc_id").groupBy("toxic", held.alias("held")).agg(F.count("*").alias("n")).collect()
    sizes = {k: sum(r["n"] for r in matched if r["toxic"] == k) for k in (0, 1)}
    thresholds = np.zeros(len(languages.langs) + 1)
    if min(sizes.values()) == 0:
        net = _start(np.zeros((2, 2, SLOTS + 1)), np.zeros(2))
        net.out[:], net.bias = 0, 5.0 if sizes[1] else -5.0
        return Model(net, languages, thresholds)
    apart = min(sizes.values()) >= 4 * LEAST
    marks = materialise(_marks(known, known.count()), "fit-marks")

    def labelled(tests: bool, size: int) -> Known:
        """The documents that are learnt from or those that set the thresholds, in parts of about ``size``."""
        own = (held == F.lit(tests)) if apart else F.lit(True)
        n = sum(r["n"] for r in matched if not apart or r["held"] == tests)
        return Known(texts.where(own), known.where(own), marks, max(1, math.ceil(n / size)))

    counts, of_class = _document_counts(labelled(False, COUNTED))
    net = _train_parts(labelled(False, PART), _start(counts, of_class), of_class)
    spoken, logits, y, n = _logit_counts(labelled(True, COUNTED), net, languages)
    if not len(n):
        return Model(net, languages, thresholds)
    thresholds[:] = _threshold(logits, y, n)
    for k in range(len(languages.langs)):
        own = spoken == k
        if min(n[own & (y == 1)].sum(), n[own & (y == 0)].sum()) >= LEAST:
            thresholds[k] = _threshold(logits[own], y[own], n[own])
    return Model(net, languages, thresholds)


def _scores(model: Model, scorer: Scorer, texts: Sequence[str | None]) -> np.ndarray:
    logits = scorer.logits(*word_slots(texts))
    spoken = langid.dominant(model.languages, texts) if model.languages.langs else np.full(len(texts), -1)
    return 1 / (1 + np.exp(-np.clip(logits - model.thresholds[spoken], -30, 30)))


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 of each whole text; 0.5 is the threshold of its language.

    Null and empty texts are scored as a text without words.  One row per input row.  If the input
    has a column called ``score_col``, the new one gets an underscore in front.
    """
    ship(docs.sparkSession)
    name = fresh(docs, score_col)
    at = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.network)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for part in flat.pieces([t or "" for t in texts]):
                found = _scores(model, scorer, texts[part])
                yield batch.slice(part.start, len(found)).append_column(name, pa.array(found, pa.float64()))

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
