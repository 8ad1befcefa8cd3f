"""Label the languages of texts, also of texts that switch between several.

The script of a word leaves some languages as candidates, by the scripts that their training
texts are written in.  Each word is scored for these by its letter pairs and triples, and a
Viterbi pass over the words, with a penalty for each switch, gives spans of one language.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.llm import flat
from venuekit.llm.cluster import ship

#: Slots that letter groups are hashed into, a power of two.
SLOTS = 1 << 16
#: Log-likelihood that a change of language costs.
SWITCH = 10.0
#: Share of a language's training letters from which a script counts as one of its own.
SCRIPT_SHARE = 0.01
#: Score of a word in a language that is no candidate.
IMPOSSIBLE = np.float32(-1e4)
UNKNOWN = "und"
#: First code points of script blocks, in order, with the script's number (0: other).
BLOCKS = (
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00BA, 1),
    (0x00BB, 0), (0x00C0, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6),
    (0x0700, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0B80, 9), (0x0C00, 0), (0x0E00, 10), (0x0E80, 0),
    (0x10A0, 11), (0x1100, 12), (0x1200, 13), (0x1380, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 14),
    (0x3100, 0), (0x3400, 15), (0xA000, 0), (0xAC00, 12), (0xD7B0, 0), (0xF900, 15), (0xFB00, 0), (0x20000, 15),
)
SCRIPTS = 16
_BLOCK_STARTS = np.array([b for b, _ in BLOCKS], np.uint32)
_BLOCK_SCRIPTS = np.array([s for _, s in BLOCKS], np.int64)

SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


@dataclass(frozen=True)
class Model:
    """Log-likelihoods of letter groups (slots x languages) and the scripts of each language."""

    langs: tuple[str, ...]
    pairs: np.ndarray
    triples: np.ndarray
    candidates: np.ndarray  # scripts x languages


@dataclass(frozen=True)
class Words:
    """The words (runs of letters) of some texts: positions, texts, scripts and the slots of their letter groups."""

    starts: np.ndarray
    ends: np.ndarray
    text_starts: np.ndarray
    first: np.ndarray  # first word of each text, and the number of words
    scripts: np.ndarray
    inside: np.ndarray
    pairs: np.ndarray
    triples: np.ndarray


def lowered(text: str | None) -> str:
    """Lower case of the same length, so that positions stay."""
    if not text:
        return ""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def read_words(texts: Sequence[str | None]) -> Words:
    points, text_starts = flat.code_points([lowered(t) for t in texts])
    inside = flat.letters()[points]
    starts, ends = flat.runs(inside)
    c = np.where(inside, points, 0).astype(np.uint32)
    one = np.concatenate([np.zeros(1, np.uint32), c[:-1]])
    two = np.where(one > 0, np.concatenate([np.zeros(2, np.uint32), c[:-2]])[: len(c)], 0).astype(np.uint32)
    # the place after a word counts as its end mark
    pair = (one * np.uint32(0x9E3779B1)) ^ (c * np.uint32(0x85EBCA6B))
    triple = (pair ^ (two * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F)
    pair *= np.uint32(0x165667B1)
    counted = inside | (one > 0)
    return Words(
        starts,
        ends,
        text_starts,
        np.searchsorted(starts, text_starts),
        _BLOCK_SCRIPTS[np.searchsorted(_BLOCK_STARTS, points[starts], side="right") - 1] if len(starts) else np.zeros(0, np.int64),
        counted,
        (pair >> np.uint32(16)).astype(np.int32),
        (triple >> np.uint32(16)).astype(np.int32),
    )


def word_scores(model: Model, words: Words) -> np.ndarray:
    """Log-likelihood of each word in each language; of no candidate language ``IMPOSSIBLE``."""
    if not len(words.starts):
        return np.zeros((0, len(model.langs)), np.float32)
    where = np.flatnonzero(words.inside)
    letters = model.pairs[words.pairs[where]]
    letters += model.triples[words.triples[where]]
    # words and their end marks lie one after the other in ``where``
    scores = np.add.reduceat(letters, np.searchsorted(where, words.starts), axis=0) * np.float32(0.5)
    allowed = model.candidates[words.scripts]
    known = allowed.any(axis=1)
    scores[~known] = 0
    scores[known[:, None] & ~allowed] = IMPOSSIBLE
    return scores


def best_path(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word on the best path; ties go to the language that comes first.

    If no stretch of words gains more than one switch costs in any other language than the best
    for the whole text, no path with switches can be better, and the pass is spared.
    """
    whole = scores.sum(axis=0, dtype=np.float64)
    top = int(whole.argmax())
    gain = np.zeros((len(scores) + 1, scores.shape[1]))
    np.cumsum(scores - scores[:, top : top + 1], axis=0, out=gain[1:], dtype=np.float64)
    if (gain - np.minimum.accumulate(gain, axis=0)).max() <= switch:
        return np.full(len(scores), top)
    back = np.empty(scores.shape, np.int32)
    rows, n = scores.tolist(), scores.shape[1]
    value = rows[0]
    for t, row in enumerate(rows[1:], 1):
        best = max(value)
        at, limit = value.index(best), best - switch
        back[t] = [k if value[k] >= limit else at for k in range(n)]
        value = [row[k] + (v if v >= limit else limit) for k, v in enumerate(value)]
    path = np.empty(len(rows), np.int64)
    path[-1] = state = value.index(max(value))
    for t in range(len(rows) - 1, 0, -1):
        path[t - 1] = state = back[t, state]
    return path


def dominant(model: Model, texts: Sequence[str | None]) -> np.ndarray:
    """The number of each text's likeliest language as a whole, -1 without a word."""
    words = read_words(texts)
    total = np.vstack([np.zeros((1, len(model.langs))), np.cumsum(word_scores(model, words), axis=0, dtype=np.float64)])
    found = (total[words.first[1:]] - total[words.first[:-1]]).argmax(axis=1)
    return np.where(np.diff(words.first) > 0, found, -1)


def _label(model: Model, texts: Sequence[str | None]) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
    if not model.langs:
        yield from ((UNKNOWN, 0.0, []) for _ in texts)
        return
    words = read_words(texts)
    scores, sizes = word_scores(model, words), words.ends - words.starts
    for i, origin in enumerate(words.text_starts[:-1]):
        a, b = words.first[i], words.first[i + 1]
        if a == b:
            yield UNKNOWN, 0.0, []
            continue
        path = best_path(scores[a:b])
        letters = np.bincount(path, sizes[a:b], len(model.langs))
        top = int(letters.argmax())
        cuts = np.flatnonzero(np.diff(path)) + 1
        bounds = np.concatenate([[0], cuts, [b - a]])
        spans = [
            (int(words.starts[a + s] - origin), int(words.ends[a + e - 1] - origin), model.langs[path[s]])
            for s, e in zip(bounds[:-1], bounds[1:])
        ]
        yield model.langs[top], float(letters[top] / letters.sum()), spans


def label_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` its id, ``lang_pred``, ``score`` and ``spans``.

    ``lang_pred`` has most of the text's letters on the best path (ties: the name that sorts
    first), ``score`` is its share of them.  A text that is null or has no letter is ``und`` with
    score 0 and no spans, and so is any text if the model knows no language.  ``spans`` holds start, end and language of each stretch.  Other columns
    of the input are not read, so their names can't clash.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in flat.pieces([t or "" for t in texts]):
                found = list(_label(model, texts[part]))
                spans = [[dict(zip(("start", "end", "lang"), s)) for s in row[2]] for row in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.start, len(found)),
                        pa.array([row[0] for row in found], pa.string()),
                        pa.array([row[1] for row in found], pa.float64()),
                        pa.array(spans, _ARROW_SPANS),
                    ],
                    [id_col, "lang_pred", "score", "spans"],
                )

    schema = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("spans", SPANS),
        ]
    )
    return docs.select(id_col, text_col).mapInArrow(label, schema)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of slots and scripts (kinds 2, 3 and 0) by language."""
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            own = [t for t, x in zip(texts, langs) if x == lang]
            for part in flat.pieces(own):
                words = read_words(own[part])
                where = words.inside
                for kind, values in ((2, words.pairs[where]), (3, words.triples[where]), (0, words.scripts)):
                    slots, counts = np.unique(values, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(slots), pa.string()), pa.array([kind] * len(slots), pa.int32()), pa.array(slots, pa.int32()), pa.array(counts, pa.int64())],
                        ["lang", "kind", "slot", "n"],
                    )


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on all documents with a text and a language.

    Counts are made by Spark; the driver gets at most ``2 * SLOTS + SCRIPTS`` numbers per language.
    Without any row the model knows no language.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    counts = (
        rows.mapInArrow(_count, "lang string, kind int, slot int, n long")
        .groupBy("lang", "kind", "slot")
        .agg(F.sum("n").alias("n"))
        .toArrow()
        .to_pandas()
    )
    langs = tuple(sorted(counts["lang"].unique()))
    number = {x: i for i, x in enumerate(langs)}

    def table(kind: int, size: int) -> np.ndarray:
        own, n = counts[counts["kind"] == kind], np.zeros((size, len(langs)))
        np.add.at(n, (own["slot"].to_numpy(), own["lang"].map(number).to_numpy(dtype=np.int64)), own["n"].to_numpy())
        return n

    def logs(n: np.ndarray) -> np.ndarray:
        return np.log((n + 0.1) / (n.sum(axis=0) + 0.1 * len(n))).astype(np.float32)

    scripts = table(0, SCRIPTS)
    return Model(langs, logs(table(2, SLOTS)), logs(table(3, SLOTS)), scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1))
