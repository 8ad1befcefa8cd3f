"""Documents drawn by how much they look like a target corpus.

Both corpora are counted as hashed runs of one to three words.  A batch's texts are joined with a separator between
them, one pass of a regular expression finds all words, and the places where documents begin mask the runs that would
cross from one into the next before everything is counted at once.  The gain of a bucket is the logarithm of how much
more often the target has it; a document's weight is the sum of its gains, and Gumbel noise from a hash of its id turns
the highest scores into a draw by weight.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.llm.cluster import fresh, ship
from venuekit.operators.ranking import numbered
from venuekit.sources.scratch import materialise

#: Fixed values of the draw: longest run of words, buckets, steps of a gain, key of the noise.
RUN, BUCKETS, STEPS, SEED = 3, 10_000, 1000, 42
#: Words from which a document may be drawn, and the share that is drawn.
LEAST_WORDS, PERCENT = 20, 5
#: Bytes of text that are worked on at once; a longer text is gone through in parts of this size.
BYTES = 1 << 20
#: Words up to this length are hashed together, byte by byte; longer ones one by one.
SHORT = 32
SEPARATOR = b"\n"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ONES = np.uint32(0xFFFFFFFF)


@cache
def _steps() -> np.ndarray:
    """The CRC register of each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def _look_up(tables: np.ndarray, at, register: np.ndarray) -> np.ndarray:
    return (
        tables[at, 0, register & np.uint32(255)]
        ^ tables[at, 1, (register >> np.uint32(8)) & np.uint32(255)]
        ^ tables[at, 2, (register >> np.uint32(16)) & np.uint32(255)]
        ^ tables[at, 3, register >> np.uint32(24)]
    )


def _tables(step, n: int) -> np.ndarray:
    """``n`` steps in a row, each as four tables by byte of the register; the first leaves it as it is."""
    tables = np.zeros((n, 4, 256), np.uint32)
    for byte in range(4):
        tables[0, byte] = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
    for i in range(1, n):
        tables[i] = step(tables[i - 1])
    return tables


@cache
def _zeros() -> np.ndarray:
    """What 0 to ``SHORT + 1`` zero bytes make of a register."""
    return _tables(lambda r: _steps()[r & np.uint32(255)] ^ (r >> np.uint32(8)), SHORT + 2)


@cache
def _doubled(power: int) -> np.ndarray:
    """What ``2 ** power`` zero bytes make of a register."""
    before = _zeros()[1:2] if power == 0 else _doubled(power - 1)
    return before if power == 0 else _look_up(before, 0, _look_up(before, 0, _zeros()[0]))[None]


def _advance(register: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Registers after as many zero bytes as ``lengths`` say."""
    out = _look_up(_zeros(), np.minimum(lengths, SHORT + 1), register)
    far = np.flatnonzero(lengths > SHORT + 1)
    if len(far):
        rest, some = lengths[far], register[far]
        for power in range(int(rest.max()).bit_length()):
            odd = (rest >> power) & 1 == 1
            some[odd] = _look_up(_doubled(power), 0, some[odd])
        out[far] = some
    return out


def _registers(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The register of each word, begun at zero.  Words are read together, a byte of each at a time."""
    flat, out = np.frombuffer(data, np.uint8), np.zeros(len(starts), np.uint32)
    order = np.argsort(-np.minimum(lengths, SHORT + 1), kind="stable")
    long = int(np.count_nonzero(lengths > SHORT))
    for i in order[:long].tolist():
        word = data[starts[i] : starts[i] + lengths[i]]
        out[i] = zlib.crc32(word, 0xFFFFFFFF) ^ 0xFFFFFFFF
    order = order[long:]
    at, state, size = starts[order], np.zeros(len(order), np.uint32), lengths[order]
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, side="left"))  # words longer than k
        state[:n] = _steps()[(state[:n] ^ flat[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = state
    return out


def run_buckets(data: bytes, begins: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """All runs of words of the texts that lie in ``data`` at ``begins`` with a separator after each.

    Returns the words' starts and documents, and for each length of run its last words and its buckets.
    """
    spans = np.fromiter(chain.from_iterable(m.span() for m in WORD.finditer(data)), np.int64).reshape(-1, 2)
    starts, lengths = spans[:, 0], spans[:, 1] - spans[:, 0]
    doc = np.searchsorted(begins, starts, side="right") - 1
    own = _registers(data, starts, lengths)
    # what a word adds to a run in front of it: a space and then its bytes
    added = _advance(np.full(len(own), _steps()[32], np.uint32), lengths) ^ own
    runs, state = [], _advance(np.full(len(own), _ONES, np.uint32), lengths) ^ own
    for n in range(RUN):
        if n:
            state = _advance(state[:-1], lengths[n:] + 1) ^ added[n:]
        last = np.arange(n, len(own))
        within = doc[n:] == doc[: len(doc) - n]
        runs.append((last[within], ((state[within] ^ _ONES) % np.uint32(buckets)).astype(np.int64)))
    return starts, doc, runs


def _parts(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A long text in parts that end between words; each begins with the last words of the one before, as many as stated."""
    at, tail = 0, []
    while at < len(text):
        end = min(at + BYTES, len(text))
        gap = WORD.match(text, end - 1) if end < len(text) else None
        end = gap.end() if gap else end
        part = SEPARATOR.join([*tail, text[at:end]])
        yield part, len(tail)
        tail = [*tail, *WORD.findall(text, at, end)][-(RUN - 1) :]
        at = end


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, int]]:
    """The batch as joined texts, where each begins, its row, and how many words at the front were counted before."""
    held, rows, size = [], [], 0

    def joined():
        begins = np.zeros(len(held), np.int64)
        np.cumsum([len(h) + 1 for h in held[:-1]], out=begins[1:])
        return SEPARATOR.join(held), begins, np.array(rows), 0

    for row, text in enumerate(texts):
        text = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
        if len(text) > BYTES:
            for part, known in _parts(text):
                yield part, np.zeros(1, np.int64), np.array([row]), known
            continue
        held.append(text)
        rows.append(row)
        size += len(text)
        if size > BYTES:
            yield joined()
            held, rows, size = [], [], 0
    if held:
        yield joined()


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``, how many runs of one to three words of all texts fall into it."""
    ship(texts.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data, begins, _, known in _pieces(batch.column(0).to_pylist()):
                for last, bucket in run_buckets(data, begins, buckets)[2]:
                    total += np.bincount(bucket[last >= known], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return texts.select(text_col).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket from the counts of both sides, of which the driver holds one row a bucket."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for side, counts in ((s, corpus), (t, target)):
        for r in counts.collect():
            side[r["bucket"]] = r["n"]
    all_s, all_t = int(s.sum()), int(t.sum())
    return [math.floor(STEPS * math.log(float((b + 1) * (all_s + buckets)) / float((a + 1) * (all_t + buckets)))) for a, b in zip(s.tolist(), t.tolist())]


def weights(docs: DataFrame, gain: Sequence[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` its id, ``n_words``, ``n_features`` and ``weight``, the sum of the gains of its runs."""
    spark, buckets = docs.sparkSession, len(gain)
    ship(spark)
    held = spark.sparkContext.broadcast(np.array(gain, np.int64))  # one number a bucket

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for data, begins, rows, known in _pieces(batch.column(1).to_pylist()):
                _, doc, runs = run_buckets(data, begins, buckets)
                for n, (last, bucket) in enumerate(runs):
                    new = last >= known
                    row = rows[doc[last[new]]]
                    found = np.bincount(row, minlength=batch.num_rows)
                    out[0] += found if n == 0 else 0
                    out[1] += found
                    out[2] += np.bincount(row, held.value[bucket[new]], batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], ["id", "n_words", "n_features", "weight"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])
    return docs.select(id_col, text_col).mapInArrow(work, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per row of ``docs`` its id, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``, null if it is not drawn.

    Of the rows with ``least_words`` words the ``percent`` percent with the highest scores are drawn, ties to the smaller id, then to
    the larger weight and the more features.  A null text has no words and weight 0.  A null id is hashed as an empty one
    and comes after all others among ties.  Repeated rows are drawn as rows of their own, next to each other.  An empty
    target or corpus leaves the smoothed gains.  Other columns are not read; a result named like the id gets an underscore in front.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets), buckets)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(STEPS)) * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32)))))
    known = materialise(weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise), "weights")
    may = F.col("n_words") >= least_words
    order = F.desc("score"), F.asc_nulls_last("id"), F.desc("weight"), F.desc("n_features"), F.desc("n_words")
    drawn = known.where(may).count() * percent // 100
    placed = numbered(known.where(may), "place", *order)
    rank = F.when(F.col("place") < drawn, F.col("place").cast("long") + 1)
    every = placed.withColumn("rank", rank).drop("place").unionByName(known.where(~may).withColumn("rank", F.lit(None).cast("long")))
    one = docs.select(id_col)
    return every.select(F.col("id").alias(id_col), *(F.col(c).alias(fresh(one, c)) for c in ("n_words", "n_features", "weight", "score", "rank")))
