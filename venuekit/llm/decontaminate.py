"""Find documents that hold an item of a benchmark, whole or with a few words changed.

Words are symbols.  The random walk of Chakraborty, Goldenberg and Koucky copies a window's symbols
one by one and moves on by the toss of a coin that depends on step and symbol, so that a few edits
turn into a few differing places.  Places sampled from the walk are hashed to keys, with a new
walk for each of ``REPEATS``; a window and an item that share a key are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.llm import flat
from venuekit.llm.cluster import fresh, ship
from venuekit.sources.scratch import materialise

#: Share of an item's words that may be inserted, left out or exchanged.
EDITS = 0.2
#: Walks, and places sampled from each.
REPEATS, SAMPLED = 16, 2
#: Ratio of the item lengths (in words) that share walks and a window size.
RATIO = 1.25
#: Slots of the filters of item grams and item keys: this many for each value, up to a bound, in powers of two.
SLOTS_EACH, LEAST_SLOTS, MOST_SLOTS = 16, 1 << 16, 1 << 22
#: Length classes that a slot tells apart; classes beyond share its bits.
CLASS_BITS = 32
SEED = 5


def allowed(n: int) -> int:
    """Edits that an item of ``n`` words may have."""
    return int(EDITS * n + 1e-9)


def length_class(n: int) -> int:
    return math.ceil(math.log(n) / math.log(RATIO) - 1e-9)


def class_lengths(c: int) -> tuple[int, int]:
    """Shortest and longest item of a length class."""
    own = [n for n in range(max(1, int(RATIO ** (c - 1))), int(RATIO**c) + 2) if length_class(n) == c]
    return own[0], own[-1]


def gram_length(n: int) -> int:
    """Words that some stretch without edits has at least, 3 at most."""
    d = allowed(n)
    return min(3, -(-(n - d) // (d + 1)))


def grams_left(n: int) -> int:
    """Grams that a window keeps at least, whatever the edits."""
    g = gram_length(n)
    return max(1, n - g + 1 - allowed(n) * g)


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits, in lower case) of all texts, and where each text begins."""
    points, text_starts = flat.code_points([(t or "").lower() for t in texts])
    starts, ends = flat.runs(flat.alphanumerics()[points])
    return flat.run_hashes(points, starts, ends), np.searchsorted(starts, text_starts)


def gram_hashes(words: np.ndarray, g: int) -> np.ndarray:
    """A hash of the ``g`` words from each place; the last ``g - 1`` places have none."""
    n = max(0, len(words) - g + 1)
    h = np.full(n, g, np.uint64)
    for j in range(g):
        h = flat.mix(h + words[j : j + n])
    return h


def walk_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, c: int) -> np.ndarray:
    """For each window its key from each walk (windows x repeats).  After its end a window goes on with zeros."""
    steps = max(1, int(1.25 * class_lengths(c)[0]))
    random = np.random.default_rng([SEED, c])
    padded = np.append(words, np.uint64(0))
    keys = np.empty((len(starts), REPEATS), np.uint64)
    for r in range(REPEATS):
        coins = random.integers(0, 1 << 63, steps, dtype=np.uint64)
        sampled = set(random.choice(steps, min(SAMPLED, steps), replace=False).tolist())
        at, key = starts.copy(), np.full(len(starts), (c << 16) + r, np.uint64)
        for j in range(max(sampled) + 1):
            symbol = np.where(at < ends, padded[np.minimum(at, len(words))], np.uint64(0))
            if j in sampled:
                key = flat.mix(key + symbol)
            at += (flat.mix(symbol ^ coins[j]) >> np.uint64(63)).astype(np.int64)
        keys[:, r] = key
    return keys


def _side_by_side(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The lists as rows filled up with zeros, and their lengths."""
    sizes = np.array([len(x) for x in lists], np.int64)
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.uint64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.concatenate(lists)
    return out, sizes


def words_shared(items: list[np.ndarray], regions: list[np.ndarray]) -> np.ndarray:
    """Words of each item that its region has too; an item has more edits than words that it doesn't share."""
    (a, sizes), (b, _) = _side_by_side(items), _side_by_side(regions)
    shared = np.zeros(len(a), np.int64)
    for i in range(a.shape[1]):
        shared += (b == a[:, i : i + 1]).any(axis=1) & (i < sizes)
    return shared


def distances(items: list[np.ndarray], regions: list[np.ndarray]) -> np.ndarray:
    """Words to insert, leave out or exchange to turn each item into the beginning of its region that is nearest to it."""
    (a, sizes), (b, widths) = _side_by_side(items), _side_by_side(regions)
    rows, columns = a.shape[1], b.shape[1]
    across = np.arange(columns + 1)
    beyond = across[None, :] > widths[:, None]
    line = np.broadcast_to(across, (len(items), columns + 1)).copy()
    best = np.zeros(len(items), np.int64)
    for i in range(rows):
        new = np.empty_like(line)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(line[:, 1:] + 1, line[:, :-1] + (a[:, i : i + 1] != b))
        line = np.minimum.accumulate(new - across, axis=1) + across
        last = sizes == i + 1
        if last.any():
            best[last] = np.where(beyond[last], rows + columns, line[last]).min(axis=1)
    return best


def _read_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, first = symbols(batch.column(1).to_pylist())
        rows = [words[a:b] for a, b in zip(first[:-1], first[1:])]
        keys, grams = [], []
        for own in rows:
            n = len(own)
            keys.append(walk_keys(own, np.zeros(1, np.int64), np.array([n]), length_class(n))[0].view(np.int64) if n else [])
            grams.append(gram_hashes(own, gram_length(n)).view(np.int64) if n else [])
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([np.asarray(r).view(np.int64) if len(r) else [] for r in x], longs) for x in (rows, keys, grams))],
            ["item", "words", "keys", "grams"],
        )


def _filter(rows: DataFrame, column: str, classes: list[int]) -> np.ndarray:
    """For each slot a bit for each class that has a value there, by the value's low bits.

    The driver gets ``MOST_SLOTS`` numbers at most; with more values slots fill up, which only costs work.
    """
    size = F.size("words")
    of = F.coalesce(*(F.when(size.between(*class_lengths(c)), F.lit(1 << (i % CLASS_BITS))) for i, c in enumerate(classes)), F.lit(0))
    values = rows.select(of.cast("long").alias("of"), F.explode(column).alias("v"))
    wanted = SLOTS_EACH * values.count()
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << wanted.bit_length()))
    found = values.groupBy(F.col("v").bitwiseAND(F.lit(slots - 1)).cast("int").alias("slot")).agg(F.bit_or("of").alias("of")).toArrow()
    bits = np.zeros(slots, np.uint32)
    bits[found.column("slot").to_numpy()] = found.column("of").to_numpy().astype(np.uint32)
    return bits


def crowded(at: np.ndarray, least: int, region: int, text_of: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of a text from which the next ``region`` places hold at least ``least`` of the places ``at``."""
    if len(at) < least:
        return np.zeros(0, np.int64)
    low, high = at[least - 1 :], at[: len(at) - least + 1]
    begin = np.maximum(low - region + 1, first[text_of[high]])
    fit = (text_of[low] == text_of[high]) & (begin <= high)
    begin, end = begin[fit], high[fit] + 1
    begin = np.maximum(begin, np.append(0, np.maximum.accumulate(end))[: len(end)])  # each place once
    sizes = np.maximum(end - begin, 0)
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _windows(grams, keys, classes: list[int]):
    """Windows of documents that keep enough item grams and have the key of some item; ``grams`` and ``keys`` are broadcast filters."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram_bits, key_bits = grams.value, keys.value
        gram_mask, key_mask = np.uint64(len(gram_bits) - 1), np.uint64(len(key_bits) - 1)
        lengths = {c: range(class_lengths(c)[0], class_lengths(c)[1] + 1) for c in classes}
        sizes = sorted({gram_length(n) for own in lengths.values() for n in own})
        longs = pa.list_(pa.int64())
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in flat.pieces([t or "" for t in texts]):
                words, first = symbols(texts[part])
                hits = {}
                for g in sizes:
                    of = gram_bits[(gram_hashes(words, g) & gram_mask).astype(np.int64)]
                    at = np.flatnonzero(of)
                    hits[g] = at, of[at]
                text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
                end_of = first[1:][text_of]
                for i, c in enumerate(classes):
                    longest, bit = lengths[c][-1], np.uint32(1 << (i % CLASS_BITS))
                    region = longest + allowed(longest)
                    starts = []
                    for g in {gram_length(n) for n in lengths[c]}:
                        least = min(grams_left(n) for n in lengths[c] if gram_length(n) == g)
                        at, of = hits[g]
                        starts.append(crowded(at[(of & bit) != 0], least, region, text_of, first))
                    start = np.unique(np.concatenate(starts))
                    end = np.minimum(start + region, end_of[start])
                    for at in range(0, len(start), 1 << 14):
                        own, own_end = start[at : at + (1 << 14)], end[at : at + (1 << 14)]
                        found = walk_keys(words, own, own_end, c)
                        likely = (key_bits[(found & key_mask).astype(np.int64)] & bit) != 0
                        some = np.flatnonzero(likely.any(axis=1))
                        if not len(some):
                            continue
                        texts_hit = text_of[own[some]]
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array(texts_hit + part.start)),
                                pa.array(own[some] - first[texts_hit], pa.int64()),
                                pa.array([words[own[k] : own_end[k]].view(np.int64) for k in some], longs),
                                pa.array([np.unique(found[k][likely[k]]).view(np.int64) for k in some], longs),
                            ],
                            ["doc", "start", "region", "keys"],
                        )

    return work


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
            lists = [[np.asarray(r, np.int64).view(np.uint64) for r in part.column(name).to_pylist()] for name in ("words", "region")]
            sizes, most = (np.array([f(len(x)) for x in lists[0]]) for f in (int, allowed))
            may = np.flatnonzero(words_shared(*lists) >= sizes - most)
            if not len(may):
                continue
            near = distances(*([rows[i] for i in may] for rows in lists))
            own = part.select(["region_key", "item"]).take(pa.array(may)).append_column("distance", pa.array(near, pa.int64()))
            yield own.filter(pa.array(near <= most[may]))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row per document and item in it: both ids, ``distance`` (edited words) and ``start``, the number
    of the word at which the nearest window starts (of several the first).

    A window counts if at most a fifth of the item's words are inserted, left out or exchanged; case,
    punctuation and white space don't count.  Items without an id or a word are in no document, and null or
    empty texts hold none.  Rows of equal (or null) ids count as one document.  Items may be
    many: only filters of fixed size reach every task, and the rest is joined by key.
    """
    spark = docs.sparkSession
    ship(spark)
    item = items.schema[item_col].dataType
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("item", item), *(T.StructField(n, longs) for n in ("words", "keys", "grams"))])
    read = items.select(item_col, item_text_col).mapInArrow(_read_items, schema)
    read = materialise(read.where((F.size("words") > 0) & F.col("item").isNotNull()), "items")
    counts = [r[0] for r in read.select(F.size("words")).distinct().collect()]
    classes = sorted({length_class(n) for n in counts})
    work = _windows(*(spark.sparkContext.broadcast(_filter(read, name, classes)) for name in ("grams", "keys")), classes)
    schema = T.StructType(
        [T.StructField("doc", docs.schema[id_col].dataType), T.StructField("start", T.LongType()), T.StructField("region", longs), T.StructField("keys", longs)]
    )
    windows = docs.select(id_col, text_col).mapInArrow(work, schema).withColumn("region_key", F.md5(F.col("region").cast("string")))
    windows = materialise(windows, "windows")
    regions = windows.groupBy("region_key").agg(F.any_value("region").alias("region"), F.any_value("keys").alias("keys"))
    keyed = regions.select("region_key", F.explode("keys").alias("key"))
    item_keys = read.select("item", F.explode("keys").alias("key"))
    pairs = keyed.join(item_keys, "key").select("region_key", "item").distinct()
    compared = pairs.join(regions.select("region_key", "region"), "region_key").join(read.select("item", "words"), "item")
    near = compared.select("region_key", "item", "words", "region").mapInArrow(
        _verify, T.StructType([T.StructField("region_key", T.StringType()), T.StructField("item", item), T.StructField("distance", T.LongType())])
    )
    best = windows.select("doc", "start", "region_key").join(near, "region_key").groupBy("doc", "item").agg(F.min(F.struct("distance", "start")).alias("best"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "best.distance", "best.start")


def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text holds no item."""
    key = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    found = find_items(keyed, items, key, text_col, **options)
    return keyed.join(found.select(key).distinct(), key, "left_anti").select(*docs.columns)
