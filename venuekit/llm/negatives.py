"""Hard negatives: rows of another class that score just below an anchor's positives.

Each positive of an anchor opens a window of scores below its own.  Windows overlap, but their upper limits cut the
scores into disjoint slots, so that a row falls into one slot and is kept once.  Each task keeps the best few rows of
each slot, and so does the merge of the tasks; going down from a window's upper limit, the best of the slots below are
the best of the window, whose lower limit then only shortens the list.

Anchors are a stated set of queries that meet all rows in blocks of bounded size; no row is sent on but the best.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.llm.cluster import ship
from venuekit.operators.aggregates import group_apart
from venuekit.operators.ranking import top_n_per_group
from venuekit.sources.scratch import materialise

#: Fixed values of the search: positives of an anchor, negatives of a positive, a window's limits in hundredths of the
#: positive's score, and steps of a component.
POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
#: Anchors and rows of a block.
ANCHORS, ROWS = 8192, 8192
#: Anchors whose scores are held at once.
SLICE = 128
_MOST = (1 << 63) - 1
_OUT = -_MOST - 1


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros to ``width``."""
    vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width))
    out[np.repeat(np.arange(len(vectors)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond a long they are held at its ends."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    return np.clip(exact, _OUT + 1, _MOST).astype(np.int64)


def best(scores: np.ndarray, valid: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``n`` largest valid scores of each row, ties to the column further left."""
    many = scores.shape[1]
    if not valid.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if many > n:
        marked = np.where(valid, scores, _OUT)
        least = np.partition(marked, many - n, axis=1)[:, many - n, None]
        above, level = valid & (scores > least), valid & (scores == least)
        room = n - above.sum(axis=1, keepdims=True)
        valid = above | (level & (np.cumsum(level, axis=1) <= room))
    return np.nonzero(valid)


def _blocks(rows: DataFrame, of: str, size: int) -> tuple[DataFrame, int]:
    n = max(1, -(-rows.count() // size))
    return rows.withColumn(of, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")), n


def _meet(anchors: DataFrame, rows: DataFrame, choose: Callable, schema: str) -> DataFrame:
    """``choose`` for each block of anchors with each block of rows; both sides of a group have a bounded size."""
    left, n_left = _blocks(anchors, "block", ANCHORS)
    right, n_right = _blocks(rows, "part", ROWS)
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))))
    # names of its own, as both sides may come from one table
    right = right.select("part", *(F.col(c).alias(f"row_{c}") for c in ("id", "label", "vector"))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1)))
    )

    def work(key: tuple, a: pa.Table, r: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and r.num_rows:
            r = r.sort_by("row_id")  # ties go to the smaller id
            vectors = a.column("vector"), r.column("row_vector")
            width = max(pc.max(pc.list_value_length(v)).as_py() for v in vectors)
            x, y = (_matrix(v, width) for v in vectors)
            ids, names = r.column("row_id").to_numpy(), a.column("id").to_numpy()
            same = a.column("label").to_numpy()[:, None] == r.column("row_label").to_numpy()
            for at in range(0, len(x), SLICE):
                cut = slice(at, at + SLICE)
                scores = _products(x[cut], y)
                for slot, i, j in choose(a.slice(at, SLICE), scores, same[cut], names[cut, None] == ids):
                    out.append((names[cut][i], np.full(len(i), slot, np.int32), ids[j], scores[i, j]))
        columns = [np.concatenate([o[k] for o in out]) if out else np.zeros(0, t) for k, t in enumerate((np.int64, np.int32, np.int64, np.int64))]
        return pa.table([pa.array(c) for c in columns], names=["anchor_id", "slot", "id", "score"])

    keys = "block", "part"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)


def _limits(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score of the window below a positive's, as longs."""
    return max(-(-low * score // 100), _OUT), min(high * score // 100, _MOST)


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Components as whole numbers, held as doubles; null if one is null or not finite."""
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # floor() gives a long and fails beyond it; a double that large is whole as it is
    whole = F.transform(vector.cast("array<double>"), lambda x: F.when(F.abs(x) < 2.0**52 / scale, F.floor(x * scale).cast("double")).otherwise(x * float(scale)))
    return F.when(fit, whole)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score``, ``negative_score``.

    A score is the inner product of two rows' components, each brought to a whole number by ``scale``; larger first, ties to the
    smaller id.  An anchor's positives are its first rows of the same label but itself, its negatives per positive the first
    of other labels whose score lies between ``low`` and ``high`` hundredths of the positive's.  Rows with a null id, label or
    vector, or a component that is null or not finite, take no part.  Of rows that share an id the one with the least
    label, then the least vector, counts, once.  Vectors of different lengths meet as if filled up with zeros; scores
    beyond a long are held at its ends.  An anchor without positives, or whose windows hold nothing, has no rows.
    ``is_anchor`` may name any input column; other columns are not read.
    """
    ship(rows.sparkSession)
    usable = rows.select(
        F.col(id_col).cast("long").alias("id"), F.struct(F.col(label_col).cast("long").alias("label"), scaled(F.col(vector_col), scale).alias("vector"), is_anchor.alias("anchor")).alias("row")
    ).where("id is not null and row.label is not null and row.vector is not null")
    usable = materialise(group_apart(usable, ["id"], F.min("row").alias("row")).select("id", "row.*"), "rows")
    anchors = usable.where("anchor").select("id", "label", "vector")
    pool = usable.select("id", "label", "vector")
    schema = "anchor_id long, slot int, id long, score long"

    def closest(a: pa.Table, scores: np.ndarray, same: np.ndarray, own: np.ndarray):
        yield 0, *best(scores, same & ~own, positives)

    order = F.desc("score"), F.asc("id")
    found = top_n_per_group(_meet(anchors, pool, closest, schema), positives, "anchor_id", *order)
    listed = found.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col("id"), F.col("score")))).alias("positives"))
    listed = materialise(listed, "positives")  # a few positives per anchor

    def slotted(a: pa.Table, scores: np.ndarray, same: np.ndarray, own: np.ndarray):
        """The best of each slot; slot k ends at the k-th highest of the upper limits, and the next begins above it."""
        limits = [[_limits(p["score"], low, high) for p in row] for row in a.column("positives").to_pylist()]
        ends = np.full((len(limits), positives), _OUT)  # an anchor with fewer positives has empty slots
        for i, row in enumerate(limits):
            ends[i, : len(row)] = sorted((top for _, top in row), reverse=True)
        least = np.array([min((min(bottom, _MOST) for bottom, _ in row)) for row in limits], np.int64)
        may = ~same & (scores >= least[:, None])
        for k in range(positives):
            within = may & (scores <= ends[:, k, None])
            if k + 1 < positives:
                within &= scores > ends[:, k + 1, None]
            yield k, *best(scores, within, negatives)

    asked = anchors.join(listed, F.col("id") == F.col("anchor_id")).select("id", "label", "vector", "positives")
    each = _meet(asked, pool, slotted, schema)
    kept = top_n_per_group(each.withColumn("of", F.struct("anchor_id", "slot")), negatives, "of", *order)
    # at most positives x negatives entries an anchor, in descending order
    entry = F.struct((-F.col("score")).alias("minus"), F.col("id"))
    merged = kept.groupBy("anchor_id").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    pairs = listed.select("anchor_id", F.explode("positives").alias("p")).join(merged, "anchor_id")
    hundredths = F.col("p.score").cast("decimal(20,0)")
    upto = F.slice(F.filter("entries", lambda e: -e["minus"].cast("decimal(20,0)") * 100 <= hundredths * high), 1, negatives)
    hits = F.filter(upto, lambda e: -e["minus"].cast("decimal(20,0)") * 100 >= hundredths * low)
    return pairs.select("anchor_id", "p", F.posexplode(hits).alias("place", "hit")).select(
        "anchor_id",
        F.col("p.id").alias("positive_id"),
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        (-F.col("hit.minus")).alias("negative_score"),
    )
