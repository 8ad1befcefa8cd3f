"""Nearest neighbours by inner product with an inverted multi-index.

Both halves of the vectors are quantised apart; a cell is a pair of centroids.  For each query the
pairs are taken from a heap in the order of their summed nearness, until the cells hold enough
vectors; these are ranked by the exact product.  The cells of one first centroid are a group, cut into
blocks of bounded size, where the queries that visit it meet its vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.llm.cluster import ship
from venuekit.sources.scratch import materialise

#: Centroids of each half, and vectors that they are fitted on, about.
CENTROIDS, FIT_VECTORS = 64, 20_000
#: Share of all vectors that a query visits.  On vectors without clusters a recall of 0.9 takes this many.
VISIT = 0.5
#: Most vectors and most queries in a block.
BLOCK_VECTORS, BLOCK_QUERIES = 1 << 15, 1 << 12
SEED = 3


def _nearness(halves: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Larger for nearer centroids, by squared distance."""
    return halves @ centroids.T - 0.5 * (centroids * centroids).sum(axis=1)


def centroids(halves: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's method from rows drawn by a fixed seed; a centroid without rows stays."""
    random = np.random.default_rng(SEED)
    found = halves[random.choice(len(halves), min(k, len(halves)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        nearest = _nearness(halves, found).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, halves)
        counts = np.bincount(nearest, minlength=len(found))[:, None]
        found = np.where(counts > 0, sums / np.maximum(counts, 1), found)
    return found


def visit(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> np.ndarray:
    """Which cells to visit, by a walk over pairs of centroids from a heap, nearest sum first."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    x, y, n = first.tolist(), second.tolist(), sizes.tolist()
    taken = np.zeros(sizes.shape, bool)
    heap, reached, total = [(-(x[a[0]] + y[b[0]]), 0, 0)], [0] * len(a), 0
    # reached[i] is the next place of row i; a pair enters the heap when the pairs above and left of it are out
    while heap and total < enough:
        _, i, j = heapq.heappop(heap)
        taken[a[i], b[j]] = True
        total += n[a[i]][b[j]]
        reached[i] = j + 1
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (-(x[a[i + 1]] + y[b[j]]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(x[a[i]] + y[b[j + 1]]), i, j + 1))
    return taken


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _cells(first: np.ndarray, second: np.ndarray):
    half = first.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vector"))
                for name, part in (("row", _nearness(x[:, :half], first)), ("cell", _nearness(x[:, half:], second))):
                    batch = batch.append_column(name, pa.array(part.argmax(axis=1), pa.int32()))
                yield batch

    return work


def _routes(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, share: float, least: int):
    """A row per query and first centroid that it visits, with the cells to visit as packed bits."""
    half, enough = first.shape[1], max(least, int(np.ceil(share * sizes.sum())))
    rows = pa.schema([("rep", pa.int64()), ("vector", pa.list_(pa.float64())), ("row", pa.int32()), ("wanted", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"))
            near, far = x[:, :half] @ first.T, x[:, half:] @ second.T
            for at in range(0, len(x), 64):
                query, row, bits = [], [], []
                for k in range(at, min(at + 64, len(x))):
                    taken = visit(near[k], far[k], sizes, enough)
                    for i in np.flatnonzero(taken.any(axis=1)).tolist():
                        query.append(k)
                        row.append(i)
                        bits.append(np.packbits(taken[i]).tobytes())
                own = pa.array(query, pa.int64())
                yield pa.record_batch([batch.column("rep").take(own), batch.column("vector").take(own), pa.array(row, pa.int32()), pa.array(bits)], schema=rows)

    return work


def _rank(top: int):
    """The best vectors of a block for each of its queries; ties go to the smaller id."""

    def work(key: tuple, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and vectors.num_rows:
            vectors = vectors.sort_by("rep")
            x, ids, cell = _matrix(vectors.column("vector")), vectors.column("rep").to_numpy(), vectors.column("cell").to_numpy()
            q, names = _matrix(queries.column("vector")), queries.column("rep").to_numpy()
            wanted = queries.column("wanted").to_pylist()
            for at in range(0, len(q), 256):
                scores = q[at : at + 256] @ x.T
                bits = np.unpackbits(np.frombuffer(b"".join(wanted[at : at + 256]), np.uint8).reshape(len(scores), -1), axis=1)
                scores[bits[:, cell] == 0] = -np.inf
                for k, line in enumerate(scores):
                    some = np.arange(len(line)) if len(line) <= top else np.flatnonzero(line >= np.partition(line, -top)[-top])
                    some = some[line[some] > -np.inf]
                    some = some[np.argsort(-line[some], kind="stable")][:top]
                    exact = (x[some] * q[at + k]).sum(axis=1)
                    out.append((np.full(len(some), names[at + k]), ids[some], exact))
        columns = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, t) for i, t in enumerate((np.int64, np.int64, np.float64))]
        return pa.table([pa.array(c) for c in columns], names=["query", "found", "score"])

    return work


def nearest(
    vectors: DataFrame,
    every: int = 20,
    top: int = 20,
    k: int = CENTROIDS,
    share: float = VISIT,
    fit_vectors: int = FIT_VECTORS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """For each row whose id is divisible by ``every``, the ``top`` nearest others: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Nearness is the inner product in double precision, larger first, ties to the smaller id.  Rows with a null id or
    a vector that is null, empty, zero or has null or non-finite components take no part, nor do those of another
    length than most (of several equally frequent lengths the smallest).  Equal vectors are searched once and
    stand for their ``top + 1`` smallest ids, beyond which none can be among the nearest.  Every row but the query's own is a
    candidate: rows of its id with other vectors are, and of a repeated row all but one, each a query of its own.
    """
    spark = vectors.sparkSession
    ship(spark)
    usable = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where("id is not null and vector is not null and size(vector) > 0")
        .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
        .where(F.exists("vector", lambda x: x != 0))
    )
    result = "query_id long, rank int, vec_id long, score double"
    lengths = usable.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").head(1)
    if not lengths:
        return spark.createDataFrame([], result)
    usable = usable.where(F.size("vector") == lengths[0]["n"])
    # equal vectors: Spark cuts each group to its smallest ids before it shuffles them
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    kept = usable.withColumn("place", place).where(F.col("place") <= top + 1)
    distinct = materialise(
        kept.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        # an id may have several vectors: a number of its own stands for each
        .select(F.xxhash64("vector").alias("rep_key"), "vector", "ids", F.col("ids")[0].alias("least")),
        "vectors",
    )
    doubled = distinct.groupBy("least").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    rep = F.col("rep_key") if doubled else F.col("least")
    distinct = distinct.select(rep.alias("rep"), "vector", "ids")
    total = distinct.count()
    draw = F.pmod(F.xxhash64(F.lit(SEED), "vector"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = distinct.where(draw * total < fit_vectors).select("rep", "vector").orderBy("rep").toArrow()
    if not sample.num_rows:
        sample = distinct.orderBy("rep").limit(k).select("rep", "vector").toArrow()
    x = _matrix(sample.column("vector"))
    half = x.shape[1] // 2
    first, second = centroids(x[:, :half], k), centroids(x[:, half:], k)
    placed = materialise(distinct.mapInArrow(_cells(first, second), "rep long, vector array<double>, ids array<long>, row int, cell int"), "cells")
    sizes = np.zeros((len(first), len(second)), np.int64)
    for r in placed.groupBy("row", "cell").count().collect():  # a row per cell
        sizes[r["row"], r["cell"]] = r["count"]
    asked = usable.where(F.col("id") % every == 0).select("id", "vector")
    owners = asked.join(distinct, "vector").select("id", "rep")
    queries = distinct.join(asked.select("vector").distinct(), "vector", "left_semi").select("rep", "vector")
    routes = queries.mapInArrow(_routes(first, second, sizes, share, 2 * (top + 1)), "rep long, vector array<double>, row int, wanted binary")
    query_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    blocks = [max(1, -(-int(n) // BLOCK_VECTORS)) for n in sizes.sum(axis=1)]
    of_row = F.get(F.lit(blocks), F.col("row"))
    left = routes.withColumn("query_block", F.pmod(F.xxhash64("rep"), F.lit(query_blocks)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), of_row - 1))
    )
    right = placed.select("rep", "vector", "row", "cell", F.pmod(F.xxhash64("rep"), of_row).cast("int").alias("block")).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )
    keys = "row", "block", "query_block"
    ranked = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rank(top + 1), "query long, found long, score double")
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "found"))
    hits = ranked.withColumn("place", best).where(F.col("place") <= top + 1).select("query", "found", "score")
    lists = (
        hits.join(placed.select(F.col("rep").alias("found"), "ids"), "found")
        .select("query", "found", F.explode("ids").alias("id"), "score")
        .groupBy("query")
        .agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id", "found"))), 1, top + 1).alias("near"))
    )
    # a query is no neighbour of itself: of equal rows one is the query's own
    own = F.array_position(F.transform("near", lambda h: (h["id"] == F.col("id")) & (h["found"] == F.col("query"))), F.lit(True)) - 1
    others = F.slice(F.filter("near", lambda h, i: i != own), 1, top)
    return (
        owners.join(lists, F.col("rep") == F.col("query"))
        .select("id", F.posexplode(others).alias("place", "hit"))
        .select(F.col("id").alias("query_id"), (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))
    )
