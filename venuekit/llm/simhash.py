"""Near copies by SimHash, found with an index in Gray order.

Two fingerprints that differ in at most ``bits`` places agree in one of ``bits + 1`` blocks.  So each
fingerprint is dealt out under its blocks, and only within a group that shares one are others looked
for.  A group is sorted by Gray rank; runs of neighbours become nodes with the bits that all of their
members share, nodes become upper nodes, and whole pairs of nodes are dropped as soon as the
differences added up from the top exceed ``bits``, or once all of their members are in one set.  A large group is
dealt out again by blocks of its remaining bits.  Each group returns a star per set of linked members, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.llm.cluster import fresh, ship
from venuekit.operators.aggregates import group_apart
from venuekit.sources.scratch import materialise

SEED = 42
#: Words of a shingle, and most places in which linked fingerprints differ.
SHINGLE, BITS = 4, 4
#: Members of a node, and nodes of an upper node.
NODE, FANOUT = 32, 16
#: Pairs of nodes that are gone through at once.
PAIRS = 256
#: Members from which a group is dealt out again, and how many times at most.
LARGE, DEPTH = 4096, 3
#: Shingles that are hashed at once.
BATCH = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes.  Only A-Z are lower-cased, words
    end at ASCII white space; fewer words than a shingle has are one shingle, and no word gives 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - shingle + 1)
    stops = (ends - 1)[min(shingle, len(words)) - 1 :].tolist()
    starts = starts[:n].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BATCH):
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[at : at + BATCH], stops[at : at + BATCH])]
        octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs`` its id and ``fingerprint``, as a signed long."""
    ship(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], [id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(work, T.StructType([docs.schema[id_col], T.StructField("fingerprint", T.LongType())]))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Fingerprints in Gray order under levels of nodes; each node has the mask and pattern of the bits that its members share."""

    def __init__(self, values: np.ndarray):
        self.order = np.argsort(gray_rank(values))
        self.values = values[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        masks, patterns, size = np.full(len(values), ~np.uint64(0)), self.values, NODE
        while True:
            starts = np.arange(0, len(patterns), size)
            ones = np.bitwise_and.reduceat(patterns & masks, starts)
            zeros = np.bitwise_and.reduceat(~patterns & masks, starts)
            masks, patterns, size = ones | zeros, ones, FANOUT
            self.levels.append((masks, patterns))
            if len(patterns) <= FANOUT:
                break

    @staticmethod
    def _below(a, b, seen, differ, masks, patterns, size, bits):
        """Pairs one level down whose differences, added to those above, are few enough."""
        i, j = np.divmod(np.arange(size * size), size)
        x, y = (a[:, None] * size + i).ravel(), (b[:, None] * size + j).ravel()
        up = np.repeat(np.arange(len(a)), size * size)
        keep = (x <= y if masks is not None else x < y) & (y < len(patterns))
        x, y, up = x[keep], y[keep], up[keep]
        new = ~seen[up] if masks is None else masks[x] & masks[y] & ~seen[up]
        total = differ[up] + np.bitwise_count((patterns[x] ^ patterns[y]) & new)
        keep = total <= bits
        return x[keep], y[keep], (seen[up] | new)[keep], total[keep]

    def roots(self, bits: int) -> np.ndarray:
        """For each place the least place that it is linked to, over any number of links.

        Pairs of nodes are gone through from the top, near ones first, a block of pairs at a time.  Nodes whose members are all in one
        set already leave the search as a whole, so that a dense group costs little more than its members.
        """
        label = np.arange(len(self.values))
        alike = self._alike(label)
        masks, patterns = self.levels[-1]
        a, b = np.triu_indices(len(patterns))
        near = np.argsort(a - b, kind="stable")  # the last pairs of a block come first
        a, b = a[near], b[near]
        seen = masks[a] & masks[b]
        differ = np.bitwise_count((patterns[a] ^ patterns[b]) & seen).astype(np.int64)
        keep = differ <= bits
        stack = [(len(self.levels) - 1, (a[keep], b[keep], seen[keep], differ[keep]))]
        while stack:
            level, pairs = stack.pop()
            one = alike[level]
            open_ = (one[pairs[0]] < 0) | (one[pairs[0]] != one[pairs[1]])
            pairs = tuple(x[open_] for x in pairs)
            if len(pairs[0]) > PAIRS:
                stack.append((level, tuple(x[:-PAIRS] for x in pairs)))
                pairs = tuple(x[-PAIRS:] for x in pairs)
            if not len(pairs[0]):
                continue
            if level:
                below = self._below(*pairs, *self.levels[level - 1], FANOUT, bits)
                near = np.argsort(below[0] - below[1], kind="stable")
                stack.append((level - 1, tuple(x[near] for x in below)))
                continue
            x, y, _, _ = self._below(*pairs, None, self.values, NODE, bits)
            if self._join(label, x, y):
                alike = self._alike(label)
        return label

    @staticmethod
    def _join(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> bool:
        """Give the sets of linked places the least label of both; False if they had it already."""
        open_ = label[x] != label[y]
        joined = bool(open_.any())
        while open_.any():
            x, y = x[open_], y[open_]
            low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label[:] = label[label]
            open_ = label[x] != label[y]
        return joined

    def _alike(self, label: np.ndarray) -> list[np.ndarray]:
        """By level, the set that all members of a node are in, -1 if they are in several."""
        out, low, high, size = [], label, label, NODE
        for _ in self.levels:
            starts = np.arange(0, len(low), size)
            low, high, size = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), FANOUT
            out.append(np.where(low == high, low, -1))
        return out


def _masks(bits: int) -> list[list[int]]:
    """By depth, the bits that a group of each path shares: blocks of the bits that the path has left."""
    paths, levels = [list(range(64))], []
    shared = [0]
    for _ in range(DEPTH):
        next_paths, next_shared = [], []
        for free, mask in zip(paths, shared):
            for block in np.array_split(np.array(free), bits + 1):
                own = {int(i) for i in block}
                next_paths.append([i for i in free if i not in own])
                next_shared.append(mask | sum(1 << i for i in own))
        paths, shared = next_paths, next_shared
        levels.append(shared)
    return levels


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _deal(rows: DataFrame, depth: int, masks: list[int], bits: int) -> DataFrame:
    """Each row under each block of the bits that its path has left."""
    number = F.explode(F.sequence(F.col("path") * (bits + 1), F.col("path") * (bits + 1) + bits)).alias("path")
    dealt = rows.select(*(c for c in rows.columns if c != "path"), number)
    table = F.lit([_signed(m) for m in masks])
    return dealt.select(F.lit(depth).alias("depth"), F.col("value").bitwiseAND(F.get(table, F.col("path"))).alias("shared"), *dealt.columns)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    """The fourth column of each group; groups, named by the first three, come sorted and may span batches."""
    name, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        depth, path, shared = (batch.column(i).to_numpy() for i in range(3))
        change = (np.diff(depth) != 0) | (np.diff(path) != 0) | (np.diff(shared) != 0)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:]):
            key = int(depth[s]), int(path[s]), int(shared[s])
            if key != name and parts:
                yield pa.concat_arrays(parts)
                parts = []
            name = key
            parts.append(batch.column(3).slice(s, e - s))
    if parts:
        yield pa.concat_arrays(parts)


def _stars(bits: int):
    """Links of each member of a group to the least member of its set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            if len(group) < 2:
                continue
            index = GrayIndex(group.to_numpy().view(np.uint64))
            root = index.roots(bits)
            other = np.flatnonzero(root != np.arange(len(root)))
            if len(other):
                ends = (pa.array(index.values[x].view(np.int64)) for x in (other, root[other]))
                yield pa.RecordBatch.from_arrays([*ends], ["a", "b"])

    return work


def links(values: DataFrame, bits: int = BITS) -> DataFrame:
    """Star links ``a``, ``b`` among the different longs of the column ``value`` that differ in at most ``bits`` places.

    Every value that is linked at all reaches all of its kin over these links.
    """
    dealt = deal_out(values.select("value"), bits).select("depth", "path", "shared", "value")
    return dealt.mapInArrow(_stars(bits), "a long, b long").distinct()


def deal_out(rows: DataFrame, bits: int) -> DataFrame:
    """Each row of ``rows`` in all groups ``depth``, ``path``, ``shared`` of its ``value``; groups are whole and come sorted."""
    masks = _masks(bits)
    rest = rows.withColumn("path", F.lit(0))
    ready = None
    for depth in range(DEPTH):
        dealt = _deal(rest, depth, masks[depth], bits)
        large = dealt.groupBy("path", "shared").agg(F.count("*").alias("n")).where(F.col("n") > LARGE).select("path", "shared")
        last = depth == DEPTH - 1
        large = large if last else materialise(large, "large-groups")
        small = dealt if last or large.isEmpty() else dealt.join(large, ["path", "shared"], "left_anti")
        part = small.select("depth", "path", "shared", *rows.columns)
        ready = part if ready is None else ready.unionAll(part)
        if last or large.isEmpty():
            break
        rest = dealt.join(large, ["path", "shared"], "left_semi").select(*rows.columns, "path")
    return ready.repartition("depth", "path", "shared").sortWithinPartitions("depth", "path", "shared")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its least reachable node) for each end of the links ``a``, ``b``.

    Rounds of large and small stars, each written to the shared folder, until nothing changes.
    Nodes with very many links are a count of rows on the left of a join, which Spark can split.
    """

    def state(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def least(table: DataFrame) -> DataFrame:
        # grouped apart from the join, so that Spark can split a node with many links there
        return group_apart(table, ["a"], F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))

    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, then = None, state(now)
    while before != then:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(least(both), "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.join(least(large), "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = materialise(small.select("e.a", "e.b").where("a <> b").distinct(), "links")
        before, then = then, state(now)
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """Per row of ``docs`` its id, ``fingerprint`` (16 hex digits) and ``component_id``, the least id that it is linked to.

    Null and empty texts, and texts of white space, have fingerprint zero and are linked with each other.
    Rows with a null id get a component by their text but name none, unless no row of it has an id;
    then it is null.  Repeated rows stay.  Other columns are not read.
    """
    spark = docs.sparkSession
    each = materialise(fingerprints(docs, id_col, text_col, shingle).withColumnRenamed(id_col, "id"), "fingerprints")
    values = each.groupBy(F.col("fingerprint").alias("value")).agg(F.min("id").alias("least_id"))
    found = components(spark, links(values.select("value"), bits))
    rooted = values.join(found, F.col("value") == F.col("node"), "left").select("value", "least_id", F.coalesce("root", "value").alias("root"))
    rooted = materialise(rooted, "roots")
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_value = rooted.select("value", "root").join(named, "root").select("value", "component_id")
    return each.join(by_value, F.col("fingerprint") == F.col("value"), "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """The row of ``docs`` with the least id of each set of near copies, with all columns.

    Rows with a null id come after all others, rows of one id are told apart by their contents; of rows
    that are equal in all columns one stays.  Texts without a word are near copies of each other.
    """
    key = fresh(docs, "copy_key")
    # ids that share a text are compared as they are; the hash only orders rows of one id
    keyed = docs.withColumn(key, F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.xxhash64(*docs.columns).alias("row")))
    found = near_copies(keyed.select(key, text_col), key, text_col, shingle, bits)
    kept = found.where(F.col(key) == F.col("component_id")).select(key).distinct()
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
