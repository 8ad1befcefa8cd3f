"""Topics by online variational Bayes (Hoffman, Blei, Bach 2010), with the topics' term weights spread over the cluster.

MLlib's solver holds vocabulary times topics on the driver several times over.  Here a topic's weight of a term is

    scale * (start(term) + gained(term)) + floor

where ``start`` comes from a hash of the term, ``scale`` and ``floor`` follow from the step alone and ``gained`` is the
sum of what the batches before have added.  It is handed from the batch a term occurs in to the next such batch, so
that each term and batch is written and read once.  Documents come in packed blocks, whose terms alone meet these weights.  Every document is in one of ``BATCHES`` batches, by a hash of its id, and
is learnt from once.  The driver holds some numbers per topic.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.operators.ranking import top_n_per_group
from venuekit.sources.scratch import materialise, owned_folder

# Settings of MLlib's solver.
BATCHES = 20
LEARNING_OFFSET, LEARNING_DECAY = 1024.0, 0.51
START_SHAPE = 100
CHANGE = 1e-3
#: Names of a step's two rows that are no terms: sums of the documents' topic logarithms, and what the topics gained.
MIXES, GAINS = None, ""
#: Words, about, of the documents that are worked on together, as their likelihoods fit into a cache.
TOGETHER = 1 << 14
#: Blocks of a batch whose terms' gains are stored by one task.
FILE_BLOCKS = 8
_BELOW = np.arange(6.0)


def digamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by recurrence up to 6 and the asymptotic series."""
    x = np.asarray(x, np.float64)
    y = x + 6.0
    below = (1.0 / (x[..., None] + _BELOW)).sum(axis=-1)
    z = 1.0 / (y * y)
    return np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240))) - below


def trigamma(x: np.ndarray) -> np.ndarray:
    y = np.asarray(x, np.float64) + 6.0
    below = sum(1.0 / ((y - j) * (y - j)) for j in range(1, 7))
    z = 1.0 / (y * y)
    return 1.0 / y + 0.5 * z + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z / 30))) + below


def mixes_of(weights: np.ndarray, codes: np.ndarray, ends: np.ndarray, likely: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents' topic parameters, a row each, and the share of each of their words' weights (columns) that each topic takes.

    ``likely`` has a row per topic and a column per term of the block; a document's words go up to its end.  Documents of like length
    go through the same steps together, each until it changes no more.
    """
    starts, k = np.append(0, ends[:-1]), len(alpha)
    sizes = ends - starts
    gammas, taken = np.empty((len(ends), k)), np.empty((k, len(codes)))
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        longest = sizes[order[at:]]
        fit = longest * np.arange(1, len(longest) + 1) <= TOGETHER
        docs = order[at : at + max(1, int(np.argmin(fit)) if not fit.all() else len(longest))]
        at += len(docs)
        n = sizes[docs[-1]]
        place = starts[docs, None] + np.arange(n)
        inside = np.arange(n) < sizes[docs, None]
        place[~inside] = 0
        own, weight = np.ascontiguousarray(likely[:, codes[place]]), np.where(inside, weights[place], 0.0)
        gamma = _settled(own, weight, alpha)
        theta = np.exp(digamma(gamma))
        ratio = weight / (np.einsum("kd,kdn->dn", theta.T, own) + 1e-100)
        own *= theta.T[:, :, None]
        own *= ratio
        gammas[docs], taken[:, place[inside]] = gamma, own[:, inside]
    return gammas, taken


def _settled(own: np.ndarray, weight: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Topic parameters of documents, from their terms' likelihoods (topic, document, word) and weights (document, word)."""
    k, documents, _ = own.shape
    final, left = np.empty((documents, k)), np.arange(documents)
    gamma, going = np.ones((documents, k)), np.ones(documents, bool)
    seen, ratio = np.empty_like(weight), np.empty_like(weight)
    while True:
        # what topics have in common cancels out, so that parameters need no sum
        theta = np.exp(digamma(gamma))
        np.einsum("kd,kdn->dn", theta.T, own, out=seen)
        seen += 1e-100
        np.divide(weight, seen, out=ratio)
        new = theta * np.matmul(own.transpose(1, 0, 2), ratio[:, :, None])[:, :, 0] + alpha
        change, gamma = np.abs(new - gamma).mean(axis=1), new
        done = going & (change <= CHANGE)
        if done.any():
            final[left[done]] = gamma[done]
            going &= ~done
            if not going.any():
                return final
            if going.sum() * 4 <= len(going) * 3:
                own, weight, gamma, left = np.ascontiguousarray(own[:, going]), weight[going], gamma[going], left[going]
                seen, ratio, going = np.empty_like(weight), np.empty_like(weight), np.ones(len(left), bool)


def next_alpha(alpha: np.ndarray, mean_log: np.ndarray, documents: int, rate: float) -> np.ndarray:
    """One Newton step for the documents' prior, as long as it stays positive."""
    slope = documents * (digamma(alpha.sum()) - digamma(alpha) + mean_log)
    q = -documents * trigamma(alpha)
    b = (slope / q).sum() / (1.0 / (documents * trigamma(alpha.sum())) + (1.0 / q).sum())
    new = alpha - rate * (slope - b) / q
    return new if (new > 0).all() else alpha


def batch_of(key: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(BATCHES)).cast("int")


def next_batch(batches: Column, batch: Column) -> Column:
    """The batch after ``batch`` that ``batches``, one bit each, has; ``BATCHES`` if none follows."""
    later = F.call_function("shiftright", batches, batch + 1)
    zeros = F.bit_count(later.bitwiseAND(-later) - 1)
    return F.when(later == 0, F.lit(BATCHES)).otherwise(batch + 1 + zeros).cast("int")


def _start(topic: int, seed: int) -> Column:
    """A draw from Gamma(100, 1/100), by a term's hash and the cube of a normal one."""
    h = F.xxhash64(F.lit(seed), F.lit(topic), "term")
    one, two = ((x.cast("double") + 0.5) / 2.0**32 for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))))
    normal = F.sqrt(F.log(one) * -2.0) * F.cos(two * (2 * math.pi))
    return F.pow(normal / (3.0 * START_SHAPE**0.5) + (1.0 - 1.0 / (9 * START_SHAPE)), F.lit(3.0))


def fit(packed: DataFrame, terms: DataFrame, documents: DataFrame, k: int, seed: int, n_words: int) -> tuple[DataFrame, DataFrame]:
    """(BusinessID, topic_distribution) of all documents and (topic, topic_word) with the ``n_words`` likeliest words.

    The package must have been sent to the workers (``ship``).  ``packed`` has the counts of blocks of documents: batch, block, keys,
    ends, codes and counts; ``terms`` batch, block, code, term, idf and next; ``documents`` BusinessID and batch.  All are stored tables.
    A document without words has the mix that the prior gives it.
    """
    spark = packed.sparkSession
    topics = range(k)
    gained, weights = [f"a{t}" for t in topics], [f"l{t}" for t in topics]
    sizes = {r["batch"]: r["n"] for r in documents.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    blocks = {r["batch"]: r["n"] for r in packed.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    corpus = sum(sizes.values())
    # the last blocks of a term name no batch that follows, so that they list the terms
    listed = materialise(terms.where(F.col("next") == BATCHES).select("term").distinct(), "topic-terms")
    first = listed.agg(F.count("*").alias("n"), *(F.sum(_start(t, seed)).alias(f"s{t}") for t in topics)).first()
    n_terms, sums = first["n"], np.array([first[f"s{t}"] or 0.0 for t in topics])
    alpha = np.full(k, 1.0 / k)
    scale, floor = 1.0, 0.0
    folder = owned_folder(spark, f"topics-{uuid.uuid4().hex}")
    fields = [T.StructField("term", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in gained)]
    stored = T.StructType([*fields, T.StructField("step", T.IntegerType()), T.StructField("next", T.IntegerType())])
    steps = 0

    def state(batch: int) -> DataFrame:
        """What terms have gained up to a batch, one row for each that has occurred before."""
        if not steps:
            return spark.createDataFrame([], T.StructType(fields))
        return spark.read.schema(stored).parquet(folder).where(F.col("next") == batch).select("term", *gained)

    def weighted(rows: DataFrame, batch: int) -> DataFrame:
        """``rows`` with the topics' weights of their terms."""
        lam = ((_start(t, seed) + F.coalesce(gained[t], F.lit(0.0))) * scale + floor for t in topics)
        met = rows.join(state(batch).hint("shuffle_hash"), "term", "left")
        return met.select(*rows.columns, *(x.alias(c) for x, c in zip(lam, weights)))

    def likely(table: pa.Table, total: np.ndarray) -> np.ndarray:
        """A row per topic, a column per code."""
        lam = np.column_stack([table.column(c).to_numpy() for c in weights])
        return np.ascontiguousarray(np.exp(digamma(lam) - digamma(total)).T)

    def mixed(block: pa.Table, table: pa.Table, total: np.ndarray) -> tuple:
        """The places of the block's documents with words, their parameters, codes of the words, and what topics take of them."""
        ends, codes, counts = (block.column(c).combine_chunks().flatten().to_numpy() for c in ("ends", "codes", "counts"))
        some = np.flatnonzero(np.diff(ends, prepend=0))
        weight = counts * table.column("idf").to_numpy()[codes]
        return some, *mixes_of(weight, codes, ends[some], likely(table, total), alpha), codes

    def together(rows: DataFrame, met: DataFrame, n: int, learn, shape: T.StructType) -> DataFrame:
        """Blocks beside their terms, dealt out by number: there are few, and each is long work."""
        dealt = rows.repartition(max(1, min(2 * n, most)), "block")
        return dealt.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(learn, shape)

    for batch in range(BATCHES):
        if not sizes.get(batch):
            continue
        total = scale * sums + floor * n_terms
        rate = (LEARNING_OFFSET + steps + 1) ** -LEARNING_DECAY
        share = rate * corpus / sizes[batch] / (scale * (1 - rate))

        def learn(block: pa.Table, table: pa.Table) -> pa.Table:  # used up by the write below, before what it reads changes
            table = table.sort_by("code")
            _, gamma, taken, codes = mixed(block, table, total)
            gains = np.column_stack([np.bincount(codes, x, table.num_rows) for x in taken]) * share
            logs = (digamma(gamma) - digamma(gamma.sum(axis=1))[:, None]).sum(axis=0)
            gains = np.vstack([gains, taken.sum(axis=1) * share, logs])
            names = pa.concat_arrays([*(table.column("term").cast(pa.string()).chunks), pa.array([GAINS, MIXES], pa.string())])
            after = np.append(table.column("next").to_numpy(), [-1, -1])
            return pa.table([names, pa.array(after, pa.int32()), *(pa.array(gains[:, t]) for t in topics)], names=["term", "next", *gained])

        rows = packed.where(F.col("batch") == batch).select("block", "ends", "codes", "counts")
        own = terms.where(F.col("batch") == batch).select("block", "code", "term", "idf", "next")
        shape = T.StructType([fields[0], T.StructField("next", T.IntegerType()), *fields[1:]])
        found = together(rows, weighted(own, batch), blocks.get(batch, 1), learn, shape)
        before = state(batch).select("term", F.lit(None).cast("int").alias("next"), *gained)
        new = found.unionByName(before).groupBy("term").agg(F.max("next").alias("next"), *(F.sum(c).alias(c) for c in gained))
        # few files, as each of the batches to come reads its own of them
        files = math.ceil(blocks[batch] / FILE_BLOCKS) if batch in blocks else 1
        new.repartition(files, "term").write.partitionBy("next").parquet(f"{folder}/step={batch}")
        steps += 1
        at = spark.read.schema(stored).parquet(folder).where((F.col("step") == batch) & (F.col("next") == -1))
        totals = {r["term"]: np.array([r[c] for c in gained]) for r in at.collect()}
        scale, floor = scale * (1 - rate), floor * (1 - rate) + rate / k
        if totals:  # a batch of wordless documents teaches nothing
            sums = sums + totals[GAINS]
            alpha = next_alpha(alpha, totals[MIXES] / sizes[batch], sizes[batch], rate)

    total = scale * sums + floor * n_terms

    def infer(block: pa.Table, table: pa.Table) -> pa.Table:
        some, gamma, _, _ = mixed(block, table.sort_by("code"), total)
        shares = (gamma / gamma.sum(axis=1)[:, None]).ravel()
        ends = pa.array(np.arange(len(some) + 1) * k, pa.int32())
        keys = block.column("keys").combine_chunks().flatten().take(pa.array(some))
        return pa.table([keys, pa.ListArray.from_arrays(ends, pa.array(shares))], names=["BusinessID", "topic_distribution"])

    shape = T.StructType([documents.schema["BusinessID"], T.StructField("topic_distribution", T.ArrayType(T.DoubleType()))])
    final = materialise(weighted(listed, BATCHES), "topic-terms")
    # a block is called by its first document and has one batch
    rows = packed.select("block", "keys", "ends", "codes", "counts")
    met = terms.select("block", "code", "term", "idf").join(final.hint("shuffle_hash"), "term")
    mixed_rows = together(rows, met, sum(blocks.values()), infer, shape)
    prior = F.lit([float(x) for x in alpha / alpha.sum()])
    distribution = documents.select("BusinessID").join(mixed_rows, "BusinessID", "left")
    distribution = distribution.select("BusinessID", F.coalesce("topic_distribution", prior).alias("topic_distribution"))
    ranked = final.select("term", F.posexplode(F.array(*weights)).alias("topic", "weight"))
    best = top_n_per_group(ranked, n_words, "topic", F.desc("weight"), F.asc("term"))
    words = best.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("words"))
    return materialise(distribution, "topic-mixes"), materialise(words.select("topic", F.col("words.term").alias("topic_word")), "topic-words")
