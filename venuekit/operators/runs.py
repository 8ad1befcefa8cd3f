"""Steps for ``mapInArrow`` on partitions in which rows of a key lie together.

The package must have been sent to the workers (``ship``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words that are counted at once; a longer run is counted by itself.
WORDS = 1 << 19


def run_starts(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Where each run of rows begins that have the same first ``keys`` columns."""
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for column in batch.columns[:keys]:
        change[1:] |= np.diff(column.dictionary_encode(null_encoding="encode").indices.to_numpy()) != 0
    return np.flatnonzero(change)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The same rows cut anew, so that no run ends within a batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(run_starts(batch, keys)[-1])
        goes_on = held and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in range(keys))
        if held and (last or not goes_on):
            yield pa.concat_batches([*held, batch.slice(0, last)])
            held = []
        elif last:
            yield batch.slice(0, last)
        held.append(batch.slice(last))
    if held:
        yield pa.concat_batches(held)


def _counted(batches: Iterator[pa.RecordBatch], keys: int = 2, words: int = WORDS, apart: int = 0) -> Iterator[tuple]:
    """Blocks of runs of rows (keys.., words): a batch of the runs' first columns, the block's terms, and arrays run, code and n.

    ``code`` is a term's place among the block's terms, and n how often it occurs in the run; in order of run and code.
    A block has about ``words`` words, and one value of the first ``apart`` columns.
    """
    for batch in whole_runs(batches, keys):
        columns = range(batch.num_columns - 1)
        lists = batch.column(len(columns))
        starts = run_starts(batch, keys)
        before = np.zeros(len(lists) + 1, np.int64)
        np.cumsum(lists.value_lengths().fill_null(0).to_numpy(), out=before[1:])
        cut = np.diff(before[starts] // words, prepend=-1) != 0
        if apart:
            cut |= np.isin(starts, run_starts(batch, apart))
        cuts = [*np.flatnonzero(cut), len(starts)]
        for a, b in zip(cuts, cuts[1:]):
            rows = np.append(starts[a:b], starts[b] if b < len(starts) else len(lists))
            found = lists.slice(rows[0], rows[-1] - rows[0]).flatten().dictionary_encode()
            size = max(len(found.dictionary), 1)
            run = np.repeat(np.arange(b - a), np.diff(before[rows]))
            pairs, n = np.unique(run * size + found.indices.to_numpy(), return_counts=True)
            yield batch.select(columns).take(pa.array(rows[:-1])), found.dictionary, *np.divmod(pairs, size), n


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, part, term, n) of rows (key, part, words)."""
    for named, terms, run, code, n in _counted(batches):
        columns = [*named.take(pa.array(run)).columns, terms.take(pa.array(code)), pa.array(n, pa.int64())]
        yield pa.record_batch(columns, names=[*named.schema.names, "term", "n"])


def _list(values: pa.Array | np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    values = pa.array(values, kind) if kind else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pack_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a block of keys as one row, of rows (key, part, words); a block is called by its first key.

    ``ends`` says where the entries (codes, counts) of each of the keys end; each of the block's terms stands once, with the
    number of keys that have it and of its occurrences.
    """
    for named, terms, run, code, n in _counted(batches):
        keys = named.column(0)
        lists = {
            "keys": _list(keys),
            "ends": _list(np.searchsorted(run, np.arange(len(keys)), "right"), pa.int32()),
            "codes": _list(code, pa.int32()),
            "counts": _list(n, pa.int32()),
            "terms": _list(terms),
            "dfs": _list(np.bincount(code, minlength=len(terms)), pa.int64()),
            "totals": _list(np.bincount(code, n, len(terms)), pa.int64()),
        }
        yield pa.record_batch([keys.slice(0, 1), *lists.values()], names=["block", *lists])


def pack_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """As ``pack_words``, of rows (cohort, batch, key, copies, words): a block has one cohort and batch, and a key counts ``copies`` times."""
    for named, terms, run, code, n in _counted(batches, 3, words, 2):
        yield _packed(named, terms, run, code, n)


def pack_counts(rows: pa.Table) -> pa.Table:
    """The same of rows (cohort, batch, key, copies, term, n) of one key, whose terms are all different."""
    n = rows.num_rows
    named = rows.select(range(4)).slice(0, 1).combine_chunks().to_batches()[0]
    return pa.Table.from_batches([_packed(named, rows.column(4).combine_chunks(), np.zeros(n, np.int64), np.arange(n), rows.column(5).to_numpy())])


def _packed(named: pa.RecordBatch, terms: pa.Array, run: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    keys, copies = named.column(2), named.column(3).to_numpy()
    lists = {
        "keys": _list(keys),
        "ends": _list(np.searchsorted(run, np.arange(len(keys)), "right"), pa.int32()),
        "codes": _list(code, pa.int32()),
        "counts": _list(n * copies[run], pa.int64()),
        "terms": _list(terms),
        "dfs": _list(np.bincount(code, copies[run], len(terms)), pa.int64()),
    }
    columns = [*(c.slice(0, 1) for c in named.columns[:2]), keys.slice(0, 1), *lists.values()]
    return pa.record_batch(columns, names=["cohort", "batch", "block", *lists])


def unpack_weights(block: pa.Table, terms: pa.Table) -> pa.Table:
    """(key, indices, values) of a packed row's keys, in order of the index; ``terms`` has the code, index and idf of its terms."""
    keys, ends, codes, counts = (block.column(c).combine_chunks().flatten() for c in ("keys", "ends", "codes", "counts"))
    at = np.argsort(terms.column("code").to_numpy())
    index, idf = (terms.column(c).to_numpy()[at] for c in ("index", "idf"))
    ends, codes = np.append(0, ends.to_numpy()), codes.to_numpy()
    order = np.lexsort((index[codes], np.repeat(np.arange(len(keys)), np.diff(ends))))
    found = index[codes][order], (counts.to_numpy() * idf[codes])[order]
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in found]
    return pa.table([keys, *lists], names=["BusinessID", "indices", "values"])


def sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, indices, values) in order of the index, of rows (key, index, weight); one without an index adds nothing to its key."""
    for batch in whole_runs(batches, 1):
        key, index, weight = batch.columns
        starts = run_starts(batch, 1)
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
        kept = np.flatnonzero(index.is_valid().to_numpy(zero_copy_only=False))
        run, index, weight = run[kept], index.take(pa.array(kept)).to_numpy(), weight.take(pa.array(kept)).to_numpy()
        order = np.lexsort((index, run))
        ends = pa.array(np.searchsorted(run, np.arange(len(starts) + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (index, weight)]
        yield pa.record_batch([key.take(pa.array(starts)), *lists], names=[batch.schema.names[0], "indices", "values"])
