"""Count the tokens of a byte-level tokenizer by running a transducer over the bytes of texts.

The tokenizer is compiled to a deterministic transducer.  Its state is the longest end of what was
read that begins a longer vocabulary entry, with the last token before each place in that reach where
such an entry may have begun; a transition on a byte carries the change in the number of tokens.  (A prefix's last token follows
from earlier ones: it is the only entry that ends there and that the merges leave apart from the last token
before it.)  States and transitions are worked out when they are first met.

Long runs of text are cut into chunks, all of which take each step together.  Each chunk
gives a map from entry states to exit state and count; a prefix scan by doubling composes the maps.
A text longer than ``PIECE`` is cut into pieces that may run on different executors; their maps,
the ends still open in symbols, are composed per text in the same way.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuekit.llm import flat
from venuekit.llm.cluster import ship

#: Code points in a piece of a long text.
PIECE = 1 << 20
#: Bytes in a chunk.
CHUNK = 512
#: States after which a worker starts its table anew.
STATES = 120_000


@cache
def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Transducer:
    """States by number; ``next`` and ``emit`` have a row per state and a column per byte met."""

    def __init__(self, path: str):
        self.model = tokenizers.Tokenizer.from_file(path).model
        self.letters = byte_letters()
        self.back = back = {c: b for b, c in self.letters.items()}
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        usable = [w for w in model["vocab"] if w and all(c in back for c in w)]
        self.tokens = {bytes(back[c] for c in w) for w in usable}
        self.after: dict[bytes, dict[bytes, int]] = {}  # by left part: right part and rank of each merge
        self.made: dict[bytes, tuple[bytes, int]] = {}  # right part and rank of the merge that makes an entry
        for rank, merge in enumerate(model["merges"]):
            left, right = (bytes(back[c] for c in w) for w in (merge.split(" ") if isinstance(merge, str) else merge))
            self.after.setdefault(left, {})[right] = rank
            self.made.setdefault(left + right, (right, rank))
        self.beginnings = {t[:i] for t in self.tokens for i in range(len(t))}  # of longer entries
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.shapes: dict[bytes, tuple[list, list, bytes]] = {}
        self.merges: dict[tuple[bytes, bytes], list[tuple[bytes, int]]] = {}
        self.alike: dict[tuple[bytes, bytes], bytes] = {}
        self.first_of: dict[tuple, bytes] = {}
        self.reset()

    def reset(self) -> None:
        self.numbers = {(b"", b""): 0}
        self.states = [(b"", [(b"", 0)])]
        self.column = np.full(256, -1, np.int32)
        self.columns = 0
        self.next = np.full((1024, 64), -1, np.int32)
        self.emit = np.zeros((1024, 64), np.int8)

    def encode(self, part: bytes) -> list[bytes]:
        return [bytes(self.back[c] for c in t.value) for t in self.model.tokenize("".join(self.letters[b] for b in part))]

    def stays(self, one: bytes, two: bytes) -> bool:
        """The merges leave these two tokens as they are."""
        pair = one, two
        if pair not in self.apart:
            self.apart[pair] = self.encode(one + two) == ([one, two] if one else [two])
        return self.apart[pair]

    def like(self, token: bytes, begun: bytes) -> bytes:
        """The first token met that acts like ``token`` before every entry that begins with ``begun``.

        What may cross the border is a merge of a right end of the token, ranked before the merge
        that takes this end up, with something that such an entry can begin with.
        """
        ends, limit, end = [], len(self.tokens) + 1, token
        while True:
            if (found := self.merges.get((end, begun))) is None:
                own = self.after.get(end, {})
                found = self.merges[end, begun] = [(b, r) for b, r in own.items() if b.startswith(begun) or begun.startswith(b)]
            ends += [(end, b, r < limit) for b, r in found if r <= limit]
            if end not in self.made:
                break
            end, limit = self.made[end]
        return self.first_of.setdefault((begun, frozenset(ends)), token)

    def shape(self, reach: bytes) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]], bytes]:
        """Entries that end here, longest first; what longer ones may have begun with; the reach from the first of these."""
        n = len(reach)
        open_ = [(i, reach[i:]) for i in range(n) if reach[i:] in self.beginnings]
        return [(i, reach[i:]) for i in range(n) if reach[i:] in self.tokens], open_, open_[0][1] if open_ else b""

    def note(self, token: bytes, begun: bytes) -> bytes:
        # nothing stands before the first token of a piece
        found = self.alike[token, begun] = self.like(token, begun) if token else b""
        return found

    def compile(self, state: int, byte: int) -> None:
        """Work out one transition.  A state's history has, from the reach's start to now, the last
        token of each prefix and how many tokens more than now it has."""
        reach, history = self.states[state]
        reach += bytes([byte])
        if (shape := self.shapes.get(reach)) is None:
            shape = self.shapes[reach] = self.shape(reach)
        ends, open_, rest = shape
        apart = self.apart
        for i, token in ends:
            before, n = history[i]
            stays = apart.get((before, token))
            if stays or stays is None and self.stays(before, token):
                break
        n += 1
        # only where an entry may have begun that is still open does the past matter
        alike = self.alike
        past = [alike.get((history[i][0], b)) or self.note(history[i][0], b) for i, b in open_], [history[i][1] - n for i, _ in open_]
        target = rest, token, *past[0], *past[1]
        number = self.numbers.setdefault(target, len(self.states))
        if number == len(self.states):
            kept = {i: entry for (i, _), entry in zip(open_, zip(*past))}
            first = len(reach) - len(rest)
            self.states.append((rest, [*(kept.get(i) for i in range(first, len(reach))), (token, 0)]))
        if self.column[byte] < 0:
            self.column[byte] = self.columns
            self.columns += 1
        rows, width = self.next.shape
        if len(self.states) > rows or self.columns > width:
            rows, width = rows * (2 if len(self.states) > rows else 1), width * (2 if self.columns > width else 1)
            for name, empty in (("next", -1), ("emit", 0)):
                old = getattr(self, name)
                new = np.full((rows, width), empty, old.dtype)
                new[: old.shape[0], : old.shape[1]] = old
                setattr(self, name, new)
        self.next[state, self.column[byte]] = number
        self.emit[state, self.column[byte]] = n

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All lanes read one byte each: their next states and the counts that the transitions carry."""
        column = self.column[byte]
        if len(column) and column.min() < 0:
            target = np.full(len(state), -1, np.int32)
        else:
            target = self.next[state, column]
        if len(target) and target.min() < 0:
            missing = target < 0
            for key in np.unique(state[missing].astype(np.int64) * 256 + byte[missing]).tolist():
                s, b = divmod(key, 256)
                if self.column[b] < 0 or self.next[s, self.column[b]] < 0:
                    self.compile(s, b)
            column = self.column[byte]
            target = self.next[state, column]
        return target, self.emit[state, column]

    def counts(self, data: np.ndarray, resets: np.ndarray) -> np.ndarray:
        """The count that each byte adds; the state starts anew where ``resets`` is true (as at byte 0)."""
        if len(self.states) > STATES:
            self.reset()
        n = len(data)
        lanes = -(-n // CHUNK)
        pad = lanes * CHUNK - n
        bytes_ = np.concatenate([data, np.zeros(pad, np.uint8)]).reshape(lanes, CHUNK).T.copy()
        fresh = np.concatenate([resets, np.ones(pad, bool)]).reshape(lanes, CHUNK).T.copy()
        added = np.zeros((CHUNK, lanes), np.int8)
        state = np.zeros(lanes, np.int32)
        for i in range(CHUNK):
            state[fresh[i]] = 0
            state, added[i] = self.step(state, bytes_[i])
        head = np.where(fresh.any(axis=0), fresh.argmax(axis=0), CHUNK)  # bytes that depend on the entry state
        exits = {k: {0: int(q)} for k, q in enumerate(state.tolist())}
        # maps of chunks without a reset: close them under the states that can come in
        open_, known = head == CHUNK, [dict() for _ in range(lanes)]
        todo = {(k, int(state[k - 1])) for k in np.flatnonzero(head > 0).tolist() if k}
        while todo:
            lane = np.array([k for k, _ in todo])
            entry = np.array([q for _, q in todo], np.int32)
            order = np.argsort(-head[lane], kind="stable")
            lane, entry = lane[order], entry[order]
            size, now = head[lane], entry.copy()
            part = np.zeros((int(size.max()), len(lane)), np.int8)
            for i in range(int(size.max())):
                m = int(np.searchsorted(-size, -i, side="left"))  # lanes whose head is longer than i
                now[:m], part[i, :m] = self.step(now[:m], bytes_[i, lane[:m]])
            todo = set()
            for j, (k, q) in enumerate(zip(lane.tolist(), entry.tolist())):
                known[k][q] = (int(now[j]), part[: size[j], j].copy())
                if open_[k]:
                    exits[k][q] = int(now[j])
                    after = k + 1
                    if after < lanes and head[after] and exits[k][q] not in known[after]:
                        todo.add((after, exits[k][q]))
        maps = [{q: end for q, (end, _) in known[k].items()} if k and open_[k] else Always(int(q)) for k, q in enumerate(state.tolist())]
        entries = [0, *(m[0] for m in scan(maps))]
        for k in range(1, lanes):
            if head[k]:
                added[: head[k], k] = known[k][entries[k]][1]
        return added.T.reshape(-1)[:n]


class Always(dict):
    """The map of a chunk whose exit state hangs on no entry state."""

    def __init__(self, value: int):
        super().__init__()
        self.value = value

    def __missing__(self, entry: int) -> int:
        return self.value


def scan(maps: list[dict[int, int]]) -> list[dict[int, int]]:
    """Each map after all those before it, by doubling: after each round an entry covers twice as many maps."""

    def after(first: dict[int, int], then: dict[int, int]) -> dict[int, int]:
        return Always(then[first.value]) if isinstance(first, Always) else {q: then[x] for q, x in first.items()}

    step = 1
    while step < len(maps):
        maps = maps[:step] + [then if isinstance(then, Always) else after(first, then) for first, then in zip(maps, maps[step:])]
        step *= 2
    return maps


@cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


@cache
def special_strings(path: str) -> tuple[str, ...]:
    """Special tokens, which the library takes out of a text before all else."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
    kinds = found.get("normalizer"), (found.get("pre_tokenizer") or {}).get("type"), (found["pre_tokenizer"] or {}).get("use_regex")
    if kinds != (None, "ByteLevel", True) or any(t | plain != t for t in found["added_tokens"]):
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    return tuple(t["content"] for t in found["added_tokens"])


@cache
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space."""
    import regex

    kinds = np.zeros(0x110000, np.int8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for number, pattern in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\p{White_Space}")):
        kinds[[ord(c) for c in regex.findall(pattern, every)]] = number
    return kinds


def word_starts(points: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Where the pieces begin that merges never cross: optional space and letters, numbers or others,
    common English contractions, and white space but for the space that starts the next piece.

    ``cut`` is true where a text begins; what lies on the two sides of a cut does not touch.
    """
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = _classes()[points]
    opens = cut.copy()
    opens[0] = True
    before = np.concatenate([[np.int8(-1)], kind[:-1]])
    before[opens] = -1
    after = np.concatenate([kind[1:], [np.int8(-1)]])
    after[:-1][opens[1:]] = -1
    blank = kind == 3
    space = np.concatenate([[False], points[:-1] == 0x20]) & ~opens
    # a run of one class starts a piece, unless a plain space before it has done so
    starts = (kind != before) & ~(~blank & space)
    # the last of several white-space characters before something else is a piece of its own
    starts |= blank & (after >= 0) & (after != 3)
    # contractions
    quote = np.flatnonzero((points == 0x27) & starts & (before != 0))
    room = np.concatenate([points, np.zeros(3, points.dtype)])
    for ending in ("s", "t", "m", "d", "re", "ve", "ll"):
        fits = np.ones(len(quote), bool)
        for j, c in enumerate(ending, 1):
            at = np.minimum(quote + j, n)
            fits &= (room[quote + j] == ord(c)) & ~np.concatenate([opens, [True]])[at]
        found = quote[fits]
        starts[found + 1] = False
        end = found + len(ending) + 1
        starts[end[end < n]] = True
    return starts | opens


def count_tokens(texts: Sequence[str], path: str) -> np.ndarray:
    """Tokens of each text, special strings in it being one token each."""
    special = special_strings(path)
    counts = np.zeros(len(texts), np.int64)
    plain: list[str] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        parts = [text]
        for mark in special:
            if mark in text:
                split = [p.split(mark) for p in parts]
                counts[i] += sum(len(p) - 1 for p in split)
                parts = [x for p in split for x in p]
        parts = [p for p in parts if p]
        plain += parts
        owner += [i] * len(parts)
    machine = transducer(path)
    for part in flat.pieces(plain):
        joined = "".join(plain[part])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(p) for p in plain[part]])
        cut = np.zeros(len(points), bool)
        cut[np.cumsum(sizes) - sizes] = True
        starts = word_starts(points, cut)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        first = np.cumsum(width) - width
        data = np.frombuffer(joined.encode(), np.uint8)
        resets = np.zeros(len(data), bool)
        resets[first[starts]] = True
        added = machine.counts(data, resets)
        total = np.concatenate([[0], np.cumsum(added, dtype=np.int64)])
        begin = first[np.cumsum(sizes) - sizes]
        np.add.at(counts, owner[part], total[np.append(begin[1:], len(data))] - total[begin])
    return counts


def _summaries(texts: Sequence[str], path: str) -> list[tuple[str, int, str, bool]]:
    """A piece's map, its ends in symbols: text up to the first place where a word surely starts,
    tokens from there to the last such place, the text after it, and whether there is such a place.

    White space after anything else starts a word, whatever comes before and after.
    """
    special = special_strings(path)
    found, inner = [], []
    for text in texts:
        kind = _classes()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        sure = np.flatnonzero((kind[1:] == 3) & (kind[:-1] != 3)) + 1
        if any(c.isspace() for mark in special for c in mark):
            sure = sure[:0]  # a special string may span such a place
        a, b = (int(sure[0]), int(sure[-1])) if len(sure) else (len(text), len(text))
        inner.append(text[a:b])
        found.append((text[:a], text[b:], bool(len(sure))))
    return [(h, int(n), t, s) for (h, t, s), n in zip(found, count_tokens(inner, path))]


def compose(summaries: Sequence[tuple[str, int, str, bool]], path: str) -> int:
    """Tokens of a text from the maps of its pieces, in order."""
    between, total, pending = [], 0, []
    for head, n, tail, sure in summaries:
        pending.append(head)
        if sure:
            between.append("".join(pending))
            total += n
            pending = [tail]
    between.append("".join(pending))
    return total + int(count_tokens(between, path).sum())


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` its id, ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``path`` is a byte-level tokenizer's file, the same on every machine.  Null and empty texts have no
    tokens.  Rows with equal or null ids stay apart.  Other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col]
    short, long = rows.where(F.length("text") <= PIECE), rows.where(F.length("text") > PIECE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in flat.pieces(texts):
                own = texts[part]
                ids = batch.column(0).slice(part.start, len(own))
                sizes = pa.array([len(t.encode()) for t in own], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(count_tokens(own, path), pa.int64())], [id_col, "n_bytes", "n_tokens"])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, counts, tails, sure = zip(*_summaries(batch.column("piece").to_pylist(), path))
            rest = batch.drop_columns(["piece"])
            for name, values in (("head", heads), ("n", counts), ("tail", tails), ("sure", sure)):
                rest = rest.append_column(name, pa.array(values))
            yield rest

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                compose([(p["head"], p["n"], p["tail"], p["sure"]) for p in sorted(ps, key=lambda p: p["piece_no"])], path)
                for ps in batch.column("pieces").to_pylist()
            ]
            yield batch.drop_columns(["pieces"]).append_column("n_tokens", pa.array(found, pa.int64()))

    schema = T.StructType([kind, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    counted = short.mapInArrow(count, schema)
    names = [id_col, "n_bytes", "text_key", "row_no", "piece_no", "piece"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(4)[i].as_py()
                for k, at in enumerate(range(0, len(text), PIECE)):
                    rest = [batch.column(c).slice(i, 1) for c in range(4)]
                    yield pa.RecordBatch.from_arrays([*rest, pa.array([k], pa.int32()), pa.array([text[at : at + PIECE]])], names)

    whole = long.select(
        F.col(id_col), F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("text_key"), F.monotonically_increasing_id().alias("row_no"), "text"
    )
    cut_schema = T.StructType([*whole.schema.fields[:4], T.StructField("piece_no", T.IntegerType()), T.StructField("piece", T.StringType())])
    pieces = whole.mapInArrow(cut, cut_schema).repartition("text_key", "piece_no")
    mapped = pieces.mapInArrow(
        summarise,
        T.StructType([*[f for f in pieces.schema.fields if f.name != "piece"], *T._parse_datatype_string("head string, n long, tail string, sure boolean").fields]),
    )
    grouped = mapped.groupBy("row_no", "text_key", id_col, "n_bytes").agg(
        F.collect_list(F.struct("piece_no", "head", "n", "tail", "sure")).alias("pieces")
    )
    composed = grouped.select(id_col, "n_bytes", "pieces").mapInArrow(finish, schema)
    return counted.unionAll(composed)
