"""Quality of texts by how tokenisers that never saw them take to them.

Public vocabularies were fitted to ordinary prose: of such text they need few tokens.  A text that takes many tokens a
character, falls back to bytes, or spreads its tokens too evenly or too little is code, noise, shouting or a repeated
line.  What is usual differs from language to language, so each language, or script where none is known, has its own
band around its middle half, counted over all its documents, and a text outside a band is rejected.
"""

from __future__ import annotations

import base64
import io
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuekit.llm.cluster import fresh, ship
from venuekit.sources.scratch import materialise

#: Words and share of repeated words, in percent, of the rules that come first.
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
SYMBOLS, SPACES = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
#: Bytes of text that are worked on at once; longer texts are gone through in parts.
BYTES = 1 << 22
#: A band reaches this many times the width of the middle half beyond it.
REACH = 3.0
#: Documents from which a group has a band of its own; smaller ones have that of all documents.
LEAST_DOCUMENTS = 100
#: Measures, in steps of a thousandth, with the least width of a middle half and the sides on which a text fails.
MEASURES = {"chars_per_token": (0.02, "both"), "byte_share": (0.005, "above"), "evenness": (0.02, "both")}
STEP = 1000
#: First code point of each block of scripts, in order; between them letters count as other.
SCRIPTS = ((0x41, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "other"), (0x590, "Hebrew"), (0x600, "Arabic"), (0x700, "other"),
           (0x900, "Indic"), (0xE00, "Thai"), (0xE80, "other"), (0x3040, "Kana"), (0x3100, "other"), (0x3400, "Han"), (0xA000, "other"),
           (0xAC00, "Hangul"), (0xD7B0, "other"))


class Vocabulary:
    """A tokenizer file, applied to words; which of its tokens stand for less than a character."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size = model.vocab_size()
            self.part = np.array([model.is_byte(i) or model.is_unknown(i) for i in range(self.size)])
            self._words = lambda words: model.encode(words, num_threads=1)
        else:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, Path(path).read_bytes().splitlines())}
            model = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.size = max(ranks.values()) + 1
            self.part, self._first = np.zeros(self.size, bool), np.zeros(self.size, bool)
            for piece, rank in ranks.items():
                self.part[rank], self._first[rank] = "\ufffd" in piece.decode("utf-8", "replace"), piece.startswith(b" ")
            self._words, self._line = None, model.encode_ordinary

    def tokens(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of some words in a row, and how many each has."""
        if self._words:
            lists = self._words(words)
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes
        # a word has no space inside, so that a token that begins with one begins a word
        flat = np.array(self._line("".join(f" {w}" for w in words)), np.int32)
        begins = np.flatnonzero(self._first[flat])
        return flat, np.diff(begins, append=len(flat))


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def repeated_words(words: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words lie in a run of ``window`` words that the same text has twice or more; both arrays go by place."""
    out = np.zeros(len(words), bool)
    if len(words) < window:
        return out
    many, name = int(words.max()) + 1, doc.astype(np.int64)
    for k in range(window):
        name = name[: len(words) - k] * many + words[k:]
        if k % 2:  # number the runs anew, so that the numbers stay small
            _, name = np.unique(name, return_inverse=True)
    _, name, counts = np.unique(name, return_inverse=True, return_counts=True)
    twice = (counts[name] > 1) & (doc[: len(name)] == doc[window - 1 :])
    for k in range(window):
        out[k : k + len(twice)] |= twice
    return out


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier one."""
    seen, n = set(), 0
    for line in io.BytesIO(text):
        line = line.removesuffix(b"\n")
        if line.strip():
            n += line in seen
            seen.add(line)
    return n


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts that end at white space; a word as long as a part stays whole."""
    at = 0
    while at < len(text):
        end = at + BYTES
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[at:end]
        at = end


def _expand(tokens: tuple[np.ndarray, np.ndarray], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the words named by ``index`` in a row, and how many each has."""
    flat, sizes = tokens
    wanted = sizes[index]
    shift = np.repeat((np.cumsum(sizes) - sizes)[index] - (np.cumsum(wanted) - wanted), wanted)
    return flat[np.arange(len(shift)) + shift], wanted


class _Tally:
    """What is known of the texts of a batch: base counts and, by vocabulary, tokens, parts of characters and the sum of c log c."""

    def __init__(self, texts: Sequence[str | None], paths: Sequence[str]):
        self.books = [vocabulary(p) for p in paths]
        self.base = np.zeros((5, len(texts)), np.int64)
        self.n = np.zeros((len(paths), len(texts)))
        self.partial, self.spread = np.zeros_like(self.n), np.zeros_like(self.n)
        self.scripts: list[str | None] = [None] * len(texts)
        held: list[list[bytes]] = []
        rows: list[int] = []
        size = 0
        for row, text in enumerate(texts):
            text = text or ""
            data = text.encode("utf-8", "replace")
            self.base[1, row] = len(text) - (len(data) - len(data.translate(None, SPACES)))
            self.base[2, row] = len(data) - len(data.translate(None, SYMBOLS))
            self.base[3, row] = repeated_lines(data)
            self.scripts[row] = script(text)
            if len(data) > BYTES:
                self._long(row, data)
                continue
            held.append(data.split())
            rows.append(row)
            size += len(data)
            if size > BYTES:
                self._some(held, rows)
                held, rows, size = [], [], 0
        if held:
            self._some(held, rows)

    @staticmethod
    def _numbered(words: list[bytes], number: dict[bytes, int]) -> np.ndarray:
        for w in words:
            if w not in number:
                number[w] = len(number)
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words))

    def _some(self, held: list[list[bytes]], rows: list[int]) -> None:
        number: dict[bytes, int] = {}
        words = self._numbered(list(chain.from_iterable(held)), number)
        doc = np.repeat(np.array(rows), [len(h) for h in held])
        self.base[0, rows] = [len(h) for h in held]
        self.base[4] += np.bincount(doc[repeated_words(words, doc)], minlength=self.base.shape[1])
        if not number:
            return
        spelled = [w.decode() for w in number]
        for b, book in enumerate(self.books):
            flat, sizes = _expand(book.tokens(spelled), words)
            pairs, counts = np.unique(np.repeat(doc, sizes) * book.size + flat, return_counts=True)
            of, token = np.divmod(pairs, book.size)
            self.n[b] += np.bincount(of, counts, self.n.shape[1])
            self.partial[b] += np.bincount(of, counts * book.part[token], self.n.shape[1])
            self.spread[b] += np.bincount(of, counts * np.log2(counts), self.n.shape[1])

    def _long(self, row: int, data: bytes) -> None:
        """One long text in parts: of each only the numbers of its words are kept."""
        every: dict[bytes, int] = {}
        names, counts = [], [np.zeros(book.size, np.int64) for book in self.books]
        for part in _parts(data):
            words = part.split()
            names.append(self._numbered(words, every).astype(np.int32))
            number: dict[bytes, int] = {}
            index = self._numbered(words, number)
            spelled = [w.decode() for w in number]
            for book, count in zip(self.books, counts):
                if number:
                    count += np.bincount(_expand(book.tokens(spelled), index)[0], minlength=book.size)
        words = np.concatenate(names)
        self.base[0, row] = len(words)
        self.base[4, row] = np.count_nonzero(repeated_words(words, np.zeros(len(words), np.int64)))
        for b, (book, count) in enumerate(zip(self.books, counts)):
            some = count[count > 0]
            self.n[b, row], self.partial[b, row], self.spread[b, row] = some.sum(), count[book.part].sum(), (some * np.log2(some)).sum()

    def measures(self) -> list[np.ndarray]:
        """By measure its mean over the vocabularies; a text without tokens has zeros."""
        n = np.maximum(self.n, 1)
        bits = np.log2(n) - self.spread / n  # entropy of the text's tokens
        found = self.base[1] / n, self.partial / n, bits / np.maximum(np.log2(n), 1)
        return [np.where(self.base[0] > 0, f.mean(axis=0), 0.0) for f in found]


@cache
def _blocks() -> np.ndarray:
    return np.array([start for start, _ in SCRIPTS])


def script(text: str) -> str | None:
    """The script of most letters, the first listed of several; None without letters."""
    counts = np.zeros(len(SCRIPTS), np.int64)
    for at in range(0, len(text), BYTES):
        points = np.frombuffer(text[at : at + BYTES].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = (points >= 0xC0) | ((points | 0x20) - np.uint32(0x61) < 26)
        counts += np.bincount(np.searchsorted(_blocks(), points[letter], side="right") - 1, minlength=len(SCRIPTS))
    return SCRIPTS[int(counts.argmax())][1] if counts.any() else None


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, paths: Sequence[str], id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """Per row ``id``, ``band`` (its language or else its script; null without either), the base counts and the measures."""
    spark = docs.sparkSession
    ship(spark)
    lang = F.lit(None).cast("string") if lang_col is None else F.col(lang_col).cast("string")
    paths = list(paths)
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    schema = f"id {kind}, band string, {', '.join(f'{c} long' for c in BASE)}, {', '.join(f'{c} double' for c in MEASURES)}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tally = _Tally(batch.column(1).to_pylist(), paths)
            band = [given if given is not None else own for given, own in zip(batch.column(2).to_pylist(), tally.scripts)]
            columns = [batch.column(0), pa.array(band, pa.string()), *map(pa.array, tally.base), *map(pa.array, tally.measures())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "band", *BASE, *MEASURES])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.alias("lang")).mapInArrow(work, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def bands(measured: DataFrame, reach: float = REACH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``band``, ``measure``, ``low`` and ``high`` from all texts that pass the base rules; the row with a null band is of all.

    A measure's quarters are read from exact counts of its values in steps of a thousandth, so that they
    do not hang on how the rows lie.  A group of fewer documents than ``least_documents`` has no row.
    """
    steps = F.create_map(*chain.from_iterable((F.lit(m), F.floor(F.col(m) * STEP)) for m in MEASURES))
    values = measured.where(~base_failed()).select("band", F.explode(steps).alias("measure", "value"))
    own = values.groupBy("band", "measure", "value").agg(F.count("*").alias("n"))
    total = own.groupBy("measure", "value").agg(F.sum("n").alias("n")).withColumn("band", F.lit(None).cast("string"))
    counts = own.where("band is not null").unionByName(total)
    side = Window.partitionBy("band", "measure")
    run = counts.withColumn("upto", F.sum("n").over(side.orderBy("value"))).withColumn("all", F.sum("n").over(side))
    quarter = {k: F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("value"))) / F.lit(float(STEP)) for k in (1, 3)}
    found = run.groupBy("band", "measure").agg(quarter[1].alias("q1"), quarter[3].alias("q3"), F.max("all").alias("n"))
    least = F.coalesce(*(F.when(F.col("measure") == m, F.lit(w)) for m, (w, _) in MEASURES.items()))
    both = F.col("measure").isin([m for m, (_, s) in MEASURES.items() if s == "both"])
    width = F.greatest(F.col("q3") - F.col("q1"), least) * reach
    return found.where(F.col("band").isNull() | (F.col("n") >= least_documents)).select(
        "band", "measure", F.when(both, F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high")
    )


def judge(
    docs: DataFrame,
    paths: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    reach: float = REACH,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """Per row of ``docs`` its id, the base counts, the measures, ``base_failed``, ``outside`` (measures beyond their band) and ``kept``.

    ``paths`` name tokenizer files, ``.tiktoken`` or ``.model``.  A null text is an empty one: it has zeros and fails.  A text without
    letters and language is held against the band of all documents, and so is one whose group is small; where no text passes the base
    rules there are no bands and nothing more is rejected.  Repeated rows stay and count as often as they are there.
    Other columns are not read; a result named like the id gets an underscore in front.
    """
    measured = materialise(measure(docs, paths, id_col, text_col, lang_col), "measured")
    named = bands(measured, reach, least_documents).groupBy("band").agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high")))).alias("of"))
    named = materialise(named, "bands")
    joined = measured.join(named.where("band is not null"), "band", "left")
    limits = F.coalesce("of", named.where("band is null").select("of").scalar())

    def beyond(m: str) -> Column:
        low, high = limits[m]["low"], limits[m]["high"]
        return F.coalesce((F.col(m) < low) | (F.col(m) > high), F.col(m) < low, F.col(m) > high, F.lit(False))

    outside = F.array_compact(F.array(*(F.when(beyond(m), F.lit(m)) for m in MEASURES)))
    judged = joined.withColumn("base_failed", base_failed()).withColumn("outside", outside)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0))
    one = docs.select(id_col)
    return judged.select(F.col("id").alias(id_col), *(F.col(c).alias(fresh(one, c)) for c in (*BASE, *MEASURES, "band", "base_failed", "outside", "kept")))
