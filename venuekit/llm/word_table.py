"""Encode texts with a word-level byte-pair tokenizer by way of a table of their distinct words, and decode.

Blocks of texts are split into words, each block with a list of its distinct ones.  The lists of all
blocks are dealt out by word, so that each distinct word of the corpus is encoded once; its ids
then go back to the blocks that have it, where they are joined to the words' places.  Texts travel
as places in the block's list, packed.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from venuekit.llm.cluster import ship

#: Code points of text in a block, and in a packed part of one.
BLOCK, PART = 1 << 25, 1 << 20
#: Parts that each block's list of distinct words is dealt out in.
BUCKETS = 2048
#: Texts of these characters only are split here; others by the library, for its own Unicode tables.
_PLAIN = regex.compile(r"[\t\n\r\x20-\x7E¡-©«-±´¶-¸»¿-ɏ]*+")


@cache
def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Tokenizer:
    """A tokenizer file whose normaliser is NFC, white space and lower case, and whose merges stay within words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        self.library = tokenizers.Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        split, byte_level = found["pre_tokenizer"]["pretokenizers"]
        names = [n["type"] for n in found["normalizer"]["normalizers"]]
        flags = any(t[k] for t in found["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        expected = names == ["NFC", "Replace", "Lowercase"] and split["behavior"] == "Removed" and split["invert"]
        if not expected or byte_level["type"] != "ByteLevel" or byte_level["use_regex"] or found["decoder"] or flags:
            raise ValueError(f"{path} is not a tokenizer of this kind")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.mark = regex.compile("|".join(regex.escape(s) for s in self.special) or r"(?!)")
        self.back = {c: b for b, c in byte_letters().items()}

    def plain_words(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return self.word.findall(unicodedata.normalize("NFC", text).lower())
        line = self.library.normalizer.normalize_str(text)
        return [bytes(self.back[c] for c in w).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(line)]

    def words(self, text: str | None) -> list[str]:
        """The words that merges stay within; special strings are words of their own."""
        if not text:
            return []
        if not any(s in text for s in self.special):
            return self.plain_words(text)
        found, at = [], 0
        for m in self.mark.finditer(text):
            found += [*self.plain_words(text[at : m.start()]), m[0]]
            at = m.end()
        return found + self.plain_words(text[at:])

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        letters = byte_letters()
        return [t.id for t in self.library.model.tokenize("".join(letters[b] for b in word.encode()))]

    def pieces(self) -> list[tuple[int, str]]:
        return [(i, w) for w, i in self.library.get_vocab(with_added_tokens=True).items()]


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def _planes(values: np.ndarray) -> bytes:
    """Numbers from 0, their bytes apart by significance, as the high ones are mostly zero."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _pack(*parts: bytes) -> bytes:
    sizes = np.array([len(parts), *map(len, parts)], "<u4").tobytes()
    data = b"".join(parts)
    return sizes + (pa.compress(data, "zstd", asbytes=True) if data else b"")


def _unpack(packed: bytes) -> list[bytes]:
    n = int.from_bytes(packed[:4], "little")
    sizes = np.frombuffer(packed, "<u4", n, 4).astype(np.int64)
    data = pa.decompress(packed[4 * n + 4 :], int(sizes.sum()), "zstd", asbytes=True) if sizes.any() else b""
    ends = np.cumsum(sizes).tolist()
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def _pack_texts(ids: list[pa.Array], places: list[np.ndarray]) -> bytes:
    """Ids and places of some texts."""
    table = pa.table({"id": pa.concat_arrays(ids)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    counts = np.array([len(p) for p in places])
    return _pack(sink.getvalue().to_pybytes(), _planes(counts), _planes(np.concatenate(places)))


#: Rows of words or their ids (kind 0) and of texts (kind 1).
_ROW = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("packed", pa.binary())])
_ROW_SQL = "bucket int, block long, kind int, packed binary"


def _row(bucket: int, block: int, kind: int, packed: bytes) -> pa.RecordBatch:
    return pa.record_batch([pa.array([v], f.type) for v, f in zip((bucket, block, kind, packed), _ROW)], schema=_ROW)


def _split(path: str):
    """Texts as places in their block's list of distinct words, and that list, cut by a hash of the word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        block, ids, places, size, part = TaskContext.get().partitionId() << 32, [], [], 0, 0
        packed: list[tuple[list[pa.Array], list[np.ndarray]]] = []
        table: dict[str, int] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            # frequent words come first, so that their places are small
            counts = np.zeros(len(table), np.int64)
            for _, found in packed:
                counts += np.bincount(np.concatenate(found), minlength=len(table))
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(table), np.int64)
            rank[order] = np.arange(len(table))
            for i, (texts, found) in enumerate(packed):
                yield _row(zlib.crc32(f"{block} {i}".encode()) % BUCKETS, block, 1, _pack_texts(texts, [rank[p] for p in found]))
            words = list(map(list(table).__getitem__, order.tolist()))
            bucket = np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in words), np.int64, len(words))
            by_bucket = np.argsort(bucket, kind="stable")  # ascending places in each
            cuts = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
            for own_places in np.split(by_bucket, cuts) if len(words) else []:
                line = "\n".join(map(words.__getitem__, own_places.tolist())).encode()  # no word holds white space
                yield _row(int(bucket[own_places[0]]), block, 0, _pack(_planes(np.diff(own_places, prepend=0)), line))

        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                found = own.words(text)
                places.append(np.fromiter((table.setdefault(w, len(table)) for w in found), np.int32, len(found)))
                ids.append(batch.column(0).slice(i, 1))
                part += len(text or "")
                if part >= PART:
                    packed.append((ids, places))
                    size, part, ids, places = size + part, 0, [], []
                if size >= BLOCK:
                    yield from rows()
                    packed, table, size, block = [], {}, 0, block + 1
        if ids:
            packed.append((ids, places))
        if packed:
            yield from rows()

    return work


def _encode(path: str):
    """Encode each distinct word once: a bucket's rows come together and hold all blocks that have its words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, known = tokenizer(path), None, {}
        for batch in batches:
            for bucket, block, kind, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    if bucket != last:
                        last, known = bucket, {}
                    places, line = _unpack(packed)
                    found = []
                    for word in line.decode().split("\n"):
                        if (ids := known.get(word)) is None:
                            ids = known[word] = own.ids(word)
                        found.append(ids)
                    sizes = np.fromiter(map(len, found), np.int64, len(found))
                    flat = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
                    packed = _pack(places, _planes(sizes), _planes(flat))
                yield _row(bucket, block, kind, packed)

    return work


def _assemble(path: str, id_field: T.StructField, id_type: pa.DataType, decode: bool):
    """Join the ids of a block's words to their places in its texts, and pieces to the ids; a block's words come before its texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = dict(tokenizer(path).pieces()) if decode else {}
        block, words, ready = None, [], None
        for batch in batches:
            for _, k, kind, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if k != block:
                    block, words, ready = k, [], None
                if kind == 0:
                    words.append([_numbers(x) for x in _unpack(packed)])
                    continue
                if ready is None:
                    ready = _table(words, piece if decode else None)
                    words = []
                ids, counts, places = _unpack(packed)
                texts = pa.ipc.open_stream(ids).read_all().column("id").combine_chunks().cast(id_type)
                yield from _texts(id_field.name, texts, _numbers(counts), _numbers(places), *ready)

    return work


def _table(words: list[list[np.ndarray]], piece: dict[int, str] | None):
    """Sizes, starts and ids of a block's words by place, and the joined pieces of each."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32), None if piece is None else []
    place = np.concatenate([np.cumsum(p, dtype=np.int64) for p, _, _ in words])
    sizes, ids = (np.concatenate([w[i] for w in words]).astype(np.int64) for i in (1, 2))
    order = np.argsort(place)
    begin = np.cumsum(sizes) - sizes
    sizes, begin = sizes[order], begin[order]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = ids[np.arange(starts[-1]) + np.repeat(begin - starts[:-1], sizes)].astype(np.int32)
    if piece is None:
        return sizes, starts, flat, None
    names = list(map(piece.__getitem__, flat.tolist()))
    bounds = starts.tolist()
    return sizes, starts, flat, [" ".join(names[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _texts(name, texts, counts, places, sizes, starts, flat, decoded) -> Iterator[pa.RecordBatch]:
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    n = sizes[places]
    offsets = np.concatenate([[0], np.cumsum(n)])
    # each place's ids, one place after the other
    ids = flat[np.arange(offsets[-1]) + np.repeat(starts[:-1][places] - offsets[:-1], n)]
    bounds = offsets[ends]
    for at in range(0, len(texts), 256):
        cut = slice(at, min(at + 256, len(texts)))
        low, high = bounds[cut.start], bounds[cut.stop]
        own = pa.ListArray.from_arrays(pa.array(bounds[cut.start : cut.stop + 1] - low, pa.int32()), pa.array(ids[low:high], pa.int32()))
        count = pa.array(np.diff(bounds[cut.start : cut.stop + 1]), pa.int64())
        columns, names = [texts.slice(at, cut.stop - at), count, own], [name, "n_tokens", "ids"]
        if decoded is not None:
            lines = [" ".join(map(decoded.__getitem__, places[a:b].tolist())) for a, b in zip(ends[cut.start : cut.stop], ends[cut.start + 1 : cut.stop + 1])]
            columns, names = [*columns, pa.array(lines, pa.string())], [*names, "decoded"]
        yield pa.RecordBatch.from_arrays(columns, names)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Per row of ``docs`` its id, ``n_tokens`` and ``ids``; with ``decoded`` also the text that these stand for.

    ``path`` is the tokenizer's file, the same on every machine.  No special tokens are added; special
    strings in a text become their ids.  Null and empty texts have no ids and decode to an empty text.  Rows with
    equal or null ids stay apart.  Other columns are not read.
    """
    ship(docs.sparkSession)
    split = docs.select(id_col, text_col).mapInArrow(_split(path), _ROW_SQL)
    encoded = split.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_encode(path), _ROW_SQL)
    by_block = encoded.repartition("block").sortWithinPartitions("block", "kind")
    field = docs.schema[id_col]
    fields = [field, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*fields, *([T.StructField("decoded", T.StringType())] if decoded else [])])
    return by_block.mapInArrow(_assemble(path, field, to_arrow_type(field.dataType), decoded), schema)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The vocabulary as ``id`` and ``piece``."""
    return spark.createDataFrame(sorted(tokenizer(path).pieces()), "id int, piece string")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row its id and ``decoded``, by a join of ids and pieces; an id without a piece is left out.

    Rows with null or empty ids decode to an empty text; rows of equal ``id_col`` and ids are one.
    """
    ids = F.coalesce(ids_col, F.array().cast("array<int>"))
    # a digest stands for the ids, so that no row of one id carries them all
    rows = encoded.select(F.col(id_col), ids.alias("ids")).withColumn("key", F.md5(F.array_join(F.col("ids").cast("array<string>"), " ")))
    placed = rows.dropDuplicates([id_col, "key"]).select(id_col, "key", F.posexplode_outer("ids").alias("place", "id"))
    joined = placed.join(pieces(encoded.sparkSession, path), "id", "left")
    listed = joined.groupBy(id_col, "key").agg(F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("place", "piece")))).alias("found"))
    return listed.select(id_col, F.array_join("found.piece", " ").alias("decoded"))
