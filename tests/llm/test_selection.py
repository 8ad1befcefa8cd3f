"""Drawing, mining and judging: resampling by a target, hard negatives, tokeniser fertility."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from venuekit.llm import fertility, negatives, queries, resample


# --- resampling
def plain_features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_draw(docs, targets):
    corpus, wanted = Counter(), Counter()
    features = [plain_features(t) for _, t in docs]
    for _, own in features:
        corpus.update(own)
    for t in targets:
        wanted.update(plain_features(t)[1])
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10000) / ((corpus[b] + 1) * (t + 10000)))) for b in range(10000)]
    rows = []
    for (i, _), (words, own) in zip(docs, features):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    for place, r in enumerate(fit[: 5 * len(fit) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_draw_equals_brute_force(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    found = queries.op11_batch_resampling(spark, small)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain_draw([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in items.collect()])
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert sum(r[4] is not None for r in want) > 5


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_runs_do_not_hang_on_the_cut(monkeypatch, size):
    """Whatever is joined or parted, each text has its own runs and no others."""
    monkeypatch.setattr(resample, "BYTES", size)
    r = random.Random(1)
    texts = [None, "", "A b", "é日本 x'y-Z " * 3, "word " * 30, "x" * 100 + " y " + "z" * 33 + " " + "q" * 34]
    texts += ["".join(r.choice("ab cé\n.X9 ") for _ in range(r.randint(0, 300))) for _ in range(200)]
    found = [[] for _ in texts]
    for data, begins, rows, known in resample._pieces(texts):
        _, doc, runs = resample.run_buckets(data, begins)
        for last, bucket in runs:
            for place, b in zip(last.tolist(), bucket.tolist()):
                if place >= known:
                    found[rows[doc[place]]].append(b)
    assert [sorted(f) for f in found] == [sorted(plain_features(t)[1]) for t in texts]


def test_draw_of_odd_tables(spark, odd, empty):
    many = odd.select("doc_id", "text", F.lit(1).alias("weight"), F.lit("z").alias("rank"))
    more = many.unionAll(spark.range(100, 160).select(F.col("id"), F.lit("ten words of text " * 10), F.lit(1), F.lit("z")))
    target = spark.createDataFrame([("ten words",), (None,)], "text string")
    found = resample.resample(more, target)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rows = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()]
    assert sorted(rows, key=str) == plain_draw([(r.doc_id, r.text) for r in more.collect()], ["ten words", None])
    assert resample.resample(empty, target).count() == 0
    assert resample.resample(odd, target.limit(0)).count() == odd.count()
    renamed = resample.resample(odd.select(F.col("doc_id").alias("rank"), "text"), target, id_col="rank")
    assert renamed.columns[0] == "rank" and renamed.columns[-1] == "_rank"


# --- hard negatives
def plain_negatives(rows, is_anchor, positives=5, n=10, low=30, high=90):
    usable = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own = (label, [math.floor(256 * x) for x in v])
            usable[i] = min(usable.get(i, own), own)
    out = []
    for a, (label, v) in usable.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, (other, w) in usable.items() if i != a)
        for minus, p, _ in [s for s in scored if s[2]][:positives]:
            hits = [(i, -m) for m, i, same in scored if not same and low * -minus <= 100 * -m <= high * -minus][:n]
            out += [(a, p, k, i, -minus, score) for k, (i, score) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 8192, 128), (7, 50, 3)])
def test_negatives_equal_brute_force(spark, monkeypatch, blocks):
    for name, size in zip(("ANCHORS", "ROWS", "SLICE"), blocks):
        monkeypatch.setattr(negatives, name, size)
    r = random.Random(3)
    near = [[r.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, r.choice([0, 1, 2]), [round(x + r.gauss(0, 0.4), 1) for x in near[r.randrange(4)]]) for i in range(300)]
    rows += [(300 + i, i % 3, [0.5] * 8) for i in range(60)]  # many ties
    rows += [(i + 400, 1, v) for i, v in enumerate([None, [], [None] * 8, [float("nan")] * 8, [float("inf")] * 8, [1.0] * 5])]
    rows += [(410, None, [1.0] * 8), (None, 1, [1.0] * 8), (0, 2, [1.0] * 8), rows[20], rows[20], (420, 9, [3.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("slot", F.lit("z")).withColumn("anchor_id", F.lit(1))
    found = negatives.hard_negatives(table, F.col("vec_id") % 10 == 0)
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 500
    assert negatives.hard_negatives(table.limit(0), F.lit(True)).count() == 0
    assert negatives.hard_negatives(table, F.lit(False)).count() == 0


def test_very_large_components(spark):
    rows = [(0, 0, [1e150, 1.0]), (1, 0, [1e150, 1.0]), (2, 1, [1e-130, 0.5]), (3, 1, [1e200, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = negatives.hard_negatives(table, F.col("vec_id") == 0)
    assert all(r.positive_id == 1 and r.positive_score == negatives._MOST for r in found.collect())


def test_slots_keep_the_best():
    scores = np.array([[5, 3, 5, 5, 1], [2, 2, 2, 2, 2]])
    valid = np.array([[True, True, True, True, True], [False, True, False, True, True]])
    i, j = negatives.best(scores, valid, 2)
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 2), (1, 1), (1, 3)]


# --- fertility
def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = defaultdict(list)
    for i in range(len(words) - 2):
        runs[tuple(words[i : i + 3])].append(i)
    repeated = {i + k for places in runs.values() if len(places) > 1 for i in places for k in range(3)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            doubled += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(repeated), failed


@pytest.mark.parametrize("size", [20, 1000, 1 << 22])
def test_base_counts_equal_a_plain_version(monkeypatch, size):
    monkeypatch.setattr(fertility, "BYTES", size)
    r = random.Random(6)
    texts = [None, "", "a", "a b c a b c a", "x\n\nx\n x\nx\r\nx", "a\x0bb\x0c c d|#"] + ["".join(r.choice(["a", "b ", " ", "\n", "é", "$", "日"]) for _ in range(r.randint(0, 200))) for _ in range(150)]
    paths = [public_tokenizers.path(n) for n in queries.MEASURED]
    tally = fertility._Tally(texts, paths)
    assert [tuple(c) for c in tally.base.T.tolist()] == [plain_base(t)[:5] for t in texts]
    bytes_, pieces = tokenizers.Tokenizer.from_file(public_tokenizers.path(queries.BYTE_BPE)), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    bytes_.encode_special_tokens = True
    for k, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lists = [[i for w in words for i in bytes_.encode(f" {w}", add_special_tokens=False).ids], [i for w in words for i in pieces.encode(w)]]
        for b, ids in enumerate(lists):
            counts = np.array(list(Counter(ids).values()))
            assert tally.n[b, k] == len(ids) and np.isclose(tally.spread[b, k], (counts * np.log2(counts)).sum())
        assert tally.partial[1, k] == sum(pieces.is_byte(i) or pieces.is_unknown(i) for i in lists[1])


def test_verdicts_follow_the_bands(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = queries.op13_token_fertility(spark, small).toPandas().set_index("doc_id")
    plain = {r.doc_id: plain_base(r.text) for r in docs.collect()}
    base = found[[*fertility.BASE, "base_failed"]]
    assert {i: tuple(r) for i, r in zip(base.index, base.itertuples(index=False))} == plain
    ok = found[~found.base_failed]
    step = lambda s: np.floor(s * 1000)
    for name, (least, side) in fertility.MEASURES.items():
        for band, own in [*ok.groupby("band")]:
            pool = own if len(own) >= fertility.LEAST_DOCUMENTS else ok
            values = np.sort(step(pool[name]).to_numpy())
            q1, q3 = (values[-(-len(values) * k // 4) - 1] / 1000 for k in (1, 3))
            reach = max(q3 - q1, least) * fertility.REACH
            outside = (own[name] > q3 + reach) | ((own[name] < q1 - reach) if side == "both" else False)
            assert (outside == own["outside"].map(lambda o: name in o)).all()
    assert (found.kept == (~found.base_failed & (found["outside"].map(len) == 0))).all()
    assert found[~found.base_failed].kept.mean() > 0.9


def test_junk_is_rejected(spark):
    r = random.Random(2)
    words = "the market opened with a small rise as traders looked for signs of growth in the coming year and many people said".split()
    rows = [(i, " ".join(r.choices(words, k=120)), "en") for i in range(200)]
    rows += [(900, " ".join("".join(r.choices("qxzvk$%&#", k=9)) for _ in range(120)), "en"), (901, " ".join("".join(map(chr, r.choices(range(0x1400, 0x1600), k=5))) for _ in range(100)), "en")]
    found = {x.doc_id: x for x in fertility.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), [public_tokenizers.path(n) for n in queries.MEASURED]).collect()}
    assert all(found[i].kept for i in range(200))
    assert "chars_per_token" in found[900].outside and "byte_share" in found[901].outside


def test_fertility_of_odd_tables(spark, odd, empty):
    paths = [public_tokenizers.path(n) for n in queries.MEASURED]
    found = fertility.judge(odd.withColumn("kept", F.lit("z")), paths)
    assert found.count() == odd.count() and found.where("kept").count() == 0
    assert {r.band for r in found.where("n_words = 0").collect()} <= {None, "en"}
    assert fertility.judge(empty, paths, lang_col=None).count() == 0
    assert fertility.judge(odd.select(F.col("doc_id").alias("kept"), "text"), paths, id_col="kept", lang_col=None).columns[-1] == "_kept"


def test_scripts():
    assert [fertility.script(t) for t in ("abc é", "да нет a", "12 .", "", "日本", "ひらがな", "한국어", "אב")] == ["Latin", "Cyrillic", None, None, "Han", "Kana", "Hangul", "Hebrew"]
