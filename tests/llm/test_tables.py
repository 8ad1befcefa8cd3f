"""Operators across rows: shards, near copies, benchmark items, addresses, neighbours, the pipeline."""

import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from venuekit.llm import decontaminate, neighbours, queries, shards, simhash, url_rules


# --- shards
def check_shards(table, found):
    rows = found.groupBy(found.columns[-2]).agg(F.count("*").alias("n"), F.min(found.columns[-1]).alias("a"), F.max(found.columns[-1]).alias("b"), F.countDistinct(found.columns[-1]).alias("d")).collect()
    sizes = [r.n for r in rows]
    assert sum(sizes) == table.count() and max(sizes) - min(sizes) <= 1
    assert all((r.a, r.b, r.d) == (0, r.n - 1, r.n) for r in rows)


def test_shards_are_equal_and_gapless(documents, odd, empty):
    check_shards(documents, shards.equal_shards(documents, 8, bucket_bytes=20_000))
    found = shards.equal_shards(odd, 3, bucket_bytes=1000)
    assert found.columns == [*odd.columns, "_shard", "_slot"]
    check_shards(odd, found)
    assert found.select(odd.columns).exceptAll(odd).count() == 0
    assert shards.equal_shards(empty).count() == 0


def test_shards_repeat_and_mix(documents):
    first, again = (sorted(map(tuple, shards.equal_shards(documents.select("doc_id"), 4, text_col="doc_id", bucket_bytes=50).collect())) for _ in range(2))
    assert first == again and [r[0] for r in sorted(first, key=lambda r: r[2])] != sorted(r[0] for r in first)


def test_buckets_are_shuffled_evenly():
    import pyarrow as pa

    places = np.zeros((5, 5))
    for seed in range(2000):
        out = shards._fisher_yates("b", "p", "k", seed)(pa.table({"b": [0] * 5, "k": list(range(5)), "v": list(range(5))}))
        places[out.column("v").to_numpy(), np.arange(5)] += 1
    assert abs(places / 2000 - 0.2).max() < 0.04


def test_written_shards(documents, tmp_path):
    shards.write_shards(documents, str(tmp_path / "out"), 4)
    assert documents.sparkSession.read.parquet(str(tmp_path / "out")).drop("shard", "slot").exceptAll(documents).count() == 0


# --- near copies
def brute_components(values, ids, bits):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ v) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {ids[i]: ids[find(i)] for i in range(len(ids))}


def test_components_equal_brute_force(documents):
    found = simhash.near_copies(documents).orderBy("doc_id").collect()
    want = brute_components(np.array([int(r.fingerprint, 16) for r in found], np.uint64), [r.doc_id for r in found], 4)
    assert {r.doc_id: r.component_id for r in found} == want


def dense(n, bits, seed=4):
    """Values with few bits flipped from a handful of centres, many of them in reach of each other."""
    r = np.random.default_rng(seed)
    v = r.integers(0, 1 << 63, 5, dtype=np.uint64)[r.integers(0, 5, n)]
    for _ in range(bits):
        v = v ^ (np.uint64(1) << r.integers(0, 64, n, dtype=np.uint64))
    return np.unique(v)


@pytest.mark.parametrize("large", [8, 4096])
def test_index_equals_brute_force_in_dense_groups(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)
    values = dense(900, 5)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "value long")
    found = {r.node: r.root for r in simhash.components(spark, simhash.links(frame, 4)).collect()}
    want = brute_components(values, list(range(len(values))), 4)
    names = values.view(np.int64).tolist()
    ours = {v: found.get(v, v) for v in names}
    groups = lambda pairs: sorted(sorted(k for k, r in pairs.items() if r == root) for root in set(pairs.values()))
    assert groups(ours) == groups({names[k]: names[r] for k, r in want.items()})


@pytest.mark.parametrize("n, flips", [(1, 4), (40, 64), (3000, 13), (6000, 20), (6000, 48), (4000, 64)])
def test_groups_of_any_size_equal_brute_force(n, flips):
    r = np.random.default_rng(n + flips)
    values = np.full(n, r.integers(0, 1 << 63, dtype=np.uint64))
    for _ in range(6):
        values ^= np.uint64(1) << r.integers(0, flips, n, dtype=np.uint64)
    index = simhash.GrayIndex(np.unique(values))
    found, want = index.roots(4), np.full(len(index.values), -1)
    for i in range(len(want)):
        queue = [i] if want[i] < 0 else []
        want[queue] = i
        while queue:
            near = np.flatnonzero((want < 0) & (np.bitwise_count(index.values ^ index.values[queue.pop()]) <= 4))
            want[near] = i
            queue += near.tolist()
    assert (found == want).all()


def test_near_copy_edge_cases(odd, empty):
    found = simhash.near_copies(odd).collect()
    assert len(found) == odd.count()
    blank = [r for r in found if r.fingerprint == "0" * 16]
    assert len(blank) == 3 and {r.component_id for r in blank} == {0}
    assert simhash.near_copies(empty).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_a_plain_version():
    r = random.Random(4)
    texts = [None, "", " \n", "ÀB c", "one two three", "a b c d", "x " * 5000, "a\x0bb\x0cC\u00a0d e"]
    texts += ["".join(r.choice("aB é\n\t.日Z") for _ in range(r.randint(0, 400))) for _ in range(200)]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_one_of_each_set_stays(spark, documents, odd, empty):
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in simhash.near_copies(documents).collect()})
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [0, 4, 5, 6, 7]
    assert simhash.keep_one(empty).count() == 0
    nameless = spark.createDataFrame([(None, "some text", 1), (None, "some text", 1), (None, "some text", 2), (None, "other", 1)], "doc_id long, text string, copy_key int")
    assert sorted(r.text for r in simhash.keep_one(nameless).collect()) == ["other", "some text"]


# --- benchmark items
def test_items_equal_brute_force(spark, small, documents):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_items(documents, items).collect()}
    words = [(r.item_id, decontaminate.symbols([r.text])[0]) for r in items.collect()]
    want = set()
    for r in documents.collect():
        text = decontaminate.symbols([r.text])[0]
        for item, own in words:
            regions = [text[s : s + len(own) + decontaminate.allowed(len(own))] for s in np.flatnonzero(np.isin(text, own))]
            if regions and decontaminate.distances([own] * len(regions), regions).min() <= decontaminate.allowed(len(own)):
                want.add((r.doc_id, item))
    assert found == want and want


@pytest.mark.parametrize("share", [0.1, 0.2])
def test_edited_items_reach_the_target_recall(spark, small, share):
    """Words exchanged, left out and inserted, up to the most edits that are allowed."""
    r = random.Random(5)
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    rows = []
    for item in items.collect():
        for kind in ("exchange", "leave out", "insert"):
            words = item.text.split()
            for place in sorted(r.sample(range(len(words)), int(share * len(words))), reverse=True):
                words[place : place + (kind != "insert")] = ["edited"] * (kind != "leave out")
            rows.append((len(rows), item.item_id, "some words before " + " ".join(words) + " and some after"))
    docs = spark.createDataFrame(rows, "doc_id long, own long, text string")
    found = decontaminate.find_items(docs, items).join(docs.select("doc_id", "own"), "doc_id")
    assert found.where("own = item_id").count() >= 0.95 * len(rows)


def test_item_edge_cases(spark, odd, empty):
    items = spark.createDataFrame([(1, "same TEXT, of a few!"), (2, None), (3, "..."), (4, "wörd日本"), (None, "a")], "item_id long, text string")
    found = decontaminate.find_items(odd, items).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in found) == [("4", "1"), ("6", "4"), ("None", "1")]
    assert decontaminate.without_items(odd, items).columns == odd.columns and decontaminate.without_items(odd, items).count() == 5
    assert decontaminate.find_items(empty, items).count() == 0 and decontaminate.find_items(odd, items.limit(0)).count() == 0


# --- addresses
def test_addresses_equal_sql(spark, small, rows):
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from '{small}/pages.parquet'")
    want = duck.execute(queries.ORACLE["op6_url_rules"]).fetchall()
    assert rows(queries.op6_url_rules(spark, small)) == sorted(want, key=str)


def test_address_rules(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("A.net", "/d", "allow"), ("a.net", "", "block"), ("", "/", "block")], queries.RULES)
    urls = ["http://x.NET/", "http://net", "s://b.a.net/dev?x", "s://a.net", "http://fornet/", None, "no address", "://", "http://x.net/?/d://a.net/d"]
    pages = spark.createDataFrame([(u, "clash") for u in urls], "url string, rule string")
    found = {r.url: (r.host, r.path, r._rule, r.verdict) for r in url_rules.judge(pages, rules).collect()}
    assert found["http://x.NET/"] == ("x.net", "/", "net/", "block") and found["http://net"] == ("net", "", None, "allow")
    assert found["s://b.a.net/dev?x"][2:] == ("a.net/d", "allow") and found["s://a.net"][2:] == ("a.net", "block")
    assert found["http://fornet/"][3] == "allow" and found[None] == ("", "", None, "allow") == found["no address"] == found["://"]
    assert found["http://x.net/?/d://a.net/d"][:2] == ("x.net", "/")
    clash = url_rules.judge(pages, rules, default="allow")
    assert clash.columns == ["url", "rule", "host", "path", "_rule", "verdict"] and clash.where("rule = 'clash'").count() == len(urls)
    assert url_rules.judge(pages.limit(0), rules).count() == 0 and url_rules.judge(pages, rules.limit(0)).where("verdict = 'block'").count() == 0


def test_a_host_of_very_many_labels(spark):
    """Work goes by the rules' labels, not by those of the host."""
    rules = spark.createDataFrame([("net", "/", "block"), ("a.b.net", "/", "allow")], queries.RULES)
    host = "a." * 100_000
    pages = spark.createDataFrame([(f"s://{host}b.net/x",), (f"s://{host}c.net/x",), (f"s://{host}com/x",), ("s://" + "." * 50_000 + "net/",)], "url string")
    found = [(r.rule, r.verdict) for r in url_rules.judge(pages, rules).orderBy(F.length("url"), "url").collect()]
    assert found == [("net/", "block"), (None, "allow"), ("a.b.net/", "allow"), ("net/", "block")]


# --- neighbours
def test_neighbours_reach_the_recall(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    found = queries.op7_inverted_multi_index(spark, folder).toPandas()
    x, ids = np.array(table.embedding.tolist(), np.float64), table.vec_id.to_numpy()
    hits = total = 0
    for q, own in found.groupby("query_id"):
        at = int(np.flatnonzero(ids == q)[0])
        scores = x @ x[at]
        scores[at] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]])
        hits, total = hits + len(best & set(own.vec_id)), total + 20
        assert own["rank"].tolist() == list(range(1, 21)) or sorted(own["rank"]) == list(range(1, 21))
    assert len(found) == 20 * (ids % 20 == 0).sum() and hits >= 0.9 * total


def test_neighbour_edge_cases(spark):
    one, two, nan = [1.0, 0.0], [0.5, 0.5], float("nan")
    rows = [(0, one), (20, one), (40, two), (3, one), (5, two), (6, None), (7, [0.0, 0.0]), (8, [1.0, None]), (9, [nan, 1.0]), (None, one), (10, [1.0, 2.0, 3.0]), (11, [float("inf"), 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    found = sorted(map(tuple, neighbours.nearest(table).collect()))
    assert found[:4] == [(0, 1, 3, 1.0), (0, 2, 20, 1.0), (0, 3, 5, 0.5), (0, 4, 40, 0.5)]
    assert [r[:3] for r in found[4:8]] == [(20, 1, 0), (20, 2, 3), (20, 3, 5), (20, 4, 40)] and len(found) == 12
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_rows_of_one_id(spark):
    """Rows that share a query's id are candidates, and so is its repetition."""
    rows = [(20, [1.0, 0.0]), (20, [0.9, 0.0]), (3, [0.5, 0.0]), (40, [0.0, 1.0]), (40, [0.0, 1.0])]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    lists = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in found.collect())
    twenty = [(20, 1, 20, 0.9), (20, 1, 20, 0.9), (20, 2, 3, 0.45), (20, 2, 3, 0.5), (20, 3, 40, 0.0), (20, 3, 40, 0.0), (20, 4, 40, 0.0), (20, 4, 40, 0.0)]
    forty = [(40, 1, 40, 1.0), (40, 2, 3, 0.0), (40, 3, 20, 0.0), (40, 4, 20, 0.0)]
    assert lists == sorted(twenty + 2 * forty)


def test_many_equal_vectors(spark):
    table = spark.range(3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.sin("id"), F.cos("id"))).alias("embedding"))
    found = neighbours.nearest(table).where("query_id = 20").orderBy("rank").collect()
    assert [r.vec_id for r in found] == [i for i in range(40) if i % 3 > 0 and i != 20][:20]


# --- pipeline
def test_pipeline_takes_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, small)
        if name != "tokens":
            assert done.columns == docs.columns and done.dtypes == docs.dtypes
            assert 0.6 * docs.count() <= done.count() <= docs.count()
            docs = done.cache()
    assert docs.select("text").distinct().count() == docs.count()
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    assert decontaminate.find_items(docs, items).count() == 0
    rude = F.col("text").rlike("idiot|moron|scum|trash")
    assert docs.where(rude).count() < spark.read.parquet(f"{small}/documents.parquet").where(rude).count()
    assert done.count() == docs.count() and set(done.columns) == {"doc_id", "n_tokens", "ids"}


def test_pipeline_runs(spark, small):
    assert corpus_pipeline.run(spark, small).count() > 0


def test_pipeline_drops_near_copies_and_keeps_others(spark, small):
    r = random.Random(8)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 8))) for _ in range(2000)]
    own = [r.choices(words, k=r.randint(100, 400)) for _ in range(200)]
    passage = r.choices(words, k=60)
    own = [t[:50] + passage + t[50:] if i % 4 == 0 else t for i, t in enumerate(own)]
    copies = [[("exchanged" if r.random() < 0.005 else w) for w in t] for t in own]
    texts = [" ".join(t) for t in own + copies] + [" ".join(t).upper() for t in own[:50]]
    values = np.array([simhash.fingerprint(t) for t in texts], np.uint64)
    want = set(brute_components(values, list(range(len(texts))), 4).values())
    left = {x.doc_id for x in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), small).collect()}
    assert left == want and set(range(200)) <= left and len(left) < 400


def test_pipeline_on_odd_tables(spark, odd, empty, small):
    """Null, empty, very long and repeated texts, and names that clash, go through all stages in a row."""
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            done = stage(spark, docs, small)
            assert done.columns == docs.columns and done.dtypes == docs.dtypes
            docs = spark.createDataFrame(done.toArrow(), done.schema)
        ids = corpus_pipeline.encode(spark, docs, small)
        assert ids.count() == docs.count()
        if docs.columns == odd.columns and ids.count():
            assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == [0, 4, 5, 6, 7]


def test_pseudonym_key_is_the_sessions(spark):
    spark.conf.unset(corpus_pipeline.KEY_SETTING)
    first = corpus_pipeline.pseudonym_key(spark)
    assert len(first) == 64 and corpus_pipeline.pseudonym_key(spark) == first
    spark.conf.set(corpus_pipeline.KEY_SETTING, "mine")
    assert corpus_pipeline.pseudonym_key(spark) == "mine"
    spark.conf.unset(corpus_pipeline.KEY_SETTING)
