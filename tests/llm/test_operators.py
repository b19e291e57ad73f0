"""The operators on odd rows, empty tables and clashing columns, and against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import lru_cache
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from conftest import DATA
from odd_rows import none, odd, stored  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dealtide.llm import (
    byte_bpe,
    language_id,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    topk,
    toxicity,
    url_filter,
)
from dealtide.llm.common import connected_components
from dealtide.llm.textstats import repeated_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str(DATA / "sf0.001")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# 1 packing


@lru_cache
def tokenizer():
    return Tokenizer.from_file(WORDS)


def reference_ids(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 1]


def test_packing_holds_each_id_once(stored):
    found = packing.pack(stored.withColumn("length", F.lit(1)), WORDS, with_ids=True).collect()
    wanted = sorted(tuple(reference_ids(t)) for _, t in texts(stored))
    pieces = defaultdict(list)
    for r in found:
        assert r.ids_crc32 == crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
        pieces[r.doc_id, r.doc_tokens, tuple(r.ids[:0])].append(r)
    assert sum(r.length for r in found) == sum(map(len, wanted))
    whole = {r.doc_id: r for r in found if r.start == 0 and r.length == r.doc_tokens}
    for i, t in texts(stored):
        if i in whole and i != 7:
            assert whole[i].ids == reference_ids(t)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
    assert set(sequences) == set(range(len(sequences)))
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
        assert sum(r.length for r in rows) <= 2048


def test_packing_of_nothing(none):
    assert packing.pack(none, WORDS).count() == 0


def test_cutting_stock_covers_the_histogram():
    demand = {size: int(n) for size, n in enumerate(np.random.default_rng(1).integers(1, 40, 40), 1)}
    dealt = dict.fromkeys(demand, 0)
    rows = packing.plan(demand, 64)
    for size, first, per, _, times in rows:
        assert first == dealt[size]
        dealt[size] += per * times
    assert dealt == demand
    assert max(s + t for *_, s, t in rows) <= 1.03 * sum(size * n for size, n in demand.items()) / 64 + 1


@pytest.mark.parametrize("low, high", [(2, 7), (5, 31), (20, 201), (2, 901)])
def test_short_documents_are_packed_tightly(low, high):
    sizes = np.random.default_rng(low).integers(low, high, 50_000).tolist()
    unit = packing.grains(Counter(sizes))
    rounded = Counter(s + -s % unit[packing.octave(s)] for s in sizes)
    sequences = max(s + t for *_, s, t in packing.plan(rounded, 2048))
    assert sum(sizes) > 0.97 * 2048 * (sequences - 1)


def test_many_short_documents_fill_their_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 100)
    documents = spark.range(6000).selectExpr("id AS doc_id", "concat('a b', if(id % 3 = 0, ' c', '')) AS text")
    found = packing.pack(documents, WORDS).toPandas()
    assert found.length.sum() == 6000 * 3 + 2000 and found.sequence_id.max() + 1 <= 11
    for _, rows in found.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 2048


def test_ids_are_those_of_the_tokenizer():
    signs = [*"abcXYZéÉßÿþ ÷×µªº'st re\n\t\x0b\x1c\u00a0\u3000.,!?*_0129-<|>\u0301日ſKİक़", "<|endoftext|>", "'S", " 's", "don't"]
    draw = random.Random(3)
    found = ["".join(draw.choices(signs, k=draw.randint(0, 30))) for _ in range(5000)]
    for text, ids in zip(found, packing.Encoder(WORDS).ids([t.encode() for t in found]), strict=True):
        assert ids.tolist() == reference_ids(text), text


def test_packing_leaves_little_padding(spark):
    lengths = packing.query(spark, str(DATA / "sf0.01")).agg(F.sum("length"), F.max("sequence_id")).first()
    assert lengths[0] > 0.97 * 2048 * (lengths[1] + 1)


# 2 SimHash


def brute_groups(rows, radius=4):
    prints = []
    for _, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
        bits = [(1 << b) for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes)]
        prints.append(sum(bits))
    least = [i for i, _ in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    found = {}
    for k in range(len(rows)):
        if least[k] is not None:
            found[label[k]] = min(found.get(label[k], 1 << 60), least[k])
    return sorted((str(i), f"{p:016x}", found.get(x)) for (i, _), p, x in zip(rows, prints, label, strict=True))


def test_simhash_of_odd_rows(stored):
    found = simhash.near_groups(stored.withColumn("fingerprint", F.lit("x")))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found.collect()) == brute_groups(texts(stored))


def test_simhash_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    found = simhash.query(spark, SMALL).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found) == brute_groups(rows)


@pytest.mark.parametrize("radius", [4, 9])
def test_vantage_point_shards_lose_no_link(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(300)]
    near = [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 2))) for p in base for _ in range(3)]
    points = sorted({*base, *near})
    signed = [(p - (1 << 64) if p >= 1 << 63 else p,) for p in points]
    df = spark.createDataFrame(signed, "_print long")
    roots = {r.node % 2**64: r.root for r in connected_components(simhash.linked(df, radius, shard=64)).collect()}
    by_point = [roots.get(p, signed[n][0]) for n, p in enumerate(points)]
    values = np.array(points, np.uint64)
    links = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= radius)
    assert all(by_point[a] == by_point[b] for a, b in links)
    assert len(set(by_point)) > 200


def test_simhash_grid_of_a_large_shard(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    df = spark.createDataFrame([(1 << b,) for b in range(60)], "_print long")
    assert connected_components(simhash.linked(df, 4)).select("root").distinct().count() == 1


def test_near_copies_keep_one(spark, tmp_path):
    words = [f"word{i}" for i in range(200)]
    changed = [*words[:100], "other", *words[101:]]
    rows = [(5, " ".join(words)), (2, " ".join(changed)), (9, " ".join(words)), (3, "entirely different text of some words"), (4, None), (6, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    kept = simhash.keep_one(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4] and kept.columns == ["doc_id", "text"]


def test_just_similar_pairs_are_found_by_some_family(spark, tmp_path):
    # 60 pairs with a Jaccard similarity of 0.81 to 0.83 of their five-word shingles, and 60 of 0.75 to 0.78
    rng, rows = random.Random(8), []
    for pair in range(120):
        words = [f"w{rng.getrandbits(40)}" for _ in range(204)]
        changed = list(words)
        for at in range(10, 10 + 40 * (4 if pair < 60 else 5), 40):
            changed[at] = "changed"
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(changed))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    kept = {r.doc_id for r in simhash.keep_one(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert all(2 * pair in kept for pair in range(120))
    assert all(2 * pair + 1 in kept for pair in range(60, 120))
    assert sum(2 * pair + 1 in kept for pair in range(60)) <= 2


def test_equal_prints_of_different_texts_are_no_copies(spark, tmp_path):
    rng, seen, pair = random.Random(3), {}, None
    base = [f"w{i}" for i in range(204)]
    for n in range(6000):
        words = list(base)
        for at in rng.sample(range(10, 194), 3):
            words[at] = f"x{n}"
        text = " ".join(words)
        own = set(simhash.distinct_shingles(text.encode(), 5).tolist())
        other = seen.setdefault(int(simhash.prints_of([np.array(sorted(own), "<u8")], 1)[0]), (text, own))
        if len(own & other[1]) < 0.79 * len(own | other[1]):
            pair = other[0], text
            break
    spark.createDataFrame([(1, pair[0]), (2, pair[1]), (3, pair[1])], "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    kept = simhash.keep_one(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_pairs_that_closer_prints_connect_are_tested_too(spark):
    # x and y are similar, but z, which is similar to neither, lies between them in each family
    rows = [(1, [0, 0]), (2, [0b1111, 0b1111]), (3, [0b0011, 0b0011]), (4, [0b0011, 1 << 40])]
    points = spark.createDataFrame(rows, "_print long, _prints array<bigint>")
    none = spark.createDataFrame([], "node long, root long")
    pairs = {(r.a, r.b) for r in simhash.remaining(points, none, 4, 2).collect()}
    assert pairs == {(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)}
    some = spark.createDataFrame([(2, 2), (3, 2)], "node long, root long")
    assert {(r.a, r.b) for r in simhash.remaining(points, some, 4, 2).collect()} == {(1, 2), (1, 3), (1, 4), (2, 4), (3, 4)}


def test_template_group_loses_no_similar_pair(spark, tmp_path):
    # 60 pairs of 0.84 among texts of one template with a similarity of 0.71
    rng, rows = random.Random(5), []
    base = [f"w{i}" for i in range(304)]
    for n in range(600):
        words = list(base)
        places = rng.sample(range(4, 300, 6), 10)
        for at in places[:5]:
            words[at] = f"x{n}"
        rows.append((n, " ".join(words)))
        if n < 60:
            for at in places[5:]:
                words[at] = f"y{n}"
            rows.append((1000 + n, " ".join(words)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = {r.doc_id: r.component_id for r in simhash.near_groups(df, "doc_id", 5, 9, 0.8, 5).collect()}
    assert sum(found[n] == found[1000 + n] for n in range(60)) >= 59
    assert all(found[n] == n for n in range(60))


def test_families_of_fingerprints():
    text = b"one two three four five six seven eight nine ten"
    own = simhash.fingerprints(text, 2, families=3)
    assert own[0] == simhash.fingerprints(text, 2)[0] and len(set(own.tolist())) == 3
    assert simhash.fingerprints(b" ", 2, families=3).tolist() == [0, 0, 0]


def test_simhash_of_nothing(none):
    assert simhash.near_groups(none).count() == 0
    assert simhash.keep_one(none).count() == 0


# 3 URL filter


def test_url_filter_rules_and_list(spark):
    urls = [None, "no scheme", "http://A.Example.NET/en/x?q#f", "https://example.net/de/", "http://foo.net", "x://org/fr/1",
            "http://example.com/de/1", "http://www.bad.org/p/", "http://bad.org/p.html?x", "http://bad.org/q", "http://bad.org/q"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    listed = spark.createDataFrame([("bad.org/p",), ("bad.org/p",), (None,)], "canonical string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, listed).collect()}
    assert found == {
        0: ("", "", None, "allow"),
        1: ("", "", None, "allow"),
        2: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        3: ("example.net", "/de/", "net/", "block"),
        4: ("foo.net", "", None, "allow"),
        5: ("org", "/fr/1", "org/fr/", "allow"),
        6: ("example.com", "/de/1", "example.com/de/", "block"),
        7: ("www.bad.org", "/p/", None, "block"),
        8: ("bad.org", "/p.html", None, "block"),
        9: ("bad.org", "/q", None, "allow"),
        10: ("bad.org", "/q", None, "allow"),
    }
    assert url_filter.filter_urls(pages.limit(0), listed).count() == 0
    assert url_filter.filter_urls(pages, listed.limit(0)).where("verdict = 'block'").count() == 2


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS k")
    rows, blocks = url_filter.bloom(keys, "k", 5000)
    assert url_filter.maybe_listed(keys, "k", rows, blocks).where("NOT _maybe").count() == 0
    others = spark.range(5000, 25000).selectExpr("concat('k', id) AS k")
    assert url_filter.maybe_listed(others, "k", rows, blocks).where("_maybe").count() < 400


@pytest.mark.parametrize("module", [url_filter, topk])
def test_against_sql(spark, module):
    connection = duckdb.connect()
    for name in ("pages", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    df = module.query(spark, SMALL)
    wanted = connection.execute(f"SELECT {', '.join(df.columns)} FROM ({module.SQL})").fetchall()
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in df.collect())


# 4 language, 8 quality, 10 toxicity


def test_language_on_held_out_rows(spark):
    folder = str(DATA / "sf0.01")
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    found = language_id.query(spark, folder).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == len(truth) and len(held) > 200
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) > 0.97 * len(held)


def test_language_of_odd_rows(stored, none):
    model = language_id.train(stored.where("doc_id IS NOT NULL"))
    for model in (model, language_id.train(none)):
        found = language_id.identify(stored.withColumn("score", F.lit("x")), model)
        for r in found.collect():
            assert 0 <= r.score <= 1
            assert r.text and re.search(r"\w", r.text) or r.lang_pred == "und"
        assert found.count() == stored.count()
    assert language_id.identify(none, model).count() == 0


def test_presence_of_slices(monkeypatch):
    text = ("einige wörter und mehr " * 50).encode()
    whole, sliced = np.zeros(language_id.BUCKETS), np.zeros(language_id.BUCKETS)
    language_id.presence(whole, text)
    monkeypatch.setattr(language_id, "_SLICE", 17)
    language_id.presence(sliced, text)
    assert (whole == sliced).all()


def test_quality_on_held_out_rows(spark):
    folder = str(DATA / "sf0.1")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall())
    held = [r for r in quality_classifier.query(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert sum(labels[r.doc_id] == r.predicted for r in held) > 0.97 * len(held)


def test_toxicity_on_held_out_rows(spark):
    folder = str(DATA / "sf0.1")
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    held = [r for r in toxicity.query(spark, folder).collect() if r.held_out and r.doc_id in labels]
    toxic = [r.predicted for r in held if labels[r.doc_id] == 1]
    clean = [r.predicted for r in held if labels[r.doc_id] == 0]
    assert sum(toxic) > 0.75 * len(toxic) and sum(clean) < 0.02 * len(clean)


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{j}" for j in rng.integers(0, 300, 30)) + (" vile" if i % 9 == 0 and i % 7 else ""), int(i % 9 == 0)) for i in range(1500)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    seen = []
    begun = toxicity.Fit.begun
    monkeypatch.setattr(toxicity.Fit, "begun", staticmethod(lambda held, sizes, rng: seen.append((held, sizes)) or begun(held, sizes, rng)))
    languages = language_id.train(docs.limit(0).withColumn("lang", F.lit("x")))
    network = toxicity.train(docs, labels, languages, shard_rows=100)  # seven shards, whose weights are averaged
    known = [r for r in rows if crc32(str(r[0]).encode()) % 3 != 1]
    words = [toxicity.hashed_words(t.encode(), {}) for _, t, _ in known]
    y = np.array([r[2] for r in known], float)
    fits = np.array([crc32(f"fit{r[0]}".encode()) % 4 > 0 for r in known])
    # counts of all rows
    assert seen[0][1].tolist() == [(y[fits] == 0).sum(), (y[fits] == 1).sum()]
    assert (seen[0][0] == toxicity.held_buckets([w for w, f in zip(words, fits, strict=True) if f], y[fits])).all()
    # the threshold of all rows that fit no weights, by trying all
    raw, y = network.raw([w for w, f in zip(words, fits, strict=True) if not f]), y[~fits]
    best = max(2 * y[raw >= c].sum() / ((raw >= c).sum() + y.sum()) for c in raw)
    assert abs(2 * y[raw >= network.cuts[""]].sum() / ((raw >= network.cuts[""]).sum() + y.sum()) - best) < 1e-9
    assert best > 0.8


def test_classifiers_on_odd_rows(spark, stored, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (4, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    clash = stored.withColumn("predicted", F.lit("x"))
    for known in (labels, labels.limit(0)):
        trees = quality_classifier.train(stored, known)
        found = quality_classifier.score(clash, trees).collect()
        assert len(found) == 12 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
        languages = language_id.train(none)
        network = toxicity.train(stored, known, languages)
        found = toxicity.score(clash, network, languages).collect()
        assert len(found) == 12 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
    assert quality_classifier.score(none, trees).count() == 0 and toxicity.score(none, network, languages).count() == 0


def test_trees_walk_as_their_nodes_say():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality_classifier.fit_trees(x, y, trees=10)
    for row in x[:20]:
        total = trees.base
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > c[node])
            total += leaf[node - len(f)]
        assert np.isclose(trees.raw(row[None, :])[0], total)
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.9


def test_long_texts_pool_as_a_whole(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(1, toxicity.BUCKETS, (n, 2)).astype(np.int32) for n in (0, 1, 2, 50, 3)]
    network = toxicity.fit_network(texts, np.array([0, 1, 0, 1, 0.0]), rounds=1)
    whole = network.raw(texts)
    monkeypatch.setattr(toxicity, "_PART", 7)
    assert np.allclose(whole, network.raw(texts))


# 5 top-k


def brute_top(rows, every, k):
    found = []
    for i, q in rows:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in rows if j != i)[:k]
            found += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(found)


def test_topk_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-50, 50)) for _ in range(8)]) for i in range(600)]
    rows += [(i, [7.0] * 8) for i in range(600, 900)]  # a third are ties
    df = spark.createDataFrame([*rows, (None, [1.0] * 8), (1000, None)], "vec_id long, v array<double>").repartition(5)
    found = topk.search(df.withColumn("score", F.lit(1)), F.col("vec_id") % 20 == 0, k=7, block=64, query_block=16)
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == brute_top(rows, 20, 7)


def test_topk_of_few_and_none(spark):
    shape = "vec_id long, embedding array<float>"
    rows = [(0, [1.0, 2.0]), (1, [float("nan"), 1.0]), (2, None), (3, [None, 1.0]), (4, [0.5, 0.5]), (5, [float("inf"), 0.0]), (6, [])]
    df = spark.createDataFrame(rows, shape).where(topk.usable(F.col("embedding")))
    vectors = df.select("vec_id", topk.integral(F.col("embedding")).alias("v"))
    found = topk.search(vectors, F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found] == [(0, 1, 4, 1024 * 512 + 2048 * 512), (0, 2, 6, 0)]
    assert topk.search(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# 6 byte BPE


def test_byte_bpe_round_trip(stored):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = byte_bpe.decode(byte_bpe.encode(stored.withColumn("ids", F.lit(1)), BYTES), BYTES).collect()
    # one run of a letter takes the plain encoder long, so that row is compared by its bytes alone
    wanted = sorted((str(i), coder.encode_ordinary(t or "")) for i, t in texts(stored) if i != 10)
    assert sorted((str(r.doc_id), list(r.ids)) for r in found if r.doc_id != 10) == wanted
    decoded = sorted((str(r.doc_id), hashlib.sha256(bytes(r.decoded)).digest()) for r in found)
    assert decoded == sorted((str(i), hashlib.sha256((t or "").encode()).digest()) for i, t in texts(stored))


def test_byte_bpe_of_nothing(none):
    assert byte_bpe.decode(byte_bpe.encode(none, BYTES), BYTES).count() == 0


def test_chunks_part_no_word(monkeypatch):
    monkeypatch.setattr(byte_bpe, "_SLICE", 5)
    rng = random.Random(4)
    signs = [" ", "  ", "\n", "\t", "\u2003", "\x1c", "a", "b", "'s", "'", "1", "é", ".", "!!", "x y", "\r\n", " \n "]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))
        block = byte_bpe.Block()
        places = block.places(text)
        words = list(block.words)
        assert [words[i] for i in places] == byte_bpe._SPLIT.findall(text), repr(text)


# 7 quality rules


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


def test_base_counts(spark, stored):
    field = quality_rules.train(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    for df in (stored.where("doc_id <> 9").withColumn("kept", F.lit("x")), spark.read.parquet(f"{SMALL}/documents.parquet")):
        for r in quality_rules.judge(df, field).collect():
            counts = brute_counts(r.text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
            assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
            assert not (r.kept and r.base_failed) and r.kept == (not r.base_failed and r.content_share >= 0.5)


def test_repeated_words_of_long_text():
    assert repeated_words([b"a"] * 9) == 9 and repeated_words([b"a"] * 8) == 0
    assert repeated_words([b"%d" % (i % 1000) for i in range(3000)]) == 3000


def test_rules_without_labels_or_rows(spark, none):
    field = quality_rules.train(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality_rules.judge(none, field).count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(6)
    field = quality_rules.Field(rng.normal(size=quality_rules.N_FEATURES), rng.normal(size=(2, 2)))
    documents = [rng.normal(size=(n, quality_rules.N_FEATURES)).tolist() for n in (4, 0, 1, 6)]

    def worth(lines, path):
        gain = sum(s * float(np.dot(x, field.weights)) for x, s in zip(lines, path, strict=True))
        return gain + sum(field.steps[a, b] for a, b in zip(path, path[1:], strict=False))

    for lines, path in zip(documents, field.content(documents), strict=True):
        best = max(worth(lines, [k >> i & 1 for i in range(len(lines))]) for k in range(2 ** len(lines)))
        assert np.isclose(worth(lines, list(map(int, path))), best)


# 9 line dedup


def brute_lines(rows, least):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    sequences = []
    for i in order:
        lines = (rows[i][1] or "").split("\n")
        sequences.append([(n, line, len(WORD.findall(line))) for n, line in enumerate(lines) if WORD.search(line)])
    runs = []
    for r, lines in enumerate(sequences):
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(x[2] for x in lines[a : b + 1]) >= least:
                    runs.append((tuple(x[1] for x in lines[a : b + 1]), r, a))
                    break
            for b in range(a, -1, -1):
                if sum(x[2] for x in lines[b : a + 1]) >= least:
                    runs.append((tuple(x[1] for x in lines[b : a + 1]), r, b))
                    break
    first = {}
    for run, r, a in runs:
        first[run] = min(first.get(run, (r, a)), (r, a))
    gone = defaultdict(set)
    for run, r, a in runs:
        if first[run][0] != r or first[run][1] + len(run) <= a:
            gone[r] |= {x[0] for x in sequences[r][a : a + len(run)]}
    found = []
    for r, i in enumerate(order):
        key, text = rows[i]
        kept = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[r])
        found.append((str(key), str(kept)))
    return sorted(found)


def test_line_dedup_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    passage = ["one two three four", "five six", "", "seven eight nine ten"]
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 3))) for _ in range(rng.randint(0, 8))]
        at = rng.randint(0, len(lines))
        rows.append((i, "\n".join([*lines[:at], *(passage if i % 3 else []), *lines[at:]])))
    rows += [(60, None), (61, ""), (None, "\n".join(passage)), (62, "x y z\n" * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("n_lines", F.lit("x"))
    for least in (2, 5, 9):
        found = line_dedup.dedup_lines(df, min_words=least)
        assert sorted((str(r.doc_id), str(r.text)) for r in found.collect()) == brute_lines(rows, least)


def test_runs_of_sentences_inside_lines(spark, tmp_path):
    passage = " ".join(" ".join(f"p{i}x{j}" for j in range(10)) + "." for i in range(6))
    rows = [
        (1, f"Own words here. {passage} behind it."),
        (2, f"  other\nEnd of a line. {passage}\nlast \n"),
        (3, passage.replace(". ", ".\n")),
        (4, f"own\nbegin of p0x9. {passage} More.\n\nrest"),
        (5, f"{passage[passage.index('p0x5') :]} tail! x"),
        (6, "kept  as it is. "),
        (7, None),
        (8, passage[: passage.index("p2x0")]),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    found = line_dedup.dedup_lines(spark.read.parquet(str(tmp_path / "t")), min_words=25, cut=line_dedup.SENTENCE)
    assert {r.doc_id: (r.text, r.n_lines, r.n_deleted) for r in found.collect()} == {
        1: (rows[0][1], 1, 0),
        2: ("  other\nEnd of a line.\nlast \n", 4, 6),
        3: ("", 6, 6),
        4: ("own\nbegin of p0x9. More.\n\nrest", 4, 6),
        5: ("p0x5 p0x6 p0x7 p0x8 p0x9. tail! x", 1, 5),
        6: (rows[5][1], 1, 0),
        7: (None, 0, 0),
        8: (rows[7][1], 1, 0),
    }


def test_line_dedup_of_odd_rows(stored, none):
    for cut in (None, line_dedup.SENTENCE):
        found = line_dedup.dedup_lines(stored, cut=cut)
        assert found.columns == [*stored.columns, "n_lines", "n_deleted"] and found.count() == 12
        assert line_dedup.dedup_lines(none, cut=cut).count() == 0


def brute_passages(rows, least):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    words = [WORD.findall(rows[i][1] or "") for i in order]
    first, left = {}, []
    for r, w in enumerate(words):
        gone = set()
        for a in range(len(w) - least + 1):
            seen = first.setdefault(tuple(w[a : a + least]), (r, a))
            if seen[0] != r or seen[1] + least <= a:
                gone |= set(range(a, a + least))
        left.append((str(rows[order[r]][0]), [x for i, x in enumerate(w) if i not in gone]))
    return sorted(left)


def test_passages_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    passage = "one two three four five six\nseven eight nine ten".split(" ")
    rows = []
    for i in range(80):
        words = [rng.choice("abc") + rng.choice(["", "\n", "d"]) for _ in range(rng.randint(0, 25))]
        at = rng.randint(0, len(words))
        rows.append((i, " ".join([*words[:at], *(passage[rng.randint(0, 3) :] if i % 3 else []), *words[at:]])))
    rows += [(80, None), (81, ""), (None, " ".join(passage)), (82, "x y z\n" * 9), (7, rows[7][1])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("n_lines", F.lit("x"))
    for least in (2, 5, 9):
        found = line_dedup.dedup_passages(df, min_words=least).collect()
        assert sorted((str(r.doc_id), WORD.findall(r.text or "")) for r in found) == brute_passages(rows, least)
        assert all((r.text is None) == (r.doc_id == 80) for r in found)


def test_passage_inside_lines_is_cut(spark, tmp_path):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, f"before {passage} behind"),
        (2, f"  other\nstart {passage.replace('p30', chr(10) + 'p30')} end\nlast \n"),
        (3, passage),
        (4, f"own\n{passage}\nrest"),
        (5, f"{passage} tail\nx"),
        (6, "kept  as it is "),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    found = {r.doc_id: (r.text, r.n_lines, r.n_deleted) for r in line_dedup.dedup_passages(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert found == {
        1: (rows[0][1], 1, 0),
        2: ("  other\nstart\nend\nlast \n", 5, 0),
        3: ("", 1, 1),
        4: ("own\nrest", 3, 1),
        5: ("tail\nx", 2, 0),
        6: ("kept  as it is ", 1, 0),
    }


def test_passages_of_odd_rows(stored, none):
    found = line_dedup.dedup_passages(stored)
    assert found.columns == [*stored.columns, "n_lines", "n_deleted"] and found.count() == 12
    assert line_dedup.dedup_passages(none).count() == 0


def test_few_seeds_name_all_windows(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([([str(rng.random()) for _ in range(3000)],)], "words array<string>")
    runs = df.select(F.inline(line_dedup._seeded(F.col("words"), 50))).collect()
    assert [r["first"] for r in runs] == [sum(x["size"] for x in runs[:n]) for n in range(len(runs))]
    assert sum(r["size"] for r in runs) == 3000 - 49 and len(runs) < 3000 / 15
