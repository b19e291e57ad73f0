"""Substring deduplication, conversation trie and vector codes against brute force, on odd rows and on empty tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
import xxhash
from odd_rows import none, odd, stored  # noqa: F401
from pyspark.sql import functions as F

from dealtide.llm import conversation_trie, line_dedup, simhash, substring_dedup, vector_codes
from dealtide.llm.fm_index import FMIndex

# 11 substring dedup


def test_matching_statistics_against_all_substrings():
    for seed in range(150):
        rng = random.Random(seed)
        letters = rng.choice([1, 2, 3, 9])
        pieces = [[rng.randint(1, letters) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 8))]
        weights = [rng.choice([1, 1, 2]) for _ in pieces]
        count = Counter()
        for piece, weight in zip(pieces, weights, strict=True):
            for i in range(len(piece)):
                for j in range(i + 1, len(piece) + 1):
                    count[tuple(piece[i:j])] += weight
        wanted = [
            max((j - i for j in range(i + 1, len(piece) + 1) if count[tuple(piece[i:j])] >= 2), default=0)
            for piece in pieces
            for i in range(len(piece))
        ]
        words, sizes = np.array([x for p in pieces for x in p]), np.array([len(p) for p in pieces])
        assert FMIndex(words, sizes, np.array(weights)).matching_statistics(words, sizes).tolist() == wanted


def brute_removed(texts, least):
    """Per text its words and which of them go."""
    words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + least]) for w in words for i in range(len(w) - least + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - least + 1):
            if count[tuple(w[i : i + least])] > 1:
                gone[i : i + least] = [True] * least
        out.append((w, gone))
    return out


def check_removed(found, texts, least):
    wanted = sorted((len(w), sum(g), b" ".join(x for x, go in zip(w, g, strict=True) if not go).decode()) for w, g in brute_removed(texts, least))
    assert sorted((r.n_words, r.n_removed, r.kept) for r in found) == wanted
    for r in found:
        assert sum(x.high - x.low for x in r.removed) == r.n_removed
        assert all(x.high < y.low for x, y in zip(r.removed, r.removed[1:], strict=False))


@pytest.mark.parametrize(("least", "letters", "crowded"), [(3, 3, 4096), (5, 2, 1), (6, 12, 0), (17, 40, 2)])
def test_repeated_windows_against_all_windows(spark, least, letters, crowded):
    rng = random.Random(least)
    texts = [" ".join(f"w{rng.randrange(letters)}" for _ in range(rng.randrange(30))) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(2 * least))
    texts += [f"{texts[i]} {passage}  \n{texts[i + 1]}" for i in range(8)]
    texts += ["a b " * 60, "x " * 70, None, "", texts[3], texts[3]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = substring_dedup.dedup_substrings(df, min_words=least, shard_words=200, seed_pieces=crowded)
    check_removed(found.collect(), texts, least)


def test_substrings_of_odd_rows(spark, stored, none):
    clashing = stored.select("*", *[F.lit("x").alias(c) for c in ("kept", "cuts", "_doc", "_a", "_b", "_part", "seed", "h", "m", "spans")])
    found = substring_dedup.dedup_substrings(clashing)
    assert found.columns == [c for c in clashing.columns if c != "kept"] + ["n_words", "n_removed", "removed", "kept"]
    rows = found.collect()
    check_removed(rows, [r.text for r in rows], 35)
    assert all(r.cuts == r._a == r.seed == "x" for r in rows)
    assert next(r.n_removed for r in rows if r.doc_id == 9) == 300_000
    assert substring_dedup.dedup_substrings(none).collect() == []


def test_substrings_do_not_depend_on_the_split_of_files(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(3)}" for _ in range(60)) for _ in range(40)] * 2
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = substring_dedup.dedup_substrings(df, min_words=12)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        check_removed(found.collect(), texts, 12)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_dedup_does_not_depend_on_the_split_of_files(spark, tmp_path):
    """Rows are read several times; each read may be split otherwise."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    passage = " ".join(rng.choices(words, k=60))
    rows = [(g * 4 + i, f"{' '.join(random.Random(g).choices(words, k=80))} {passage}") for g in range(30) for i in range(4)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(12).write.parquet(str(tmp_path / "t"))
    names = ("_row", "_key", "_cut", "cuts", "_doc", "_print", "n_words")
    docs = spark.read.parquet(str(tmp_path / "t")).select("*", *[F.lit("own").alias(c) for c in names])
    settings = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "1"}
    found = [simhash.keep_one(docs), line_dedup.dedup_passages(docs), line_dedup.dedup_lines(docs, min_words=20)]
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        kept, cut, lines = (df.collect() for df in found)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert sorted(r.doc_id for r in kept) == [4 * g for g in range(30)]
    assert sum(passage in r.text for r in cut) == 1 and len(cut) == 120
    assert sorted(r.doc_id for r in lines if r.text) == [4 * g for g in range(30)]
    assert all(r[c] == "own" for r in (*kept, *cut, *lines) for c in names)


# 12 conversation trie


def spark_hash(*values):
    found = 42
    for value in values:
        found = xxhash.xxh64_intdigest(value.encode(), found)
    return found - (1 << 64) * (found >> 63)


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", spark_hash(role or "", text or ""), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, cs in members.items():
        below = [p for p in members if p[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))
        out.append((
            min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), sum(len(p) == len(node) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


_TURNS = "conv_id long, turn long, role string, text string"


def some_conversations(seed):
    rng = random.Random(seed)
    rows = []
    ids = [0, 1, 2, 3, 5, 100, 101, 102, 250, 251, -100, -101, -3, 7, 8, 9, 10]
    for c in ids:
        for turn in range(rng.randrange(1, 14)):
            rows.append((c, rng.choice([turn, turn, None]) if seed % 2 else turn, rng.choice(["user", None, ""]), rng.choice(["a", "bé", None, "", "\U0001f600c"])))
    # long ones that part late, copies, a repeated row, a row without conversation
    long = [(turn, "user", f"t{turn}" * (turn % 3)) for turn in range(40)]
    rows += [(c, *x) for c in (500, 600, 700) for x in long] + [(700, 99, "user", "more"), (600, 39, "user", "t39"), rows[0], (None, 1, "user", "x")]
    return rows


@pytest.mark.parametrize(("seed", "block", "stride"), [(1, 4, 1024), (2, 1, 3), (3, 3, 2), (4, 64, 1)])
def test_trie_against_all_prefixes(spark, monkeypatch, seed, block, stride):
    monkeypatch.setattr(conversation_trie, "_STRIDE", stride)
    rows = some_conversations(seed)
    clashing = spark.createDataFrame(rows, _TURNS).select("*", *[F.lit(1).alias(c) for c in ("c", "place", "a", "k", "h", "depth", "_m", "n")])
    found = conversation_trie.trie(clashing.repartition(5), block=block)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=str) == brute_trie(rows)


def test_trie_of_turnless_conversations_and_of_nothing(spark):
    # conversations of one turn that lose it to a first conversation that is not there
    rows = [(c, 0, "user", "x") for c in range(901, 930) if crc32(str(c).encode()) % 6]
    found = conversation_trie.trie(spark.createDataFrame(rows, _TURNS))
    assert sorted(map(tuple, found.collect()), key=str) == brute_trie(rows) and len(rows) > 5
    assert conversation_trie.trie(spark.createDataFrame([], _TURNS)).collect() == []
    assert conversation_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], _TURNS)).collect() == []


def test_digest_of_a_node_with_many_ends(spark):
    ids = spark.range(0, 50_000, numPartitions=7)
    found = conversation_trie.trie(ids.select((F.col("id") * 6007 + 3).alias("conv_id"), F.lit(0).alias("turn"), F.lit("u").alias("role"), F.lit("same").alias("text")))
    rows = {r.depth: r for r in found.collect()}
    ended = defaultdict(list)
    every = [i * 6007 + 3 for i in range(50_000)]
    there = set(every)
    for c in every:
        h = crc32(str(c).encode()) % 6
        ended[1 if h == 0 or c - c % 100 in there else 0].append(c)
    for depth in (0, 1):
        assert rows[depth].ends_sha256 == hashlib.sha256(",".join(map(str, sorted(ended[depth]))).encode()).hexdigest()
    assert (rows[0].n_convs, rows[1].n_convs) == (50_000, len(ended[1]))


# 13 vector codes


def brute_codes(rows, parts, entries, rounds, scale):
    """(id, code, error) of each usable row, and the codebooks, in whole numbers of any size."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v in kept), default=0) // parts))
    kept = [(i, v + [0] * (parts * width - len(v))) for i, v in kept]
    first = sorted((r for r in kept if r[0] is not None))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v in first] for p in range(parts)]

    def assign(part, book):
        gaps = [sum((a - b) ** 2 for a, b in zip(part, c, strict=True)) for c in book]
        return gaps.index(min(gaps)), min(gaps)

    if not first:
        return [], books
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for _, v in kept:
                own[assign(cut(v, p), books[p])[0]].append(cut(v, p))
            books[p] = [[sum(x) // len(own[e]) for x in zip(*own[e], strict=True)] if e in own else c for e, c in enumerate(books[p])]
    done = [(i, [assign(cut(v, p), books[p]) for p in range(parts)]) for i, v in kept]
    return [(i, [e for e, _ in x], sum(g for _, g in x)) for i, x in done], books


@pytest.mark.parametrize(("parts", "entries", "rounds", "size", "residents"), [(16, 64, 2, 32, 1 << 17), (4, 5, 4, 10, 7), (3, 200, 1, 3, 50), (2, 1, 0, 5, 1)])
def test_codes_against_brute_force(spark, parts, entries, rounds, size, residents):
    rng = random.Random(size)
    middle = [[rng.uniform(-2, 2) for _ in range(size)] for _ in range(6)]
    rows = [(rng.choice([i, i, 3]), [x + rng.gauss(0, 0.2) for x in rng.choice(middle)][: rng.choice([size, size, size - 1])]) for i in range(150)]
    rows += [(7, rows[0][1])] * 60 + [(None, rows[1][1]), (900, None), (901, [None] * size), (902, [float("nan")] * size), (903, [float("inf")] * size), (904, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit("x").alias("code"), F.lit(5).alias("v"), F.lit("y").alias("_row"))
    found, books = vector_codes.compress(df.repartition(4), parts=parts, entries=entries, rounds=rounds, residents=residents)
    assert found.columns == ["vec_id", "embedding", "v", "_row", "code", "error"]
    wanted, wanted_books = brute_codes(rows, parts, entries, rounds, vector_codes.SCALE)
    assert books.tolist() == wanted_books
    assert sorted((str(r.vec_id), r.code, r.error) for r in found.collect()) == sorted((str(i), c, e) for i, c, e in wanted)


def test_only_parts_that_change_entry_migrate(spark):
    books = np.array([[[0, 0], [10, 10]]])
    rows = spark.createDataFrame([(0, [0, 1]), (1, [9, 9]), (2, [6, 6])], "_row long, v array<int>")
    first = vector_codes.first_generation(rows, books, 3)
    assert {(r._row, r.entry) for r in first.collect()} == {(0, 0), (1, 1), (2, 1)}
    fresh = np.array([[[0, 0], [14, 14]]])
    moved = vector_codes.migrants(first, [], fresh, 3).collect()
    assert [(r._row, r.entry, r.part) for r in moved] == [(2, 0, [6, 6])]
    left = vector_codes.settled(first, [fresh], fresh).collect()
    assert {(r._row, r.entry, r.error) for r in left} == {(0, 0, 1), (1, 1, 50)}


def test_codes_of_nothing_and_of_too_large_components(spark):
    shape = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(1, None, 2)], [(None, [1.0], 2)]):
        found, books = vector_codes.compress(spark.createDataFrame(rows, shape))
        assert found.columns == ["vec_id", "embedding", "label", "code", "error"]
        assert found.collect() == [] and books.shape[1] == 0
    with pytest.raises(ValueError, match="too large"):
        vector_codes.compress(spark.createDataFrame([(1, [3e38], 2)], shape))


def test_label_errors_of_null_labels_go_together(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist(), [None, 0, 1][i % 3]) for i in range(90)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = vector_codes.query(spark, str(tmp_path)).collect()
    sums = Counter()
    for r in found:
        sums[rows[r.vec_id][2]] += r.error
    assert all(r.label_error == sums[rows[r.vec_id][2]] for r in found) and len(found) == 90
