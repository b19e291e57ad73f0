"""Substring deduplication: words in repeated windows, found by backward search in a compressed index per shard.

A window is ``min_words`` consecutive words of a text. Windows are dealt to shards by what they hold, so that equal
windows always meet: a window's seed is the least hash of the short runs of words in it, and neighbours with one seed are
a piece. Only pieces whose seed occurs twice or more can hold a repeated window. Equal pieces are one with a count, and
a seed with very many pieces is dealt on window by window. Each shard is of bounded size; it builds an FM-index
(``fm_index``) of its pieces and streams them through it: matching statistics of ``min_words`` or more mark repeated windows.

Texts are named by two 64-bit hashes, not by row numbers, so that the same rows come out however the files are split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm.common import WHITE, add_columns, dealt_join, fold, small_batches, table
from dealtide.llm.fm_index import FMIndex

MIN_WORDS = 35
# Words of the short runs whose least hash is a seed.
UNIT = 8
# Words of a shard, about. Seeds with more pieces than SEED_PIECES are dealt on by window.
SHARD_WORDS, SEED_PIECES = 1 << 20, 4096
# Bytes hashed at once; a word of more than _LONG is hashed by itself.
_CHUNK, _LONG = 1 << 21, 1 << 15

_BLANK = np.zeros(256, bool)
_BLANK[list(WHITE)] = True
_random = np.random.default_rng(35)
_LETTER = _random.integers(0, 1 << 64, 256, np.uint64)
_BASES = _random.integers(0, 1 << 63, 3, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    # Multipliers of the splitmix64 finaliser.
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(0, count - 1), base)]))[:count]


def _run_hashes(values: np.ndarray, base: np.uint64, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each of the runs ``values[start:end]``; equal runs have equal hashes wherever they lie."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=sums[1:])
    return _mixed((sums[end] - sums[start]) * _powers(inverse, len(values) + 1)[start] + (end - start).astype(np.uint64))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of consecutive texts start and end, and to which text each belongs."""
    word = ~_BLANK[data]
    before, behind = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], behind[:-1] = word[:-1], word[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], behind[edges - 1] = False, False
    start = np.flatnonzero(word & ~before)
    return start, np.flatnonzero(word & ~behind) + 1, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.zeros(len(start), np.uint64)
    long = np.flatnonzero(end - start > _LONG)
    for i in long:
        out[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]].tobytes())
    # from one long word to the next, in chunks
    for first, until in zip(np.concatenate([[0], long + 1]), np.concatenate([long, [len(start)]]), strict=True):
        while first < until:
            stop = min(until, max(first + 1, int(np.searchsorted(end, start[first] + _CHUNK, side="right"))))
            low = start[first]
            part = _LETTER[data[low : end[stop - 1]]]
            out[first:stop] = _run_hashes(part, _BASES[0], start[first:stop] - low, end[first:stop] - low)
            first = stop
    return out


def _least_of(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each ``width`` values in a row and its first place, by doubling."""
    least, place, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        other, there = least[step:], place[step:]
        here = least[: len(other)]
        less = other < here
        least, place = np.where(less, other, here), np.where(less, there, place[: len(other)])
        span += step
    return least, place


def pieces_of(hashes: np.ndarray, owner: np.ndarray, texts: int, min_words: int) -> tuple[np.ndarray, ...]:
    """(text, first word, windows, seed, hash of all words) of the pieces of some texts, in order.

    A piece ends where the seed changes, and after as many windows as there are short runs in one. A piece in which its seed
    occurs twice is halved, as it may repeat itself; otherwise its windows all differ.
    """
    unit = max(1, min(UNIT, min_words // 2))
    width = min_words - unit + 1
    none = np.zeros(0, np.int64)
    if len(hashes) < min_words:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    at = np.arange(len(hashes) - unit + 1)
    seed, place = _least_of(_run_hashes(hashes, _BASES[1], at, at + unit), width)
    window = np.flatnonzero(owner[: len(seed)] == owner[min_words - 1 :])
    if not len(window):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    seed, place = seed[window], place[window]
    new = np.ones(len(window), bool)
    new[1:] = (seed[1:] != seed[:-1]) | (window[1:] != window[:-1] + 1)

    def starts(new: np.ndarray) -> np.ndarray:
        return np.flatnonzero(new)[np.cumsum(new) - 1]

    count = np.arange(len(window))
    new |= (count - starts(new)) % width == 0
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(window)))
    moves = np.concatenate([[0], np.cumsum(np.concatenate([[0], place[1:] != place[:-1]]))])
    twice = moves[begin + size] > moves[begin + 1]
    begin = np.sort(np.concatenate([begin, begin[twice] + size[twice] // 2]))
    size = np.diff(np.append(begin, len(window)))
    first = window[begin]
    whole = _run_hashes(hashes, _BASES[2], first, first + size + min_words - 1)
    opening = np.searchsorted(owner, np.arange(texts))
    text = owner[first]
    return text, first - opening[text], size, seed[begin], whole


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text starts; nulls are empty."""
    filled = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def seeded(texts: DataFrame, min_words: int) -> DataFrame:
    """(_a, _b, first, size, seed, h): the pieces of the texts, one row each."""

    def found(batch: pa.RecordBatch) -> list:
        data, offsets = _flat(batch.column("text"))
        start, end, owner = word_bounds(data, offsets)
        text, first, size, seed, whole = pieces_of(word_hashes(data, start, end), owner, batch.num_rows, min_words)
        ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
        lists = [(first, np.int32), (size, np.int16), (seed.view(np.int64), np.int64), (whole.view(np.int64), np.int64)]
        return [pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(v.astype(kind))) for v, kind in lists]

    shape = "first array<int>, size array<smallint>, seed array<bigint>, h array<bigint>"
    nested = fold(add_columns(texts, shape, found, drop=("text",)), "pieces")
    one = F.explode(F.arrays_zip("first", "size", "seed", "h")).alias("x")
    return nested.select("_a", "_b", one).select("_a", "_b", "x.*")


def _cut_out(texts: DataFrame, wanted: DataFrame, min_words: int) -> DataFrame:
    """(seed, h, at, ph, n, piece): the words of the wanted pieces; of crowded seeds each window, ``at`` words on, with its own hash ph."""
    spans = wanted.groupBy("_a", "_b").agg(F.collect_list(F.struct("first", "size", "seed", "h", "n", "crowded")).alias("spans"))
    # of equal texts one is enough; a text has as many spans as pieces
    once = texts.groupBy("_a", "_b").agg(F.first("text").alias("text")).join(spans, ["_a", "_b"])
    shape = "seed long, h long, at int, ph long, n long, crowded boolean, piece string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_buffer().to_pybytes().split()
                rows: list[tuple] = []
                for s in spans.as_py():
                    if not s["crowded"]:
                        piece = b" ".join(words[s["first"] : s["first"] + s["size"] + min_words - 1])
                        rows.append((s["seed"], s["h"], 0, s["h"], s["n"], False, piece))
                        continue
                    for at in range(s["size"]):
                        piece = b" ".join(words[s["first"] + at : s["first"] + at + min_words])
                        name = xxhash.xxh64_intdigest(piece) - (1 << 63)
                        rows.append((s["seed"], s["h"], at, name, s["n"], True, piece))
                for i in range(0, len(rows), 10_000):
                    columns = list(zip(*rows[i : i + 10_000], strict=True))
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
                    piece = pa.array(columns[-1], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([*arrays, piece], names=["seed", "h", "at", "ph", "n", "crowded", "piece"])

    return once.select("text", "spans").mapInArrow(cut, shape)


def repeated_in(shard: pd.DataFrame, min_words: int) -> pd.DataFrame:
    """(seed, ph, low, high): the ranges of words of a shard's pieces that lie in windows occurring twice or more."""
    known: dict[str, int] = {}
    ids, sizes = [], []
    for piece in shard.piece:
        words = piece.split(" ")
        sizes.append(len(words))
        ids += [known.setdefault(w, len(known) + 1) for w in words]
    sizes, ids = np.array(sizes, np.int64), np.array(ids, np.int64)
    index = FMIndex(ids, sizes, shard.n.to_numpy(np.int64))
    at = np.flatnonzero(index.matching_statistics(ids, sizes) >= min_words)
    opening = np.cumsum(sizes) - sizes
    owner = np.searchsorted(opening, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (at[1:] > at[:-1] + min_words)
    begin = np.flatnonzero(new)
    until = np.append(begin[1:], len(at))[: len(begin)] - 1
    piece = owner[begin]
    return pd.DataFrame({
        "seed": shard.seed.to_numpy()[piece],
        "ph": shard.ph.to_numpy()[piece],
        "low": (at[begin] - opening[piece]).astype("int32"),
        "high": (at[until] - opening[piece] + min_words).astype("int32"),
    })


def repeated_ranges(texts: DataFrame, min_words: int = MIN_WORDS, shard_words: int = SHARD_WORDS, seed_pieces: int = SEED_PIECES) -> DataFrame:
    """(_a, _b, cuts): for each text, by its two names, the ranges (low, high) of words in repeated windows; they may overlap.

    ``texts`` has _a, _b and text, one row per document; equal texts count as often as they occur.
    """
    pieces = seeded(texts, min_words)
    often = pieces.groupBy("seed").agg(F.count("*").alias("m")).where("m > 1")
    total = pieces.count()
    known = fold(dealt_join(pieces, often, ["seed"], F.xxhash64("_a", "first"), "m", total), "repeated-seeds")
    place = F.struct("_a", "_b", "first", "size")
    distinct = known.groupBy("seed", "h").agg(F.count("*").alias("n"), F.min(place).alias("x"), F.max("m").alias("m"))
    distinct = fold(distinct.select("seed", "h", "n", "x.*", (F.col("m") > seed_pieces).alias("crowded")), "distinct-pieces")
    cut = fold(_cut_out(texts, distinct, min_words), "cut-pieces")

    # windows of crowded seeds may be equal in very many pieces: they are added up first
    columns = ["seed", "ph", "n", "piece"]
    single = cut.where("crowded").groupBy("seed", "ph").agg(F.sum("n").alias("n"), F.first("piece").alias("piece"))
    indexed = cut.where("NOT crowded").select(*columns, F.xxhash64("seed").alias("to")).unionByName(
        single.select(*columns, F.xxhash64("seed", "ph").alias("to"))
    )
    words = distinct.agg(F.sum(F.when(F.col("crowded"), F.col("size") * min_words).otherwise(F.col("size") + min_words - 1))).first()[0]
    shards = max(1, -(-(words or 0) // shard_words))
    ranges = indexed.withColumn("shard", F.pmod("to", F.lit(shards))).groupBy("shard")
    ranges = ranges.applyInPandas(lambda shard: repeated_in(shard, min_words), "seed long, ph long, low int, high int")
    ranges = fold(ranges, "repeated-windows")

    # back from windows to pieces, from pieces to texts
    windows = cut.where("crowded").select("seed", "ph", "h", "at", "n")
    hits = ranges.groupBy("seed", "ph").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    crowd = cut.where("crowded").groupBy("seed", "ph").agg(F.count("*").alias("m"))
    back = dealt_join(windows, hits.join(crowd, ["seed", "ph"]), ["seed", "ph"], F.xxhash64("h", "at"), "m", total)
    moved = back.select("seed", "h", F.explode("found").alias("x"), "at").select("seed", "h", F.struct(F.col("x.low") + F.col("at"), F.col("x.high") + F.col("at")).alias("x"))
    # a whole piece is its own only window: ph = h; crowded seeds have no such row
    plain = ranges.join(cut.where("crowded").select("seed").distinct(), "seed", "left_anti").select("seed", F.col("ph").alias("h"), F.struct("low", "high").alias("x"))
    covers = plain.union(moved).groupBy("seed", "h").agg(F.collect_set("x").alias("found"))
    covers = fold(covers.join(distinct.select("seed", "h", F.col("n").alias("m")), ["seed", "h"]), "covers")
    placed = dealt_join(known.drop("m"), covers, ["seed", "h"], F.xxhash64("_a", "first"), "m", total)
    gone = placed.select("_a", "_b", "first", F.explode("found").alias("x"))
    gone = gone.select("_a", "_b", F.struct((F.col("first") + F.col("x.low")).alias("low"), (F.col("first") + F.col("x.high")).alias("high")).alias("x"))
    return gone.groupBy("_a", "_b").agg(F.collect_set("x").alias("cuts"))


def _named(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("_a"), F.xxhash64(F.lit("second name"), text).alias("_b")


def dedup_substrings(
    documents: DataFrame, key: str = "doc_id", min_words: int = MIN_WORDS, shard_words: int = SHARD_WORDS, seed_pieces: int = SEED_PIECES
) -> DataFrame:
    """``documents`` with n_words, n_removed, removed (disjoint ranges of words, in order) and kept (the other words, joined by one space).

    A word is removed if it lies in a window of ``min_words`` words whose words also start anywhere else, in the same text or
    another; so all copies go. Words are parted by ASCII white space and compared byte by byte. Null texts have no
    words, nor have empty ones; repeated rows are copies of each other, whatever their keys, also null ones. Very long
    texts are read whole; long pieces of them are compared like all others. Other columns stay; those named like the new ones are replaced. An
    empty table stays empty. Texts and pieces are told apart by two 64-bit hashes each, words in the index by themselves.
    """
    fresh = ("n_words", "n_removed", "removed", "kept")
    columns = [F.col(f"_doc.`{c}`") for c in documents.columns if c not in fresh]
    text = F.coalesce("text", F.lit(""))
    named = documents.select(F.struct("*").alias("_doc"), text.alias("text"), F.xxhash64(F.col(key)).alias("_key"), *_named(text))
    texts = named.select("_a", "_b", "text")
    cuts = fold(repeated_ranges(texts, min_words, shard_words, seed_pieces), "cuts")
    copies = texts.groupBy("_a", "_b").agg(F.count("*").alias("m"))
    counted = cuts.join(copies, ["_a", "_b"])
    joined = dealt_join(named, counted, ["_a", "_b"], F.col("_key"), "m", None, how="left").select("_doc", "text", "cuts")

    def cut(batch: pa.RecordBatch) -> list:
        found = []
        for text, cuts in zip(batch.column("text"), batch.column("cuts"), strict=True):
            words = text.as_buffer().to_pybytes().split()
            gone = np.zeros(len(words) + 1, np.int32)
            for c in cuts.as_py() or ():
                gone[c["low"]] += 1
                gone[c["high"]] -= 1
            inside = np.concatenate([[0], np.cumsum(gone[:-1]) > 0, [0]]).astype(np.int8)
            low, high = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
            edges = zip([0, *high], [*low, len(words)], strict=True)
            left = b" ".join(w for a, b in edges for w in words[a:b])
            ranges = [{"low": int(a), "high": int(b)} for a, b in zip(low, high, strict=True)]
            found.append((len(words), int((high - low).sum()), ranges, left.decode("utf-8", "replace")))
        return list(zip(*found, strict=True)) if found else [[], [], [], []]

    shape = "n_words long, n_removed long, removed array<struct<low:int,high:int>>, kept string"
    return add_columns(joined, shape, cut, drop=("text", "cuts")).select(*columns, *fresh)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i, len(w) AS n FROM d),
s AS (
  SELECT r, i, word, CASE WHEN i + 34 <= n THEN
    sha256(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS h FROM e),
c AS (SELECT r, i, word, h IS NOT NULL AND count(*) OVER (PARTITION BY h) > 1 AS hit FROM s),
m AS (SELECT r, i, word, bool_or(hit) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM c),
k AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
