"""Packing of tokenised documents into sequences: cutting stock by column generation.

A document longer than a sequence fills whole sequences; its rest is one piece. The rests form
a histogram of lengths, rounded up to multiples of ``GRAIN``, or of less in those octaves where
rounding would pad more than a share ``LOSS`` of all ids. A linear program over patterns
(multisets of lengths that fit into a sequence) covers the histogram with the fewest sequences;
its columns come from a knapsack dynamic program over the dual prices. The patterns are used
as often as the rounded solution says, what is left is packed best fit. The program sees the
histogram alone, which has ``CAPACITY`` numbers at most however large the corpus is. The
documents are ranked within their length, and the ranks of a length are dealt to patterns
by intervals.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dealtide.llm.common import WordTable, fold, gather, ragged, segments, small_batches, table, texts_of

# Ids of a sequence, the id that ends a document.
CAPACITY, END = 2048, 1
GRAIN, LOSS = 8, 0.01
# The linear program ends when no packing can need less than this share below it.
GAP = 2e-3
# Distinct words whose ids a worker remembers at most.
_CACHE = 1_000_000
_TOGETHER = 4 << 20
# Letters whose normal form is their lower case; behind them, ASCII signs other than the apostrophe.
_CLOSED = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
# The end of a token that ends a word.
_WORD_END = "</w>"
# Patterns a size that the linear program tries at most.
STEPS = 100
# Pieces of one length that a task ranks, about, and the share of all pieces that this is at most.
RANKED, SHARES = 200_000, 1000


class Encoder:
    """Ids of whole texts. White space separates words for this kind of tokenizer, which also ignores
    case, so each distinct word is encoded once for as long as it is remembered."""

    def __init__(self, path: str) -> None:
        # Spark runs one task per core already
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.words = WordTable(self._encode, _CACHE)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(_WORD_END)]] = True

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters and closing signs are put together from their parts."""
        letters: dict[str, int] = {}
        others: dict[str, int] = {}
        place = np.empty((len(words), 2), np.int64)
        for i, word in enumerate(words):
            text = word.decode("utf-8", "replace")
            m = _CLOSED.fullmatch(text)
            a, b = m.groups() if m else ("", text)
            place[i] = letters.setdefault(a, len(letters)) if a else -1, others.setdefault(b, len(others))
        flat, size = self._letters(list(letters))
        rest, rest_size = ragged([f.ids for f in self.tokenizer.encode_batch_fast(list(others), add_special_tokens=False)])
        flat, size = np.concatenate([flat, rest]), np.concatenate([size, rest_size, [0]])
        start = np.cumsum(size) - size
        # a word without letters takes the last entry, which is empty
        place[:, 0] = np.where(place[:, 0] < 0, len(size) - 1, place[:, 0])
        place[:, 1] += len(letters)
        return gather(flat, start[place.ravel()], size[place.ravel()]), size[place].sum(1)

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One call for many words, told apart by the tokens that end a word, is cheaper than one call each."""
        flat, ends, before = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], 0
        for at in range(0, len(words), 1000):
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words[at : at + 1000])], add_special_tokens=False)[0].ids, np.uint32)
            flat.append(ids)
            ends.append(np.flatnonzero(self.ends[ids]) + 1 + before)
            before += len(ids)
        bounds = np.concatenate(ends)
        if len(bounds) != len(words) + 1:
            raise ValueError("not a tokenizer whose words of letters end with one end token")
        return np.concatenate(flat), np.diff(bounds)

    def ids(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """The ids of each text and the end id. Texts of moderate size are looked up together."""
        run: list[bytes] = []
        size = 0
        for text in texts:
            text = cased(text)
            if len(text) > _TOGETHER:
                yield from self._together(run)
                run, size = [], 0
                parts = [next(self._together([part]))[:-1] for part in segments(text)]
                yield np.concatenate([*parts, [END]]).astype("<u4")
                continue
            run.append(text)
            size += len(text)
            if size > _TOGETHER:
                yield from self._together(run)
                run, size = [], 0
        yield from self._together(run)

    def _together(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        # the words are told apart by Arrow, so that Python sees each one once
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.view(pa.binary()).to_pylist()
        flat, sizes = self.words.ids_by_word(words)
        start, place = np.cumsum(sizes) - sizes, coded.indices.to_numpy(zero_copy_only=False)
        each = sizes[place]
        flat = gather(flat, start[place], each)
        edges = np.concatenate([[0], np.cumsum(each)])[split.offsets.to_numpy()]
        for a, b in zip(edges, edges[1:], strict=False):
            yield np.concatenate([flat[a:b], [END]]).astype("<u4")


def cased(text: bytes | None) -> bytes:
    """Lower case, unless the text may hold the name of a special token, which is written in lower case."""
    text = text or b""
    return text if b"<|" in text else text.lower()


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One per worker process, so that later tasks there know the words of earlier ones."""
    return Encoder(path)


def pieces(documents: DataFrame, keep: list[str], tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``keep``, start, length, ids_crc32, doc_tokens and, if wanted, ids."""
    source = documents.select(*keep, F.col("text").alias("_text"))
    made = "start long, length int, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text"), made])
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in batches:
            owner, columns = [], [[], [], [], [], []]
            texts = texts_of(batch, "_text")
            for i, ids in enumerate(encoder.ids(texts)):
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    owner.append(i)
                    for column, value in zip(columns, (start, len(part), crc32(part.tobytes()), len(ids), part if with_ids else None), strict=True):
                        column.append(value)
            own = batch.select(keep).take(pa.array(owner, pa.int64())) if keep else None
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: 4 + with_ids]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays([*(own.columns if own else []), *arrays], names=[*keep, "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(keep) + len(arrays)])

    return source.mapInArrow(run, shape)


def octave(length: int) -> int:
    return int(length).bit_length() - 1


def grains(histogram: dict[int, int], grain: int = GRAIN, loss: float = LOSS) -> dict[int, int]:
    """To which multiples the lengths of each octave are rounded up, so that this pads at most a share ``loss`` of the ids.

    The octave that pads most is halved first.
    """
    total = sum(size * n for size, n in histogram.items())
    found = {k: grain for k in {octave(size) for size in histogram}}

    def padded(k: int, unit: int) -> int:
        return sum(-size % unit * n for size, n in histogram.items() if octave(size) == k)

    lost = {k: padded(k, grain) for k in found}
    while sum(lost.values()) > loss * total:
        worst = max(lost, key=lost.__getitem__)
        found[worst] = max(1, found[worst] // 2)
        lost[worst] = padded(worst, found[worst])
    return found


def knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The dearest multiset of ``sizes`` (ascending) that fits into ``room``: value, count by size."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if fits[c]:
            values = prices[: fits[c]] + best[c - sizes[: fits[c]]]
            k = int(values.argmax())
            if values[k] > best[c]:
                best[c], last[c] = values[k], k
    counts, c = np.zeros(len(sizes), int), room
    while c > 0:
        if last[c] >= 0:
            counts[last[c]] += 1
        c -= sizes[last[c]] if last[c] >= 0 else 1
    return float(best[room]), counts


def generate(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (row each, count by size) and how often the linear program uses them.

    Revised simplex: starts with one size per pattern, and brings in the pattern that the
    dynamic program finds dearest. Over its worth, the present solution is a lower bound of the
    best one, and so is the sum of all sizes over the room, so the search ends when the solution is near to the best bound so far. Should rounding
    keep it from getting there, it ends after ``STEPS`` patterns a size; all pieces are packed then too, less tightly.
    """
    basis = np.diag(room // sizes).astype(float)
    inverse = np.diag(1 / (room // sizes))
    used = inverse @ demand
    least = float(sizes @ demand) / room
    for _ in range(STEPS * len(sizes)):
        prices = np.maximum(0, inverse.sum(0))
        value, pattern = knapsack(prices, sizes, room)
        least = max(least, used.sum() / max(value, 1))
        if used.sum() <= least * (1 + GAP) or value <= 1 + 1e-9:
            break
        change = inverse @ pattern
        ratio = np.where(change > 1e-9, used / np.where(change > 1e-9, change, 1), np.inf)
        leaves = int(ratio.argmin())
        if not np.isfinite(ratio[leaves]):
            break
        used = np.maximum(0, used - ratio[leaves] * change)
        used[leaves] = ratio[leaves]
        row = inverse[leaves] / change[leaves]
        inverse -= np.outer(change, row)
        inverse[leaves] = row
        basis[:, leaves] = pattern
    return basis.T.astype(int), used


def plan(histogram: dict[int, int], room: int) -> list[tuple[int, int, int, int, int]]:
    """Intervals (length, first rank, count per sequence, first sequence, sequences) that deal all ranks of all lengths.

    Fractions are rounded down, then up in order of size while all lengths of the pattern
    are still left; the rest is packed best fit by falling length.
    """
    unit = reduce(math.gcd, histogram, room)
    sizes, room = np.array(sorted(histogram), int) // unit, room // unit
    left = np.array([histogram[s * unit] for s in sizes.tolist()], int)
    patterns, used = generate(sizes, left.astype(float), room) if len(sizes) else (np.zeros((0, 0), int), np.zeros(0))
    times = np.floor(used + 1e-9).astype(int)
    for i, p in enumerate(patterns):
        held = p > 0
        times[i] = min(times[i], int((left[held] // p[held]).min())) if held.any() else 0
        left -= times[i] * p
    for i in np.argsort(-(used - np.floor(used)), kind="stable"):
        if patterns[i].any() and (left >= patterns[i]).all():
            times[i] += 1
            left -= patterns[i]
    chosen = [(p, int(t)) for p, t in zip(patterns, times, strict=True) if t]
    # what is left has at most as many patterns' worth of pieces as there are lengths
    bins: list[np.ndarray] = []
    by_room: list[list[int]] = [[] for _ in range(room + 1)]
    for at_size, size in reversed(list(enumerate(sizes.tolist()))):
        for _ in range(left[at_size]):
            fit = next((r for r in range(size, room + 1) if by_room[r]), None)
            if fit is None:
                bins.append(np.zeros(len(left), int))
                at, fit = len(bins) - 1, room
            else:
                at = by_room[fit].pop()
            bins[at][at_size] += 1
            by_room[fit - size].append(at)
    rows, next_rank, sequence = [], np.zeros(len(sizes), int), 0
    for pattern, count in [*chosen, *((b, 1) for b in bins)]:
        for k in np.flatnonzero(pattern):
            rows.append((int(sizes[k]) * unit, int(next_rank[k]), int(pattern[k]), sequence, count))
            next_rank[k] += pattern[k] * count
        sequence += count
    return rows


def pack(documents: DataFrame, tokenizer: str, keep: tuple[str, ...] = ("doc_id",), capacity: int = CAPACITY, grain: int = GRAIN, with_ids: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset: ``keep``, start, length, ids_crc32, doc_tokens, and ids if wanted.

    Whole sequences of long documents come first, the packed rests after them. A null or empty
    text is its end id alone. Repeated rows, and rows with a null id, are documents of their
    own. Other columns are ignored. An empty table gives no rows.
    """
    spark = documents.sparkSession
    own = [f"_{i}" for i, _ in enumerate(keep)]
    source = documents.select(*[F.col(k).alias(o) for k, o in zip(keep, own, strict=True)], "text")
    cut = pieces(source, own, tokenizer, capacity, with_ids)
    # written with a number that deals pieces of one length to tasks, so that every read deals them alike
    cut = fold(cut.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id(), "start", "ids_crc32")), "pieces")
    # one entry per length, of which there are at most ``capacity``
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    whole = histogram.pop(capacity, 0)
    unit = grains(histogram, grain)
    demand: dict[int, int] = {}
    for size, n in histogram.items():
        rounded = min(capacity, size + -size % unit[octave(size)])
        demand[rounded] = demand.get(rounded, 0) + n
    # whole sequences are ranked with the rests: they have a bin of their own
    of = F.lit(capacity + 1)
    for k, g in unit.items():
        of = F.when((F.col("length") < min(capacity, 2 << k)) & (F.col("length") >= 1 << k), F.least(F.lit(capacity), F.ceil(F.col("length") / g) * g)).otherwise(of)
    cut = cut.withColumn("_bin", of.cast("int"))
    # a share of all pieces at most, so that one frequent length is many tasks' work in small tables too
    ranked_at_once = max(1, min(RANKED, (whole + sum(demand.values())) // SHARES))
    splits = [(b, -(-n // ranked_at_once)) for b, n in [*demand.items(), (capacity + 1, whole)] if n]
    dealt = spark.createDataFrame(splits or [(0, 1)], "_bin int, _splits int")
    cut = cut.join(F.broadcast(dealt), "_bin").withColumn("_split", F.pmod("_deal", "_splits")).drop("_splits")
    counts = fold(cut.groupBy("_bin", "_split").count(), "histogram")
    rows = [(capacity + 1, 0, 1, 0, whole)] if whole else []
    rows += [(b, first, per, sequence + whole, times) for b, first, per, sequence, times in plan(demand, capacity)]
    before = Window.partitionBy("_bin").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy("_bin", "_split").orderBy("_deal", "start", "ids_crc32", *own)
    # one row per length, per ``RANKED`` pieces and per share, and one interval per length and pattern
    ranked = cut.withColumn("_row", F.row_number().over(within)).join(F.broadcast(starts), ["_bin", "_split"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_row") - 1).drop("_before", "_row", "_split", "_deal")
    intervals = spark.createDataFrame(rows, "_bin int, first long, per long, sequence long, times long")
    packed = F.sort_array(F.collect_list(F.struct("first", "per", "sequence", "times")))
    by_bin = intervals.groupBy("_bin").agg(packed.alias("_all"))
    ranked = ranked.join(F.broadcast(by_bin), "_bin")
    taken = F.element_at(F.filter("_all", lambda x: x["first"] <= F.col("_rank")), -1)
    placed = ranked.withColumn("_at", taken).withColumn("_place", F.col("_rank") - F.col("_at.first"))
    sequence = (F.col("_at.sequence") + F.floor(F.col("_place") / F.col("_at.per"))).cast("long")
    placed = placed.withColumn("sequence_id", sequence).drop("_all", "_at", "_place")
    # a sequence holds at most ``capacity`` pieces
    order = Window.partitionBy("sequence_id").orderBy(F.desc("_bin"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long")
    placed = placed.withColumn("offset", offset)
    names = ["ids_crc32", "doc_tokens", *(["ids"] if with_ids else []), "sequence_id", "offset"]
    renamed = [F.col(o).alias(k) for k, o in zip(keep, own, strict=True)]
    return placed.select(*renamed, "start", F.col("length").cast("long").alias("length"), *names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
