"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dealtide.scratch import materialize

# The ASCII white space that separates words.
WHITE = b" \t\n\r\x0b\x0c"


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the column as text, modulo ``divisor``; null for null."""
    return F.crc32(F.col(column).cast("string")) % divisor


def sampled(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows, the same ones at every run: those with the smallest hashes of ``key``.

    All rows if there are no more. Only classifiers are fitted on such samples.
    """
    rows = df.count()
    if rows <= bound:
        return df
    share = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30))
    return df.where(share < int(bound / rows * (1 << 30)))


def segments(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Parts of a text that end before white space, so that no word is cut and memory is bounded."""
    at = 0
    while len(data) - at > size:
        ends = [i for i in (data.find(bytes([w]), at + size) for w in WHITE) if i >= 0]
        if not ends:
            break
        yield data[at : min(ends)]
        at = min(ends)
    yield data[at:] if at else data


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    values = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return values.cast(kind).to_pylist()


def small_batches(spark: SparkSession) -> None:
    """Lower Spark's default rows per Arrow batch, as texts are long; a setting of one's own stays."""
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")


def add_columns(
    df: DataFrame, shape: str, compute: Callable[[pa.RecordBatch], list], drop: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with columns that ``compute`` makes of each Arrow batch, without a shuffle.

    ``compute`` gives one list or array for each new column. An input column with the
    name of a new one is replaced.
    """
    fresh = T._parse_datatype_string(shape)
    kept = [f for f in df.schema if f.name not in {*fresh.names, *drop}]
    out = T.StructType([*kept, *fresh])
    names = [f.name for f in kept]
    types = to_arrow_schema(fresh).types

    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [pa.array(v, type=t) for v, t in zip(compute(batch), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *made], names=out.names)

    return df.mapInArrow(run, out)


def ragged(lists: list[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a row, and how many each list has."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


class WordTable:
    """Words of a task numbered as they come, each with a short array of ids; at most ``bound`` words.

    ``encode`` gives the ids of new words, as ``ragged`` does. Memory is bounded: a full table starts anew.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], bound: int) -> None:
        self.encode, self.bound = encode, bound
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.used = 0

    def add(self, words: list[bytes]) -> None:
        if len(self.place) + len(words) > self.bound:
            self.clear()
        first = len(self.place)
        self.place.update(zip(words, range(first, first + len(words)), strict=True))
        found, sizes = self.encode(words)
        ends = self.used + np.cumsum(sizes)
        while first + len(words) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        while self.used + len(found) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(found)] = found
        self.start[first + 1 : first + 1 + len(words)] = ends
        self.used += len(found)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """The ids of all words in a row."""
        return self.ids_by_word(words)[0]

    def ids_by_word(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each word has."""
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        fresh = list({words[i] for i in np.flatnonzero(at < 0)})
        if fresh:
            if len(self.place) + len(fresh) > self.bound:
                fresh = list(set(words))
                self.clear()
            self.add(fresh)
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        size = self.start[at + 1] - self.start[at]
        return gather(self.flat, self.start[at], size), size


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start : start + size]`` in a row."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(start - (ends - size), size)]


def fold(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder, which cuts the lineage."""
    return materialize(df, label, None)


def numbered(documents: DataFrame, key: str) -> DataFrame:
    """(_doc, _key, text, _row): the rows as structs with a number each, written once.

    A scan may be split otherwise when it is planned again, as Spark looks at the cores there are at that moment. Numbers
    given on the way would then name other rows; these are read back. The struct keeps columns of any name apart.
    """
    stored = fold(documents.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_row")), "numbered")
    return stored.select("_doc", F.col(f"_doc.`{key}`").alias("_key"), F.col("_doc.text").alias("text"), "_row")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links`` (a, b), both long.

    Alternating large and small stars. Minima are aggregated before the shuffle, so a
    node with very many links reaches it as few rows, and each round is a written table.
    """
    stars = fold(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = fold(large.distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        stars = fold(small.unionByName(low.withColumnRenamed("m", "b")).where("a <> b").distinct(), "small-star")
        # equal counts and order-free checksums mean that nothing changed
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if now == seen:
            break
        seen = now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def dealt_join(
    left: DataFrame, right: DataFrame, on: list[str], by: Column, count: str, rows: int | None, how: str = "inner", parts: int = 1000
) -> DataFrame:
    """``left`` joined with ``right``, which has each key once and in ``count`` how many rows of ``left`` have it.

    A key with more than one in ``parts`` of all rows is dealt out by ``by``, a hash of the row, and its row of
    ``right`` copied to each part. There are fewer than ``parts`` such keys, so their list is broadcast. ``rows``
    is the number of rows of ``left``, counted if not given.
    """
    limit = max(1, (left.count() if rows is None else rows) // parts)
    spread = (-F.floor(-F.col(count) / limit)).cast("int").alias("_parts")
    hot = F.broadcast(fold(right.where(F.col(count) > limit).select(*on, spread), "hot-keys"))
    dealt = left.join(hot, on, "left").withColumn("_part", F.coalesce(F.pmod(by, "_parts"), F.lit(0)).cast("int")).drop("_parts")
    copied = right.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return dealt.join(copied, [*on, "_part"], how).drop("_part")
