"""Compression of vectors to product codes: Lloyd's rounds over parts that reside with their owners.

Each part of a vector is a row that resides with its owner, the (position, entry, salt) it was assigned to. After an
assignment every owner adds up its residents, which gives the next codebooks; then each resident is compared with the new
codebook of its position where it lies, and only parts that change entry migrate, in the next shuffle.

The parts that migrate in one assignment are a generation, a table written once; the first holds all parts. A row of
a generation is a resident as long as each later codebook gives it the entry it has. That can be computed from the codebooks,
so no table is rewritten, and a lost executor only costs its tasks. Codebooks hold as many numbers as
``entries`` vectors and are sent to all tasks; everything else stays in tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm.common import dealt_join, fold, table
from dealtide.llm.topk import usable

# Scale of the components, parts of a vector, entries of a codebook, rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
# Residents of an owner, about: with more rows an entry has several owners.
RESIDENTS = 1 << 17

_GENERATION = "position int, entry int, salt int, _row long, part array<int>"


def nearest(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest entry of each part; the first one at ties."""
    entry, least = np.zeros(len(parts), np.int64), np.full(len(parts), np.iinfo(np.int64).max)
    for number, centre in enumerate(book):
        gap = ((parts - centre) ** 2).sum(1)
        closer = gap < least
        entry[closer], least[closer] = number, gap[closer]
    return entry


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _rows(position: int, entry: np.ndarray, row: np.ndarray, parts: np.ndarray, salts: int) -> pa.RecordBatch:
    ends = np.arange(len(parts) + 1, dtype=np.int32) * parts.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(parts.ravel().astype(np.int32)))
    # the odd multiplier spreads row numbers, whose low digits may be alike
    salt = (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % salts
    kinds = [np.full(len(parts), position, np.int32), entry.astype(np.int32), salt.astype(np.int32), row]
    return pa.RecordBatch.from_arrays([*[pa.array(k) for k in kinds], lists], names=["position", "entry", "salt", "_row", "part"])


def _residents(batch: pa.RecordBatch, later: Sequence[np.ndarray], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, row numbers, entries, parts) of the rows that every codebook of ``later`` gives the entry they have."""
    position = batch.column("position").to_numpy()
    entry, row = batch.column("entry").to_numpy(), batch.column("_row").to_numpy()
    parts = _matrix(batch.column("part"), width)
    for p in np.unique(position):
        some = np.flatnonzero(position == p)
        for books in later:
            some = some[nearest(parts[some], books[p]) == entry[some]]
        yield int(p), row[some], entry[some].astype(np.int64), parts[some]


def first_generation(vectors: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """All parts of ``vectors`` (_row, v), with the nearest entries."""
    positions, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, row = _matrix(batch.column("v"), positions * width), batch.column("_row").to_numpy()
            for p in range(positions):
                parts = v[:, p * width : (p + 1) * width]
                yield _rows(p, nearest(parts, books[p]), row, parts, salts)

    return vectors.select("_row", "v").mapInArrow(run, _GENERATION)


def migrants(generation: DataFrame, later: Sequence[np.ndarray], books: np.ndarray, salts: int) -> DataFrame:
    """The residents whose entry ``books`` changes, with their new entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, row, entry, parts in _residents(batch, later, books.shape[2]):
                fresh = nearest(parts, books[p])
                moves = fresh != entry
                if moves.any():
                    yield _rows(p, fresh[moves], row[moves], parts[moves], salts)

    return generation.mapInArrow(run, _GENERATION)


def owner_sums(generation: DataFrame, later: Sequence[np.ndarray], shape: tuple[int, int, int]) -> DataFrame:
    """(position, entry, at, total, n): sums of the residents' components, one row a task at most."""
    positions, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, np.int64), np.zeros((positions, entries), np.int64)
        for batch in batches:
            for p, _, entry, parts in _residents(batch, later, width):
                np.add.at(sums[p], entry, parts)
                counts[p] += np.bincount(entry, minlength=entries)
        p, e = np.nonzero(counts)
        keys = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p))]
        values = [sums[p, e].ravel(), np.repeat(counts[p, e], width)]
        arrays = [*[pa.array(k.astype(np.int32)) for k in keys], *[pa.array(v) for v in values]]
        yield pa.RecordBatch.from_arrays(arrays, names=["position", "entry", "at", "total", "n"])

    return generation.mapInArrow(run, "position int, entry int, at int, total long, n long")


def settled(generation: DataFrame, later: Sequence[np.ndarray], books: np.ndarray) -> DataFrame:
    """(_row, position, entry, error) of the residents; error is the squared distance to the entry in ``books``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, row, entry, parts in _residents(batch, later, books.shape[2]):
                gap = ((parts - books[p][entry]) ** 2).sum(1)
                arrays = [row, np.full(len(row), p, np.int32), entry.astype(np.int32), gap]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["_row", "position", "entry", "error"])

    return generation.mapInArrow(run, "_row long, position int, entry int, error long")


def updated(books: np.ndarray, sums: DataFrame) -> np.ndarray:
    """``books`` with the componentwise floor(total / n) of each entry that has residents."""
    found = sums.groupBy("position", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    fresh = books.copy()
    # as many rows as numbers in the codebooks
    for r in found.collect():
        fresh[r.position, r.entry, r.at] = r.total // r.n
    return fresh


def integral(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; what does not fit into 32 bits becomes 2^31 or less than -2^31."""
    edge = float(1 << 31)
    return F.transform(embedding, lambda x: F.floor(F.greatest(F.least(F.lit(scale) * x.cast("double"), F.lit(edge)), F.lit(-edge - 1))))


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    embedding: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    residents: int = RESIDENTS,
) -> tuple[DataFrame, np.ndarray]:
    """The usable rows of ``vectors`` with code (the entry of each part, in order) and error, and the codebooks (part, entry, place).

    Rows whose vector is null or holds null or non-finite components are left out. Components become floor(scale * x). Vectors
    shorter than the longest, or than a multiple of ``parts``, count as filled up with zeros. Codebooks begin
    with the vectors of the smallest ids; of rows with the same id those with the least components come first, null ids
    never. With fewer rows than ``entries`` there are fewer entries; repeated rows are vectors of their own; ties go to the
    lower entry. Input columns code and error are replaced, all others stay. An empty table gives no rows and codebooks without
    entries. Components and distances that do not fit into 32 and 64 bits are an error.
    """
    names = [c for c in vectors.columns if c not in ("code", "error")]
    own = vectors.where(usable(F.col(embedding))).select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_own"), F.col(id).alias("_id"), F.col(embedding).alias("_v"))
    rows = fold(own.select("_own", "_id", integral(F.col("_v"), scale).alias("v"), F.monotonically_increasing_id().alias("_row")), "vectors")
    count, longest, largest = rows.agg(F.count("*"), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    width = max(1, -(-(longest or 0) // parts))
    if (largest or 0) >= 1 << 31 or 4 * width * (largest or 0) ** 2 >= 1 << 63:
        raise ValueError(f"components of up to {largest} after scaling are too large for {width} of them in a part")
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(parts * width) - F.size("v"))).cast("array<int>")
    plain = rows.select("_row", filled.alias("v"))
    start = rows.where("_id IS NOT NULL").select("_id", filled.alias("v")).orderBy("_id", "v").limit(entries).collect()
    book = np.array([r.v for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2)
    shape = "_own." + "*"
    if not len(start):
        empty = rows.where("false").select(shape, F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, book
    salts = max(1, -(-count // residents))

    def settle(found: DataFrame) -> DataFrame:
        """The parts with their owners; sorted, so that few positions share a batch."""
        return fold(found.repartition("position", "entry", "salt").sortWithinPartitions("position", "entry"), "generation")

    history = [book]
    generations = [settle(first_generation(plain, book, salts))]
    for _ in range(rounds):
        sums = [owner_sums(g, history[i + 1 :], book.shape) for i, g in enumerate(generations)]
        fresh = updated(history[-1], reduce(DataFrame.unionByName, sums))
        moved = [migrants(g, history[i + 1 :], fresh, salts) for i, g in enumerate(generations)]
        generations.append(settle(reduce(DataFrame.unionByName, moved)))
        history.append(fresh)
    last = reduce(DataFrame.unionByName, [settled(g, history[i + 1 :], history[-1]) for i, g in enumerate(generations)])
    # as many entries as parts
    code = F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda x: x["entry"])
    coded = last.groupBy("_row").agg(code.alias("code"), F.sum("error").alias("error"))
    return rows.join(coded, "_row").select(shape, "code", "error"), history[-1]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("code", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    # a null label is a group of its own
    keys = [F.col("label").isNull().alias("_none"), F.coalesce("label", F.lit(0)).alias("_label")]
    rows = fold(found.select("vec_id", code.alias("code"), "error", *keys), "coded")
    labels = rows.groupBy("_none", "_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("m"))
    # the numbers of stored rows are the same whenever a task is repeated
    joined = dealt_join(rows, labels, ["_none", "_label"], F.monotonically_increasing_id(), "m", None)
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """Rounds are unrolled: one assignment and one update each."""

    def assignment(books: str) -> str:
        return (
            "SELECT r, p, part, arg_min(e, (list_sum(list_transform(list_zip(part, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e)) AS e, "
            "min(list_sum(list_transform(list_zip(part, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS gap "
            f"FROM parts JOIN {books} USING (p) GROUP BY r, p, part"
        )

    steps = [
        f"""usable AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM usable),
cut AS (SELECT r, vec_id, unnest(generate_series(0, {PARTS - 1})) AS p, v, len(v) // {PARTS} AS w FROM kept),
parts AS (SELECT r, vec_id, p, v[p * w + 1 : (p + 1) * w] AS part FROM cut),
b0 AS (SELECT p, r - 1 AS e, part AS c FROM parts WHERE vec_id IS NOT NULL AND r <= {ENTRIES})"""
    ]
    for i in range(ROUNDS):
        steps.append(f"a{i} AS ({assignment(f'b{i}')})")
        steps.append(
            f"x{i} AS (SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(part) AS x, unnest(generate_series(1, len(part))) AS i FROM a{i}) GROUP BY p, e, i)"
        )
        steps.append(f"m{i} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM x{i} GROUP BY p, e)")
        steps.append(f"b{i + 1} AS (SELECT p, e, coalesce(m.c, b.c) AS c FROM b{i} b LEFT JOIN m{i} m USING (p, e))")
    steps.append(f"z AS ({assignment(f'b{ROUNDS}')})")
    steps.append("coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(gap)::BIGINT AS error FROM z GROUP BY r)")
    steps.append(f"books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})")
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256\n"
        "FROM kept JOIN coded USING (r), books"
    )


SQL = _sql()
