"""Parquet tables whose versions are folders, so that no write touches its own input."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.functions.columns import named, row_count
from dealtide.functions.types import common_shape
from dealtide.operators.merge import apply_increment, bucket_of, compete, reduce_increment
from dealtide.scratch import CODEC, append_row, folder_exists
from dealtide.sinks.files import write_parquet

_COMMIT = (
    "version bigint, mode string, folder string, load_id string, written bigint, "
    "column_name string, max_value string, committed_at timestamp, shape string, "
    "buckets bigint, held string"
)


@dataclass(frozen=True)
class Load:
    """What a write did; ``metrics`` come from the write itself, not from a second job."""

    rows: int
    committed: bool
    metrics: dict[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Mark:
    """Progress to be stored with a commit: a metric of the write, or a fixed value."""

    column: str
    metric: Column | None = None
    value: str | None = None


def greatest(df: DataFrame, column: str, last: str | None = None, stored_as: str | None = None) -> Mark:
    """Greatest value of a column, and never less than the last one."""
    kind = df.schema[column].dataType.simpleString()
    metric = F.greatest(F.max(named(column)), F.lit(last).cast(kind)).cast("string")
    return Mark(stored_as or column, metric=metric.alias("mark"))


# Folders of a table that is kept in buckets of its key.
BUCKET = "_bucket"


def _held(commit: Row) -> list[int]:
    """The buckets that a commit holds."""
    return [int(b) for b in commit.held.split(",")] if commit.held else []


def _shape_of(commit: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit.shape))


def _in_shape(df: DataFrame, whole: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``whole``; columns it lacks are null."""
    if df.schema.simpleString() == whole.simpleString():
        return df
    present = set(df.columns)
    return df.select(
        *[(named(c.name) if c.name in present else F.lit(None)).cast(c.dataType).alias(c.name) for c in whole]
    )


class Table:
    """A folder with one subfolder per write and a list of commits.

    A commit replaces all before it, adds to it, or replaces some buckets of it. A write fills a new subfolder and is visible once its commit row exists. The
    watermark is part of that row, so data and watermark move together. One writer at
    a time.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def log(self) -> DataFrame:
        return self.spark.read.schema(_COMMIT).parquet(f"{self.path}/_log")

    def _of_log(self, condition: Column, *wanted: Column) -> Row | None:
        """One row of aggregates of the log; none before the first write."""
        if not folder_exists(self.spark, f"{self.path}/_log"):
            return None
        return self.log().where(condition).agg(*wanted).first()

    def commits(self, after: int = 0) -> list[Row]:
        """Commits after a version, in order; one small row per load."""
        if not folder_exists(self.spark, f"{self.path}/_log"):
            return []
        return sorted(self.log().where(F.col("version") > after).collect(), key=lambda c: c.version)

    def exists(self) -> bool:
        return self.version() > 0

    def version(self) -> int:
        found = self._of_log(F.lit(True), F.max("version"))
        return (found and found[0]) or 0

    def mark(self, column: str) -> str | None:
        """The last stored progress; none before the first load."""
        stored = (F.col("column_name") == column) & F.col("max_value").isNotNull()
        found = self._of_log(stored, F.max_by("max_value", "version"))
        return found and found[0]

    def newest_load(self, prefix: str) -> str | None:
        """The load id of the last commit whose id starts so."""
        found = self._of_log(F.col("load_id").startswith(prefix), F.max_by("load_id", "version"))
        return found and found[0]

    def _folder(self, commit: Row) -> str:
        """Where a commit's rows lie; beside this table's folder, if they were written together with another table's."""
        away = commit.folder.startswith("/") or "://" in commit.folder
        return commit.folder if away else f"{self.path}/{commit.folder}"

    def _scan(self, commits: Sequence[Row], of: set[int] | None = None) -> DataFrame:
        """The rows of some commits in the shape that holds them all; of those in buckets only the ones ``of`` some, if given.

        A bucket's rows are those of the last commit that holds it.

        Commits of one shape are one scan. Where columns came, went or got wider meanwhile, the scans
        are united: a column that a commit lacks is null in its rows.
        """
        shapes = [_shape_of(c) for c in commits]
        whole = common_shape(shapes)
        scans: dict[str, tuple[T.StructType, list[str]]] = {}
        newest = {bucket: i for i, c in enumerate(commits) for bucket in _held(c)}
        for i, (commit, shape) in enumerate(zip(commits, shapes, strict=True)):
            held = _held(commit)
            folders = [f"{self._folder(commit)}/{BUCKET}={b}" for b in held if newest[b] == i and (of is None or b in of)]
            if commit.written and not commit.buckets:
                folders = [self._folder(commit)]
            if folders:
                scans.setdefault(shape.simpleString(), (shape, []))[1].extend(folders)
        parts = [
            _in_shape(self.spark.read.schema(shape).parquet(*folders), whole) for shape, folders in scans.values()
        ]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], whole)

    def _live(self) -> list[Row]:
        """The last full state's commit and those since."""
        found = self._of_log(F.col("mode") == "replace", F.max("version"))
        return self.commits(after=((found and found[0]) or 1) - 1)

    def read(self) -> DataFrame:
        """The last full state and what was appended since."""
        live = self._live()
        if not live:
            raise ValueError(f"no table at {self.path}")
        return self._scan(live)

    def appended_since(self, version: int) -> DataFrame | None:
        """Rows appended after a version; none if nothing came or the table was replaced."""
        later = self.commits(after=version)
        if not later or any(c.mode != "append" for c in later):
            return None
        return self._scan(later)

    def replaced_since(self, version: int) -> bool:
        found = self._of_log((F.col("version") > version) & (F.col("mode") != "append"), F.count("*"))
        return bool(found and found[0])

    def _done(self, load_id: str | None) -> bool:
        found = self._of_log(F.col("load_id") == load_id, F.count("*")) if load_id is not None else None
        return bool(found and found[0])

    def _commit(
        self,
        df: DataFrame,
        mode: str,
        load_id: str | None,
        partition_by: Sequence[str],
        mark: Mark | None,
        even_empty: bool,
    ) -> Load:
        if self._done(load_id):
            return Load(0, False)
        self.accepts(df.schema, mode)
        folder = self.new_folder()
        seen = Observation()
        wanted = [row_count().alias("rows")] + ([mark.metric] if mark and mark.metric is not None else [])
        write_parquet(df, f"{self.path}/{folder}", partition_by=partition_by, observe=(seen, wanted))
        measured = dict(seen.get)
        return self.note(folder, df.schema, mode, measured.pop("rows"), load_id, mark, even_empty, measured)

    def new_folder(self) -> str:
        return f"v{self.version() + 1}-{uuid4().hex}"

    def accepts(self, shape: T.StructType, mode: str) -> None:
        """An error if rows of this shape cannot be appended: a column's type would lose values."""
        if mode == "append":
            common_shape([*[_shape_of(c) for c in self._live()], shape])

    def note(
        self,
        folder: str,
        shape: T.StructType,
        mode: str,
        rows: int,
        load_id: str | None,
        mark: Mark | None,
        even_empty: bool,
        measured: dict[str, object],
        buckets: int | None = None,
        held: str | None = None,
    ) -> Load:
        """Commit rows that were written to a folder of this table, or of one beside it."""
        if rows == 0 and not even_empty:
            return Load(0, False, measured)
        column, value = (mark.column, measured.get("mark", mark.value)) if mark else (None, None)
        row = {
            "version": self.version() + 1,
            "mode": mode,
            "folder": folder,
            "load_id": load_id,
            "written": rows,
            "column_name": column,
            "max_value": value,
            "committed_at": datetime.now(timezone.utc),
            "shape": shape.json(),
            "buckets": buckets,
            "held": held,
        }
        append_row(self.spark, f"{self.path}/_log", row, _COMMIT)
        return Load(rows, True, measured)

    def append(
        self,
        df: DataFrame,
        load_id: str | None = None,
        partition_by: Sequence[str] = (),
        mark: Mark | None = None,
        even_empty: bool = False,
    ) -> Load:
        """Add rows. A load id already seen changes nothing, nor do no rows, unless that is to be noted too."""
        return self._commit(df, "append", load_id, partition_by, mark, even_empty)

    def replace(
        self,
        df: DataFrame,
        load_id: str | None = None,
        partition_by: Sequence[str] = (),
        mark: Mark | None = None,
        even_empty: bool = True,
    ) -> Load:
        """New content, which may be computed from the present one. No rows give an empty table, if wanted."""
        return self._commit(df, "replace", load_id, partition_by, mark, even_empty)

    def merge(
        self,
        incoming: DataFrame,
        keys: Sequence[str],
        newest: Sequence[str] = (),
        load_id: str | None = None,
        mark: Mark | None = None,
        buckets: int = 0,
        competing: bool = False,
    ) -> Load:
        """Upsert by key; the first one only reduces the increment to one row per key.

        With ``buckets`` the rows lie in so many buckets of their key, and only those that the increment meets are read and
        written; the folders of all others stay as they are. A table that lies otherwise is brought into buckets by
        its next merge. Rows of the increment replace those stored, unless ``competing``, when the newest of both stays.
        An empty increment leaves the rows as they are; its load id is noted.
        """
        if self._done(load_id):
            return Load(0, False)
        latest = reduce_increment(incoming, keys, newest)
        if latest.isEmpty():
            return self._commit(latest, "append", load_id, (), mark, load_id is not None)
        if buckets:
            return self._merge_buckets(latest, keys, newest, load_id, mark, buckets, competing)
        return self._commit(self._upserted(latest, keys, newest, competing, self.read() if self.exists() else None), "replace", load_id, (), mark, True)

    def _upserted(self, latest: DataFrame, keys: Sequence[str], newest: Sequence[str], competing: bool, target: DataFrame | None) -> DataFrame:
        if target is None:
            return latest
        shape = common_shape([target.schema, latest.schema])
        target, latest = _in_shape(target, shape), _in_shape(latest, shape)
        return compete(target, latest, keys, newest) if competing else apply_increment(target, latest, keys)

    def _merge_buckets(
        self, latest: DataFrame, keys: Sequence[str], newest: Sequence[str], load_id: str | None, mark: Mark | None, buckets: int, competing: bool
    ) -> Load:
        live = [c for c in self._live() if c.written]
        kinds = {tuple(_shape_of(c)[k].dataType.simpleString() for k in keys) for c in live}
        fits = all(c.buckets == buckets for c in live) and kinds <= {tuple(latest.schema[k].dataType.simpleString() for k in keys)}
        if live and fits:
            # there are ``buckets`` numbers at most
            met = {r[0] for r in latest.select(bucket_of(keys, buckets)).distinct().collect()}
            known = {b for c in live for b in _held(c)}
            target, mode = self._scan(live, met) if met & known else None, "merge"
            self.accepts(latest.schema, "append")
        else:
            target, mode = self.read() if live else None, "replace"
        rows = self._upserted(latest, keys, newest, competing, target)
        folder, seen = self.new_folder(), Observation()
        wanted = [row_count().alias("rows"), F.array_sort(F.collect_set(BUCKET)).alias("held")]
        wanted += [mark.metric] if mark and mark.metric is not None else []
        placed = rows.withColumn(BUCKET, bucket_of(keys, buckets))
        write_parquet(placed, f"{self.path}/{folder}", partition_by=[BUCKET], observe=(seen, wanted), sort_by=keys)
        measured = dict(seen.get)
        held = ",".join(map(str, measured.pop("held")))
        return self.note(folder, rows.schema, mode, measured.pop("rows"), load_id, mark, True, measured, buckets, held)


# Name of the folders that part the rows of one write.
_SIDE = "_aside"


def write_apart(
    table: Table,
    aside: Table,
    rows: DataFrame,
    away: Column,
    columns: Sequence[str],
    aside_columns: Sequence[str],
    modes: tuple[str, str],
    load_id: str | None = None,
    mark: Mark | None = None,
    even_empty: bool = False,
    observe: Sequence[Column] = (),
    sift: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[Load, Load]:
    """One write for two tables: rows where ``away`` holds go to ``aside``, the others to ``table``.

    Both are parts of one folder, so the source is read once, and no row moves. ``mark`` and ``observe`` see all rows. The
    rows aside are committed first: a run repeated after a failure passes them by their load id. With ``sift`` only
    what it leaves of them is kept, written anew.
    """
    if table._done(load_id):
        return Load(0, False), Load(0, False)
    shapes = [rows.select(*[named(c) for c in names]).schema for names in (columns, aside_columns)]
    table.accepts(shapes[0], modes[0])
    aside.accepts(shapes[1], modes[1])
    folder, seen = table.new_folder(), Observation()
    wanted = [F.count_if(~away).alias("rows"), F.count_if(away).alias("away"), *observe]
    wanted += [mark.metric] if mark and mark.metric is not None else []
    rows.observe(seen, *wanted).withColumn(_SIDE, away).write.partitionBy(_SIDE).parquet(f"{table.path}/{folder}", compression=CODEC)
    measured = dict(seen.get)
    kept, apart = measured.pop("rows"), measured.pop("away")
    side = f"{folder}/{_SIDE}=true"
    (home, own), (other, _) = table.path.rsplit("/", 1), aside.path.rsplit("/", 1)
    side = f"../{own}/{side}" if home == other else f"{table.path}/{side}"
    if sift and apart:
        found = sift(table.spark.read.schema(shapes[1]).parquet(f"{table.path}/{folder}/{_SIDE}=true"))
        done = aside._commit(found, modes[1], load_id, (), None, False)
    elif load_id is None or not aside._done(load_id):
        done = aside.note(side, shapes[1], modes[1], apart, load_id, None, modes[1] == "replace" or even_empty, {})
    else:
        done = Load(0, False)
    return table.note(f"{folder}/{_SIDE}=false", shapes[0], modes[0], kept, load_id, mark, even_empty, measured), done
