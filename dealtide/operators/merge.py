"""Upsert of an increment into a table by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.functions.columns import all_present, named
from dealtide.scratch import append_row, folder_exists, materialize, scratch_path


def _split_by_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    present = all_present(keys)
    return df.where(present), df.where(~present)


def newest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``newest``, then by all other columns.

    The greatest row is an aggregate, so each task reduces its share of a key before
    the shuffle, however often the key occurs. Rows without a complete key are kept.
    """
    keyed, keyless = _split_by_key(df, keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return keyed.distinct().unionByName(keyless)
    ranked = [*newest, *[c for c in rest if c not in newest]]
    best = F.max(F.struct(*[named(c) for c in ranked])).alias("_best")
    reduced = keyed.groupBy(*[named(k) for k in keys]).agg(best)
    columns = [named(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns]
    return reduced.select(columns).unionByName(keyless)


def _keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[named(k) for k in keys])


def _without(target: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    replaced = _keys_of(latest.where(all_present(keys)), keys)
    return target.join(replaced, list(keys), "left_anti").select(*[named(c) for c in target.columns])


# So many keys of an increment are listed in the filter of the look-up, at most.
_LISTED = 1000


def met_keys(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of the target that ``incoming`` has too, as often as the target has them.

    The increment's keys come first: few of them are a filter that the file scan applies, so that sorted files with Bloom filters are
    mostly skipped; more are written, and their measured size decides whether they are broadcast. So no task holds, sorts or
    aggregates the keys of the target.
    """
    wanted = _keys_of(incoming, keys).where(all_present(keys))
    if len(keys) == 1:
        some = wanted.distinct().limit(_LISTED + 1).collect()
        if len(some) <= _LISTED:
            return _keys_of(target, keys).where(named(keys[0]).isin([r[0] for r in some]))
    return _keys_of(target, keys).join(materialize(wanted, "keys"), list(keys), "left_semi")


def new_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the target lacks."""
    return incoming.join(met_keys(target, incoming, keys), list(keys), "left_anti")


def updating_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the target has; never multiplied by duplicates there."""
    return incoming.join(met_keys(target, incoming, keys), list(keys), "left_semi")


def reduce_increment(incoming: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """The increment with one row per key, written once.

    It is used twice by a merge, and its measured size tells Spark whether its keys can
    be broadcast, which leaves a large target unshuffled.
    """
    return materialize(newest_per_key(incoming, keys, newest), "increment")


def apply_increment(target: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rows that a reduced increment replaces, plus the increment."""
    return _without(target, latest, keys).unionByName(latest)


def compete(target: DataFrame, latest: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Both together with one row per key, the newest, whichever side it is on. The target is read once."""
    return newest_per_key(target.unionByName(latest), keys, newest)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key; the same for whole numbers of any width."""
    return F.pmod(F.xxhash64(*[named(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def merge_rows(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str] = (),
) -> DataFrame:
    """Target after the upsert: the last writer of a key wins.

    A row without a complete key cannot replace anything and is added as it is.
    """
    return apply_increment(target, reduce_increment(incoming, keys, newest), keys)


# Log of partition merges below the table: what was written aside, and whether it is in place.
_MERGES = "aside string, done boolean"


def _put_in_place(merged: DataFrame, path: str, aside: str, partition_by: Sequence[str]) -> None:
    spark = merged.sparkSession
    (
        merged.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    append_row(spark, f"{path}/_merges", {"aside": aside, "done": True}, _MERGES)


def finish_merges(target: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Put in place what an interrupted ``merge_partitions`` of ``path`` left aside; the scan to go on with."""
    spark = target.sparkSession
    if not folder_exists(spark, f"{path}/_merges"):
        return target
    log = spark.read.schema(_MERGES).parquet(f"{path}/_merges")
    # one writer at a time, so one entry at most
    waiting = log.groupBy("aside").agg(F.bool_or("done").alias("done")).where("NOT done").collect()
    for entry in waiting:
        _put_in_place(spark.read.schema(target.schema).parquet(entry.aside), path, entry.aside, partition_by)
    return spark.read.schema(target.schema).parquet(path) if waiting else target


def merge_partitions(
    target: DataFrame,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    newest: Sequence[str] = (),
) -> None:
    """Upsert that rewrites only those partitions of ``path`` that the increment meets.

    ``target`` is the scan of ``path``. The partition columns must be part of the key,
    so that a row never changes its partition. The new partitions are written aside, and
    that is logged, before they replace the old ones. After a failure the same call can be
    repeated: it first finishes what the log shows as waiting, so no row is lost even if
    a partition was already deleted. Until then readers may miss that partition.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    target = finish_merges(target, path, partition_by)
    spark = target.sparkSession
    latest = reduce_increment(incoming, keys, newest)
    met = _keys_of(latest, partition_by).distinct()
    affected = target.join(met, list(partition_by), "left_semi")
    merged = apply_increment(affected, latest, keys)
    aside = scratch_path(spark, "merged")
    merged.write.parquet(aside)
    append_row(spark, f"{path}/_merges", {"aside": aside, "done": False}, _MERGES)
    _put_in_place(spark.read.schema(merged.schema).parquet(aside), path, aside, partition_by)
