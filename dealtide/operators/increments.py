"""High-watermark increments and the group-wise refresh that follows them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.functions.columns import named
from dealtide.scratch import materialize

# Bits of a filter of groups: so many for each group, in all so many at least and at most. Spark's bitmaps have 4 KB each.
FILTER_BITS, LEAST_BITS, MOST_BITS, _BITMAP = 8, 1 << 15, 1 << 28, 15


def increment(
    df: DataFrame, column: str, watermark: str | None, lookback_days: int = 0, also: Column | None = None
) -> DataFrame:
    """Rows past the watermark, compared in the type of the column, and those for which ``also`` holds.

    Without a watermark all rows pass. ``lookback_days`` also admits late rows; a later
    merge by key absorbs those seen before. The bound is a literal of the column's own
    type, so the filter reaches the file scan.
    """
    if watermark is None:
        return df
    kind = df.schema[column].dataType.simpleString()
    bound: Column = F.lit(watermark).cast(kind)
    if lookback_days:
        bound = (bound - F.expr(f"INTERVAL {int(lookback_days)} DAYS")).cast(kind)
    past = named(column) > bound
    return df.where(past if also is None else F.coalesce(past, F.lit(False)) | also)


def watermark_row(df: DataFrame, table_name: str, column: str) -> DataFrame:
    """The greatest value of a column as a watermark row; no row if there is none."""
    return (
        df.agg(F.max(named(column)).cast("string").alias("max_value"))
        .where("max_value IS NOT NULL")
        .select(F.lit(table_name).alias("table_name"), F.lit(column).alias("column_name"), "max_value")
    )


def upsert_watermarks(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Control table after the updates, one row per table and column."""
    moved = updates.where("max_value IS NOT NULL")
    keys = ["table_name", "column_name"]
    return current.join(moved.select(*keys), keys, "left_anti").unionByName(moved)


def _join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    wanted = groups.select(*[named(k).alias(f"_g_{k}") for k in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & named(k).eqNullSafe(named(f"_g_{k}"))
    return df.join(wanted, condition, how)


def rows_of_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that belong to the listed groups; a null is a group of its own."""
    return _join_groups(df, groups, keys, "left_semi")


def rows_outside_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that belong to none of the listed groups."""
    return _join_groups(df, groups, keys, "left_anti")


class GroupFilter:
    """Tells the rows that are surely of none of the groups that some rows have, by a bit for the hash of each group. The bits
    are broadcast; they are 32 MB at most.

    It may take other groups for these: up to one in eight, more with over 2^25 ``rows``. These are read twice.
    """

    def __init__(self, rows: DataFrame, keys: Sequence[str]) -> None:
        self.kinds = [rows.schema[k].dataType.simpleString() for k in keys]
        self.size = min(MOST_BITS, max(LEAST_BITS, 1 << (FILTER_BITS * rows.count()).bit_length()))
        bitmap, bit = self._place(keys)
        # two numbers for each row are shuffled, not a bitmap for each task
        bits = rows.select(bitmap.alias("_bitmap"), bit.alias("_bit")).repartition("_bitmap")
        self.bitmaps = materialize(bits.groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "filter")

    def _place(self, keys: Sequence[str]) -> tuple[Column, Column]:
        """The bitmap that the group of a row belongs to, and its bit there."""
        place = F.pmod(F.xxhash64(*[named(k).cast(kind) for k, kind in zip(keys, self.kinds, strict=True)]), F.lit(self.size))
        return F.shiftright(place, _BITMAP), place.bitwiseAND(F.lit((1 << _BITMAP) - 1))

    def _join(self, df: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
        bitmap, bit = self._place(keys)
        byte = F.conv(F.hex(F.substr(F.col("_bits"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.call_function("bit_get", byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1
        return df.join(F.broadcast(self.bitmaps), (bitmap == F.col("_bitmap")) & is_set, how)

    def passing(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """All rows of the groups, and all of some others."""
        return self._join(df, keys, "left_semi")

    def outside(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The other rows, none of which is of the groups."""
        return self._join(df, keys, "left_anti")


def replace_groups(current: DataFrame, rebuilt: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aggregate table in which the listed groups give way to ``rebuilt``."""
    return rows_outside_groups(current, groups, keys).unionByName(rebuilt)
