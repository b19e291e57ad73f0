"""Dense row numbers 1..n in a global order, without one task for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealtide.scratch import materialize

# Fixed value: monotonically_increasing_id() keeps the row's place within its
# partition in the lower 33 bits and the partition number above them.
_PLACE_BITS = 33

# Rows are counted by so many values of a hash, to find those that may have more copies than that.
_BINS = 1 << 16

# Copies of a row up to this many are numbered one by one where they lie; more are numbered as one row first.
COPIES = 1 << 20


def _placed(ordered: DataFrame) -> DataFrame:
    """The rows of a sorted plan, written once with the number of their partition and their place in it."""
    slot = F.monotonically_increasing_id()
    slotted = ordered.select("*", slot.alias("_slot"))
    return materialize(
        slotted.select(
            *ordered.columns,
            F.shiftright("_slot", _PLACE_BITS).alias("_part"),
            F.col("_slot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
        ),
        "ordered",
    )


def number_rows(
    df: DataFrame,
    id_name: str,
    order_by: Sequence[str | Column],
    *,
    rows_unique: bool = False,
    after: int = 0,
    copies: int = COPIES,
) -> DataFrame:
    """The numbers ``row_number() OVER (ORDER BY order_by, all other columns)`` plus ``after``, as a first column.

    Rows are range-partitioned and sorted, written once together with
    their place in the partition, and shifted by the rows of all partitions before.
    Only that list of partition sizes, one row per partition, meets in one task and is
    broadcast.

    Unless rows are known to be unique, those that may have more than ``copies`` copies are found first: rows are counted by bins of
    a hash, and only rows of bins with more are counted as they are, which each task does for its share; they
    are told out again behind the sort. All others go through one shuffle. A row with more than ``copies`` copies stays one row until
    all have their numbers; its copies are then dealt out in blocks. There are few such rows, and they
    are part of the broadcast list.
    """
    names = df.columns
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if rows_unique:
        placed = _placed(df.repartitionByRange(*keys).sortWithinPartitions(*keys)).withColumn("_copies", F.lit(1).cast("bigint"))
    else:
        given = {c for c in order_by if isinstance(c, str)}
        keys += [F.col(f"`{c}`") for c in names if c not in given]
        columns = [F.col(f"`{c}`") for c in names]
        of = F.pmod(F.xxhash64(*columns), F.lit(_BINS))
        full = [r[0] for r in df.groupBy(of.alias("_bin")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > copies).collect()]
        counted = df.select(*columns, F.lit(1).cast("bigint").alias("_n"))
        if full:
            often = df.where(of.isin(full)).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
            counted = counted.where(~of.isin(full)).unionByName(often)
        ordered = counted.repartitionByRange(*keys).sortWithinPartitions(*keys)
        few = F.col("_n") <= copies
        # a generator keeps the order of the rows it tells out
        told = ordered.select(*names, F.explode(F.when(few, F.array_repeat(F.lit(1).cast("bigint"), F.col("_n").cast("int"))).otherwise(F.array("_n"))).alias("_copies"))
        placed = _placed(told)

    many = F.col("_copies") > 1
    held = F.collect_list(F.when(many, F.struct(F.col("_place").alias("place"), (F.col("_copies") - 1).alias("more"))))
    sizes = placed.groupBy("_part").agg(F.sum("_copies").alias("_size"), held.alias("_held"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", "_held", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    shifted = placed.join(F.broadcast(starts), "_part")
    passed = F.aggregate(F.filter("_held", lambda h: h["place"] < F.col("_place")), F.lit(0).cast("bigint"), lambda a, h: a + h["more"])
    number = F.col("_start") + F.col("_place") + 1 + F.when(F.size("_held") > 0, passed).otherwise(0) + after
    numbered = shifted.select(number.alias(id_name), *names, "_copies")
    single = numbered.where(~many).drop("_copies")
    if rows_unique:
        return single
    blocks = numbered.where(many).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(copies).cast("bigint"))))
    block = F.sequence(F.col("_from"), F.least(F.col("_from") + copies, "_copies") - 1)
    told = blocks.repartition(id_name, "_from").withColumn("_from", F.explode(block))
    return single.unionByName(told.withColumn(id_name, F.col(id_name) + F.col("_from")).select(id_name, *names))
