"""Repeated increments as a stream: each run takes the files that are new, then stops."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.functions.columns import all_present, named
from dealtide.sources.tables import Table


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "parquet",
    max_bytes_per_batch: int | None = None,
    **options: object,
) -> DataFrame:
    """Stream over the files of a folder. A byte limit splits a backlog into batches."""
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if max_bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    return reader.load(folder)


def run_available(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, output: str = "append"
) -> None:
    """Process all that is new since the last run with this checkpoint, then stop."""
    query = (
        stream.writeStream.outputMode(output)
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def merge_stream(
    stream: DataFrame,
    table: Table,
    keys: Sequence[str],
    newest: Sequence[str],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    buckets: int = 0,
) -> None:
    """Upsert new files into a table, newest row per key winning across batches too.

    A batch's rows compete with those the table has, so that a late file cannot undo a newer state; the table, or with
    ``buckets`` the part of it that the batch meets, is read once. A batch repeated after a failure carries the same load id and
    changes nothing.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = f"{checkpoint}#{batch_id}"
        table.merge(prepare(batch), keys, newest, load_id=load_id, buckets=buckets, competing=True)

    run_available(stream, on_batch, checkpoint)


def newest_stream(
    stream: DataFrame,
    table: Table,
    keys: Sequence[str],
    newest: Sequence[str],
    checkpoint: str,
    buckets: int = 0,
) -> None:
    """The same for a table that only this stream fills, with the newest row of each key in Spark's state store.

    A batch gives the keys it touched with their newest rows of all batches, so nothing of the table competes: only the buckets
    met are read, to keep their other keys. Late files need no watermark; the state has one row per key, which for many
    keys belongs into a state store on disk (``spark.sql.streaming.stateStore.providerClass``). Rows without
    a complete key have no state and are left out.
    """
    rest = [c for c in stream.columns if c not in keys]
    ranked = [*newest, *[c for c in rest if c not in newest]]
    best = F.max(F.struct(*[named(c) for c in ranked])).alias("_best")
    found = stream.where(all_present(keys)).groupBy(*[named(k) for k in keys]).agg(best)
    rows = found.select([named(c) if c in keys else F.col("_best").getField(c).alias(c) for c in stream.columns])

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, keys, newest, load_id=f"{checkpoint}#{batch_id}", buckets=buckets)

    run_available(rows, on_batch, checkpoint, "update")


def append_stream(
    stream: DataFrame,
    table: Table,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Append new files to a table, each batch once."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table.append(prepare(batch), load_id=f"{checkpoint}#{batch_id}")

    run_available(stream, on_batch, checkpoint)
