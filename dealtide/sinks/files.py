"""Parquet and CSV output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dealtide.scratch import CODEC


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    observe: tuple[Observation, Sequence[Column]] | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """Parquet files, in a folder per value of ``partition_by`` where given.

    With ``sort_by`` files are sorted by these columns and hold Bloom filters of them, so a look-up of some values
    skips most row groups by their bounds and most others by the filters.

    Rows are first brought together by these values with a rebalance: AQE merges the
    small shares and splits a value that holds too much for one task, so there are
    neither many small files nor one very large one.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*[F.col(f"`{c}`") for c in (*partition_by, *sort_by)])
    if observe:
        df = df.observe(observe[0], *observe[1])
    writer = df.write.mode(mode)
    for column in sort_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path, compression=CODEC)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = (), codec: str | None = None) -> None:
    """CSV files, in a folder per value of ``partition_by`` where given; no row moves. A file compressed by gzip is read by one task."""
    writer = df.write.mode(mode).option("header", True).option("emptyValue", "")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path, compression=codec)


def export_reports(
    reports: Mapping[str, DataFrame],
    folder: str,
    stamp: str | None = None,
) -> dict[str, str]:
    """One CSV folder ``<name>_<stamp>`` per report; empty reports are left out.

    For report tables only: each has at most one row per group or a fixed number of
    rows, and is kept in memory between the check and the write. AQE merges such small
    results into one file.
    """
    stamp = stamp or datetime.now().strftime("%Y%m%d_%H%M%S")
    written = {}
    for name, df in reports.items():
        held = df.persist()
        try:
            if not held.isEmpty():
                written[name] = f"{folder.rstrip('/')}/{name}_{stamp}"
                write_csv(held, written[name])
        finally:
            held.unpersist()
    return written
