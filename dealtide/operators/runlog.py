"""Run log as append-only rows; the state of a run is the newest row about it."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.scratch import append_row

RUNNING, COMPLETED, FAILED = "RUNNING", "COMPLETED", "FAILED"
# A full load whose source had no rows; the table keeps its content.
EMPTY = "EMPTY_SOURCE"

LOG_SCHEMA = (
    "run_id string, pipeline_id string, source_name string, destination_name string, "
    "event_time timestamp, status string, records_processed bigint, error string, "
    "load_type string, metadata string"
)

# Keys of the increment note kept with a run.
INCREMENT_NOTE = "incremental_column string, last_timestamp string, filtered_records boolean"


def increment_note(column: str, last: str | None, filtered: bool, **counts: int) -> str | None:
    """Note about the increment of a run and rows it left aside; none if no filter was applied and none were."""
    note: dict[str, object] = {name: n for name, n in counts.items() if n}
    if filtered:
        note = {"incremental_column": column, "last_timestamp": last, "filtered_records": True, **note}
    return json.dumps(note) if note else None


class RunLog:
    """Writer of run rows into one folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _append(self, row: Mapping[str, object]) -> None:
        append_row(self.spark, self.path, {**row, "event_time": datetime.now(timezone.utc)}, LOG_SCHEMA)

    def start(self, pipeline_id: str, source: str, destination: str, load_type: str = "full") -> dict[str, object]:
        run = {
            "run_id": uuid4().hex,
            "pipeline_id": pipeline_id,
            "source_name": source,
            "destination_name": destination,
            "load_type": load_type,
        }
        self._append({**run, "status": RUNNING, "records_processed": 0})
        return run

    def complete(self, run: Mapping[str, object], records: int, metadata: str | None = None) -> None:
        self._append({**run, "status": COMPLETED, "records_processed": records, "metadata": metadata})

    def fail(self, run: Mapping[str, object], error: str, records: int = 0) -> None:
        self._append({**run, "status": FAILED, "records_processed": records, "error": error})

    def empty(self, run: Mapping[str, object], error: str) -> None:
        self._append({**run, "status": EMPTY, "records_processed": 0, "error": error})

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)


def run_state(log: DataFrame) -> DataFrame:
    """One row per run: first row gives the start, newest row everything else.

    ``event_time`` orders the rows; among equal times a final status wins, then the
    greatest row, so the result does not depend on the order of the log.
    """
    carried = [
        "status", "records_processed", "error", "load_type", "metadata",
        "pipeline_id", "source_name", "destination_name",
    ]
    last = F.struct("event_time", (F.col("status") != RUNNING).alias("final"), *carried)
    state = log.groupBy("run_id").agg(F.min("event_time").alias("start_time"), F.max(last).alias("last"))
    final = F.col("last.final")
    end_time = F.when(final, F.col("last.event_time"))
    seconds = (F.unix_micros("end_time") - F.unix_micros("start_time")) / 1e6
    return (
        state.select(
            "run_id", "last.pipeline_id", "last.source_name", "last.destination_name", "start_time",
            end_time.alias("end_time"), "last.records_processed", "last.status", "last.error",
            "last.load_type", "last.metadata",
        )
        .withColumn("duration_seconds", seconds)
    )


def run_history(state: DataFrame, pipeline_id: str | None = None, limit: int = 10) -> DataFrame:
    """Newest runs first, with the increment note unpacked."""
    if pipeline_id is not None:
        state = state.where(F.col("pipeline_id") == pipeline_id)
    note = F.from_json("metadata", INCREMENT_NOTE)
    return (
        state.withColumn("note", note)
        .select("*", "note.incremental_column", "note.last_timestamp", "note.filtered_records")
        .drop("note")
        .orderBy(F.col("start_time").desc_nulls_last(), "run_id")
        .limit(limit)
    )
