"""Intermediate tables in the shared folder that the cluster names, and log rows.

A written table cuts the lineage and, unlike a local checkpoint, outlives the
loss of any executor. Folders are unique per call and follow the lifetime of the
checkpoint folder, as Spark's own checkpoints do.
"""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="dealtide-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system itself, so that a missing folder is no failed query."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def append_row(spark: SparkSession, path: str, row: Mapping[str, object], shape: str) -> None:
    """Add one row to a log. It is built from literals, without a Python worker."""
    columns = [c.strip().split(" ") for c in shape.split(",")]
    literals = [F.lit(row.get(name)).cast(kind).alias(name) for name, kind in columns]
    spark.range(1, numPartitions=1).select(*literals).write.mode("append").parquet(path)


# Codec of the tables' files: keys are long texts of few symbols, of which Spark's default codec saves nothing.
CODEC = "zstd"


def materialize(df: DataFrame, label: str, codec: str | None = CODEC) -> DataFrame:
    """Write ``df`` once and return the scan of what was written. Without ``codec`` the session's is used.

    The scan carries its true size, so Spark decides about broadcasting it on a
    measured figure and not on an estimate.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
