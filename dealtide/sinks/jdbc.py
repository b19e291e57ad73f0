"""Reading and writing a serving database through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# SQL column types of the serving database.
_SQL_TYPES = {
    T.StringType: "TEXT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE PRECISION",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP",
}


def sql_column_types(schema: T.StructType) -> dict[str, str]:
    """SQL types for the columns of a table."""
    found = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            found[f.name] = f"DECIMAL({f.dataType.precision},{f.dataType.scale})"
        elif type(f.dataType) in _SQL_TYPES:
            found[f.name] = _SQL_TYPES[type(f.dataType)]
        else:
            raise ValueError(f"no SQL type for {f.name} {f.dataType.simpleString()}")
    return found


def write_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    connections: int = 8,
    batch_size: int = 10_000,
    replace: bool = False,
    column_types: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a parallel, batched write.

    ``connections`` bounds the load on the database, however large the cluster is. A
    replace empties the table and keeps its definition, grants and indexes.
    """
    options = {"url": url, "dbtable": table, "numPartitions": str(connections), "batchsize": str(batch_size)}
    if replace:
        options["truncate"] = "true"
    if column_types:
        options["createTableColumnTypes"] = ", ".join(f"`{c}` {t}" for c, t in column_types.items())
    given = {"user": user, "password": password, "driver": driver}
    return options | {k: v for k, v in given.items() if v is not None}


def spread(df: DataFrame, options: Mapping[str, str]) -> DataFrame:
    """The rows shuffled to as many partitions as connections.

    The writer would otherwise coalesce to that number without a shuffle, and the plan that makes
    the rows would run in so few tasks.
    """
    return df.repartition(int(options["numPartitions"]))


def write_table(df: DataFrame, url: str, table: str, replace: bool = False, **options: object) -> None:
    """Append to a table or replace its rows."""
    prepared = write_options(url, table, replace=replace, **options)
    spread(df, prepared).write.format("jdbc").options(**prepared).mode("overwrite" if replace else "append").save()


def stage_upsert(df: DataFrame, url: str, table: str, **options: object) -> str:
    """Write the increment to ``<table>_temp``; the database merges it from there.

    Returns the name of the staging table. The merge of the lake copy is
    :func:`dealtide.operators.merge.merge_rows`.
    """
    staging = f"{table}_temp"
    prepared = write_options(url, staging, **options)
    spread(df, prepared).write.format("jdbc").options(**prepared).mode("overwrite").save()
    return staging


def upsert_statement(table: str, staging: str, columns: Sequence[str], key: str) -> str:
    """Statement with which the database merges a staging table into its table."""

    def quoted(name: str) -> str:
        return '"' + name.replace('"', '""') + '"'

    every = ", ".join(quoted(c) for c in columns)
    changes = ", ".join(f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in columns if c != key)
    action = f"UPDATE SET {changes}" if changes else "NOTHING"
    return (
        f"INSERT INTO {table} ({every}) SELECT {every} FROM {staging} "
        f"ON CONFLICT ({quoted(key)}) DO {action}"
    )


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    one_task: bool = False,
    **options: str,
) -> DataFrame:
    """Scan of a table, split by the ranges of a column.

    Without column, bounds and number of ranges one task would read all; that has to be asked for.
    """
    if not (partition_column and bounds and partitions) and not one_task:
        raise ValueError("give partition_column, bounds and partitions, or one_task=True for a small table")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column and bounds and partitions:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def copy_lake_to_database(spark: SparkSession, folder: str, url: str, table: str, **options: object) -> None:
    """Bulk copy of Parquet files into a table, in parallel batches."""
    write_table(spark.read.parquet(folder), url, table, **options)
