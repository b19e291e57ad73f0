"""Looking at tables: preview, overview by layer, profile of a source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.functions.columns import named, row_count

# Layers of the warehouse in their display order.
LAYERS = ("Bronze", "Silver", "Gold", "Other")


def preview(df: DataFrame, limit: int = 10, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First rows of a table, each with the table's row count and column names."""
    total = df.select(row_count()).scalar()
    shown = (df.orderBy(*order_by) if order_by else df).limit(limit)
    return shown.select(
        total.alias("total_rows"),
        F.lit(", ".join(df.columns)).alias("column_names"),
        *[named(c) for c in df.columns],
    )


def layer_of(table_name: str) -> str:
    """Layer by the prefix of the table name or its database."""
    database, _, plain = table_name.rpartition(".")
    for layer in LAYERS[:-1]:
        if database.lower() == layer.lower() or plain.lower().startswith(layer.lower() + "_"):
            return layer
    return LAYERS[-1]


def overview(tables: Mapping[str, DataFrame], layer: str | None = None) -> DataFrame:
    """One row per table: layer, number of rows, first three column names.

    Each count is one distributed aggregate that reads no column.
    """
    lines = []
    for name, df in tables.items():
        its_layer = layer_of(name)
        if layer is not None and its_layer.lower() != layer.lower():
            continue
        shown = ", ".join(df.columns[:3]) + ("..." if len(df.columns) > 3 else "")
        lines.append(
            df.agg(row_count().alias("row_count")).select(
                F.lit(LAYERS.index(its_layer) + 1).cast("bigint").alias("layer_rank"),
                F.lit(its_layer).alias("layer"),
                F.lit(name.rpartition(".")[2]).alias("table_name"),
                "row_count",
                F.lit(shown).alias("column_preview"),
            )
        )
    if not lines:
        raise ValueError(f"no tables in layer {layer!r}" if layer else "no tables")
    return reduce(DataFrame.unionAll, lines).orderBy("layer_rank", "table_name")


def samples(tables: Mapping[str, DataFrame], rows: int = 3, columns: int = 5) -> dict[str, DataFrame]:
    """A few rows of the first columns of each table."""
    return {name: df.select([named(c) for c in df.columns[:columns]]).limit(rows) for name, df in tables.items()}


def catalog_tables(spark: SparkSession, databases: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Tables and views of the session catalog, by name."""
    found = {}
    for database in databases or (None,):
        for t in spark.catalog.listTables(database) if database else spark.catalog.listTables():
            name = t.name if t.isTemporary or not t.namespace else f"{t.namespace[-1]}.{t.name}"
            found[name] = spark.table(name)
    return found


def profile(df: DataFrame) -> DataFrame:
    """Column names and types of a source with its row count, one row per column."""
    described = F.array(
        *[
            F.struct(
                F.lit(i).cast("bigint").alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
            )
            for i, f in enumerate(df.schema.fields, start=1)
        ]
    )
    return df.agg(row_count().alias("total_rows")).select(F.inline(described), "total_rows")
