"""Reading files with declared or inferred columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.functions.columns import named, parse_date, parse_timestamp
from dealtide.functions.types import ddl_type, struct_type

# The file formats a source may declare.
FORMATS = ("csv", "json", "parquet")
TEXT_FORMATS = ("csv", "json")

_PARSED = {"date": parse_date, "timestamp": parse_timestamp}


def _as_text(columns: Mapping[str, str]) -> dict[str, str]:
    """Dates and timestamps are read as text, as a file may mix several layouts."""
    return {c: "string" if ddl_type(t) in _PARSED else t for c, t in columns.items()}


def _parsed(df: DataFrame, columns: Mapping[str, str], also: Sequence[Column] = ()) -> DataFrame:
    return df.select(
        [
            _PARSED[ddl_type(t)](F.trim(named(c))).alias(c) if ddl_type(t) in _PARSED else named(c)
            for c, t in columns.items()
        ]
        + list(also)
    )


# Columns that a read with ``broken`` adds: the record as it stands in the file if it is broken, and what is wrong with it.
RECORD, REASON = "_record", "_reason"


def _record(columns: Mapping[str, str]) -> Column:
    """The broken record. Spark only checks the cells of columns that are read, so this reads all of them, whatever a query selects."""
    return F.when(F.coalesce(*[named(c).cast("string") for c in columns], RECORD).isNotNull(), F.col(RECORD)).alias(RECORD)


def _wrong_cells(cells: Column, columns: Mapping[str, str]) -> list[Column]:
    """For each column whose cell is filled but does not fit the type what it holds."""
    found = []
    for i, (name, kind) in enumerate(columns.items()):
        cell = F.trim(cells.getField(f"c{i}"))
        if ddl_type(kind) not in ("string", *_PARSED):
            fits = F.coalesce(cell, F.lit("")).eqNullSafe("") | named(name).isNotNull()
            found.append(F.when(~fits, F.concat(F.lit(f"{name}: "), cell)))
    return found


def _csv_reason(columns: Mapping[str, str]) -> Column:
    """What is wrong with a broken line, from its cells as text."""
    shape = ", ".join(f"c{i} string" for i in range(len(columns) + 1))
    cells = F.from_csv(F.col(RECORD), F.lit(shape))
    more = F.when(cells.getField(f"c{len(columns)}").isNotNull(), F.lit(f"more than {len(columns)} cells"))
    wrong = F.concat_ws("; ", more, *_wrong_cells(cells, columns))
    return F.when(F.col(RECORD).isNotNull(), F.when(wrong == "", F.lit(f"fewer than {len(columns)} cells")).otherwise(wrong))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Mapping[str, str] | None = None,
    header: bool = True,
    multi_line: bool = False,
    broken: bool = False,
) -> DataFrame:
    """CSV scan. Cells that do not fit their type and empty cells become null.

    With ``broken`` each line that has more or fewer cells than columns, or a cell that does not fit its type, also has its text and
    the reason. Dates are no such cells: they become null, and rules decide.
    Without ``columns`` the types are inferred, which reads the files once more.
    ``multi_line`` allows line breaks inside quotes but makes each file one task, so it
    is off unless the files need it.
    """
    reader = (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .option("nullValue", "")
        .option("multiLine", multi_line)
    )
    if columns is None:
        return reader.option("inferSchema", True).csv(path)
    shape = struct_type(_as_text(columns))
    if not broken:
        return _parsed(reader.schema(shape).csv(path), columns)
    scan = reader.option("columnNameOfCorruptRecord", RECORD).schema(shape.add(RECORD, "string")).csv(path)
    return _parsed(scan, columns, [_record(columns), _csv_reason(columns).alias(REASON)])


def read_source(
    spark: SparkSession,
    file_format: str,
    path: str | list[str],
    columns: Mapping[str, str] | None = None,
    broken: bool = False,
    **csv_options: bool,
) -> DataFrame:
    """Scan in one of the supported formats; any other is an error.

    With ``broken`` records of text files that do not fit ``columns`` keep their text and the reason, in two columns more.
    """
    if broken and (columns is None or file_format not in TEXT_FORMATS):
        raise ValueError("broken records are told by declared columns of csv and json files")
    if file_format == "csv":
        return read_csv(spark, path, columns, broken=broken, **csv_options)
    if file_format == "json":
        if columns is None:
            return spark.read.json(path)
        shape = struct_type(_as_text(columns))
        if not broken:
            return _parsed(spark.read.schema(shape).json(path), columns)
        scan = spark.read.option("columnNameOfCorruptRecord", RECORD).schema(shape.add(RECORD, "string")).json(path)
        reason = F.when(F.col(RECORD).isNotNull(), F.lit("no object of the declared types"))
        return _parsed(scan, columns, [_record(columns), reason.alias(REASON)])
    if file_format == "parquet":
        df = spark.read.parquet(*([path] if isinstance(path, str) else path))
        return df if columns is None else df.select([named(c).cast(ddl_type(t)) for c, t in columns.items()])
    raise ValueError(f"unsupported source format {file_format!r}; known: {', '.join(FORMATS)}")


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables addressable by name in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
