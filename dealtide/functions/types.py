"""Declared type names and the Spark types they stand for."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

# The type names a source may declare.
TYPE_NAMES = {
    "string": "string",
    "str": "string",
    "text": "string",
    "varchar": "string",
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "int64": "bigint",
    "bigint": "bigint",
    "double": "double",
    "float": "double",
    "decimal": "decimal(18,2)",
    "numeric": "decimal(18,2)",
    "boolean": "boolean",
    "bool": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "datetime": "timestamp",
}

_SIZED_DECIMAL = re.compile(r"(?:decimal|numeric)\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)")


_PLAIN: dict[str, T.DataType] = {
    t.simpleString(): t
    for t in (
        T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType(),
    )
}


def ddl_type(name: str) -> str:
    """DDL text for a declared type; names are not case sensitive."""
    wanted = name.strip().lower()
    sized = _SIZED_DECIMAL.fullmatch(wanted)
    if sized:
        return f"decimal({sized[1]},{sized[2]})"
    if wanted not in TYPE_NAMES:
        raise ValueError(f"unknown column type {name!r}")
    return TYPE_NAMES[wanted]


def spark_type(name: str) -> T.DataType:
    ddl = ddl_type(name)
    sized = _SIZED_DECIMAL.fullmatch(ddl)
    return T.DecimalType(int(sized[1]), int(sized[2])) if sized else _PLAIN[ddl]


def struct_type(columns: Mapping[str, str]) -> T.StructType:
    """Nullable fields, in the order declared."""
    return T.StructType([T.StructField(c, spark_type(t), True) for c, t in columns.items()])


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both unchanged; none if there is no such type."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    names = {a.simpleString(), b.simpleString()}
    if names <= set(_DIGITS):
        return max(a, b, key=_WHOLE.index)
    if names <= {"float", "double"} or ("double" in names and names <= {"double", "int", "smallint", "tinyint"}):
        return T.DoubleType()
    if names == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    digits = []
    for t in (a, b):
        if isinstance(t, T.DecimalType):
            digits.append((t.precision - t.scale, t.scale))
        elif t.simpleString() in _DIGITS:
            digits.append((_DIGITS[t.simpleString()], 0))
    if len(digits) == 2:
        before, after = max(d[0] for d in digits), max(d[1] for d in digits)
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    return None


def common_shape(shapes: Sequence[T.StructType]) -> T.StructType:
    """All columns of the shapes in the order they appear, each in the type that holds the values of all; else an error."""
    found: dict[str, T.DataType] = {}
    for shape in shapes:
        for column in shape:
            before = found.get(column.name, column.dataType)
            kind = wider(before, column.dataType)
            if kind is None:
                raise ValueError(f"column {column.name!r}: {column.dataType.simpleString()} does not go with {before.simpleString()}")
            found[column.name] = kind
    return T.StructType([T.StructField(name, kind, True) for name, kind in found.items()])
