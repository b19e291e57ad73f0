"""Column transforms given as a list, folded into one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.functions.columns import named, parse_date
from dealtide.functions.types import ddl_type

# One step is a mapping such as {"type": "clean_column", "column": "salesperson"}.
Step = Mapping[str, object]


def _clean(value: Column, step: Step) -> Column:
    return F.trim(value)


def _convert(value: Column, step: Step) -> Column:
    return value.try_cast(ddl_type(str(step["to_type"])))


def _to_date(value: Column, step: Step) -> Column:
    formats = step.get("from_format", "M/d/yyyy")
    return parse_date(value, [formats] if isinstance(formats, str) else list(formats))


# Names of the in-place transforms.
IN_PLACE: dict[str, Callable[[Column, Step], Column]] = {
    "clean_column": _clean,
    "type_conversion": _convert,
    "date_conversion": _to_date,
}


def _find(columns: Mapping[str, Column], wanted: str) -> str | None:
    if wanted in columns:
        return wanted
    return next((c for c in columns if c.lower() == wanted.lower()), None)


def apply_transforms(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Fold ``steps`` left to right; later steps see the results of earlier ones.

    Values that cannot be converted become null. An unknown step is an error.
    Dropping or renaming a column that is absent changes nothing.
    """
    columns = {c: named(c) for c in df.columns}
    for step in steps:
        kind = step.get("type")
        if kind in IN_PLACE:
            target = _find(columns, str(step["column"]))
            if target is None:
                raise ValueError(f"{kind}: no column {step['column']!r}")
            columns[target] = IN_PLACE[kind](columns[target], step)
        elif kind == "drop_column":
            target = _find(columns, str(step["column"]))
            if target is not None:
                del columns[target]
        elif kind == "rename_column":
            source = _find(columns, str(step["from"]))
            columns = {(str(step["to"]) if c == source else c): e for c, e in columns.items()}
        else:
            raise ValueError(f"unknown transform {kind!r}")
    return df.select([e.alias(c) for c, e in columns.items()])
