"""Column expressions shared by the plans. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Funnel order of the opportunity stages.
STAGES = ("Lead", "Prospect", "Qualified", "Contracting", "Closed Won", "Closed Lost")
WON = "Closed Won"
LOST = "Closed Lost"

# The date and timestamp layouts accepted in source files, tried in this order.
DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd", "MM/dd/yyyy", "d/M/yyyy")
TIMESTAMP_FORMATS = ("M/d/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss")

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"


def named(column: str) -> Column:
    """Column by name, also when the name holds spaces or dots."""
    return F.col("`" + column.replace("`", "``") + "`")


def parse_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First layout that fits; null if none does."""
    return F.coalesce(*[F.try_to_date(value, f) for f in formats])


def parse_timestamp(value: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in formats])


def all_present(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [named(c).isNotNull() for c in columns], F.lit(True))


def surrogate_key(*values: Column, kind: str = "md5") -> Column:
    """Key of a dimension row, the same wherever it is computed.

    ``md5`` does not collide at any realistic size; ``xxhash64`` takes a quarter of
    the space and suits dimensions below some ten million rows.
    """
    if kind == "xxhash64":
        return F.xxhash64(*values)
    if kind != "md5":
        raise ValueError(f"unknown key kind {kind!r}")
    texts = [v.cast("string") for v in values]
    if len(texts) == 1:
        return F.md5(texts[0])
    # length prefixes keep ('ab', 'c') and ('a', 'bc') apart, and null differs from ''
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", *parts))


def stage_rank(stage: Column) -> Column:
    ranked = F.when(stage == STAGES[0], 1)
    for position, name in enumerate(STAGES[1:], start=2):
        ranked = ranked.when(stage == name, position)
    return ranked.otherwise(len(STAGES) + 1)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two digits, null when the whole is zero."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole, F.lit(0)).cast("double"), 2)


def money_total(value: Column) -> Column:
    return F.sum(value).cast(MONEY_SUM)


def cycle_days() -> Column:
    return F.datediff("target_close", "sale_date")


def is_won() -> Column:
    return F.col("closed_opportunity") & (F.col("opportunity_stage") == WON)


def is_lost() -> Column:
    return F.col("closed_opportunity") & (F.col("opportunity_stage") == LOST)


def row_count() -> Column:
    return F.count(F.lit(1))


def won_revenue() -> Column:
    """Revenue of the won stage; the closed flag does not matter here."""
    revenue = F.col("forecasted_monthly_revenue")
    return F.sum(F.when(F.col("opportunity_stage") == WON, revenue).otherwise(F.lit(0))).cast(MONEY_SUM)
