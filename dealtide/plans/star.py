"""Star schema: four dimensions, one fact, and the join back through the keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.functions.columns import all_present, cycle_days, named, surrogate_key
from dealtide.operators.numbering import number_rows


def dim_salesperson(sales: DataFrame, key_kind: str = "md5") -> DataFrame:
    people = sales.select("salesperson").where("salesperson IS NOT NULL").distinct()
    return people.select(
        surrogate_key(F.col("salesperson"), kind=key_kind).alias("salesperson_id"),
        F.col("salesperson").alias("salesperson_name"),
    )


def lead_key(by: str = "name", key_kind: str = "md5") -> Column:
    """Key of a lead: from its name, or from name, segment and region together.

    By name the key repeats in the dimension when a lead changes segment or region.
    """
    if by == "name":
        return surrogate_key(F.col("lead_name"), kind=key_kind)
    if by == "triple":
        return surrogate_key(F.col("lead_name"), F.col("segment"), F.col("region"), kind=key_kind)
    raise ValueError(f"lead key by {by!r}")


def dim_lead(sales: DataFrame, key_by: str = "name", key_kind: str = "md5") -> DataFrame:
    leads = sales.select("lead_name", "segment", "region").where("lead_name IS NOT NULL").distinct()
    return leads.select(lead_key(key_by, key_kind).alias("lead_id"), "lead_name", "segment", "region")


def dim_date(sales: DataFrame, key_kind: str = "md5") -> DataFrame:
    dates = sales.select(F.col("sale_date").alias("date_value")).where("date_value IS NOT NULL").distinct()
    parts = {"year": F.year, "month": F.month, "day": F.day, "quarter": F.quarter, "day_of_week": F.dayofweek}
    return dates.select(
        surrogate_key(F.col("date_value"), kind=key_kind).alias("date_id"),
        "date_value",
        *[part("date_value").cast("bigint").alias(name) for name, part in parts.items()],
    )


def dim_stage(sales: DataFrame, key_kind: str = "md5") -> DataFrame:
    stages = sales.select("opportunity_stage").where("opportunity_stage IS NOT NULL").distinct()
    return stages.select(
        surrogate_key(F.col("opportunity_stage"), kind=key_kind).alias("stage_id"),
        F.col("opportunity_stage").alias("stage_name"),
    )


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; an empty result means the key is unique."""
    return dimension.groupBy(named(key)).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def unique_by(dimension: DataFrame, key: str, otherwise: str) -> DataFrame:
    """``dimension``; a key that occurs more than once is an error of the query that reads it.

    The check is a subquery of that query, so the plan around it stays as it is.
    """
    counted = dimension.groupBy(named(key)).agg(F.count(F.lit(1)).alias("occurrences"))
    most = counted.agg(F.max("occurrences")).scalar()
    return dimension.where(F.when(most > 1, F.raise_error(F.lit(otherwise)).cast("boolean")).otherwise(F.lit(True)))


# Measures and flags of the fact, in table order.
FACT_VALUES = (
    "forecasted_monthly_revenue",
    "weighted_revenue",
    "closed_opportunity",
    "active_opportunity",
    "latest_status_entry",
)


FACT_REQUIRED = ("lead_name", "sale_date", "salesperson", "opportunity_stage")


def _fact_columns(key_by: str, key_kind: str) -> list[Column]:
    return [
        surrogate_key(F.col("sale_date"), kind=key_kind).alias("date_id"),
        lead_key(key_by, key_kind).alias("lead_id"),
        surrogate_key(F.col("salesperson"), kind=key_kind).alias("salesperson_id"),
        surrogate_key(F.col("opportunity_stage"), kind=key_kind).alias("stage_id"),
        F.col("target_close").alias("target_close_date"),
        *[F.col(c) for c in FACT_VALUES],
        cycle_days().cast("bigint").alias("sales_cycle_days"),
    ]


def fact_rows(sales: DataFrame, key_by: str = "name", key_kind: str = "md5") -> DataFrame:
    """The fact without its row number: lazy, one narrow pass over the sales."""
    return sales.where(all_present(FACT_REQUIRED)).select(_fact_columns(key_by, key_kind))


def numbered_facts(sales: DataFrame) -> DataFrame:
    """The sales that become facts."""
    return sales.where(all_present(FACT_REQUIRED))


def fact_sales(
    sales: DataFrame,
    tie_break: Sequence[str] = (),
    key_by: str = "name",
    key_kind: str = "md5",
    after: int = 0,
) -> DataFrame:
    """The fact with ``sales_id``, dense from ``after`` + 1 in the order of date, lead and salesperson.

    Rows equal in these are ordered by ``tie_break`` and then by all other columns, so
    the ids depend on the content alone; rows equal in all columns are interchangeable. So sales of
    later dates than all before can be numbered by themselves, after the last id. The long keys are computed after the rows
    have been placed and never take part in the shuffle.
    """
    place = [] if key_by == "name" else ["segment", "region"]
    order = dict.fromkeys(
        ["sale_date", "lead_name", "salesperson", *tie_break, "opportunity_stage", "target_close", *FACT_VALUES, *place]
    )
    numbered = number_rows(numbered_facts(sales).select(*order), "sales_id", list(order), after=after)
    return numbered.select("sales_id", *_fact_columns(key_by, key_kind))


def star_join(
    fact: DataFrame,
    salespeople: DataFrame,
    leads: DataFrame,
    dates: DataFrame,
    stages: DataFrame,
) -> DataFrame:
    """The fact with the names behind its keys.

    Pass the dimensions as stored tables: Spark then knows their sizes and broadcasts
    the small ones, which leaves the fact where it is. A lead key that repeats in its
    dimension, as that by name does when a lead moves, would multiply facts; the query then fails.
    """
    leads = unique_by(leads, "lead_id", "lead_id repeats in the leads; build fact and leads with key_by='triple'")
    return (
        fact.join(stages, "stage_id")
        .join(dates, "date_id")
        .join(salespeople, "salesperson_id")
        .join(leads, "lead_id")
        .select(
            "date_value",
            "year",
            "month",
            "salesperson_name",
            "lead_name",
            "segment",
            "region",
            "stage_name",
            "target_close_date",
            *FACT_VALUES,
            "sales_cycle_days",
        )
    )
