"""Report queries over the fact, the dimensions and the aggregate tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealtide.functions.columns import (
    LOST,
    MONEY_SUM,
    WON,
    money_total,
    percent,
    row_count,
    stage_rank,
    surrogate_key,
)
from dealtide.operators.numbering import number_rows

# Names of the ranking metrics and the columns behind them.
PERFORMER_METRICS = {
    "total_revenue": "actual_revenue",
    "win_rate": "win_rate_percent",
    "deal_count": "won_deals",
    "pipeline_value": "total_pipeline_value",
}


def kpi_summary(
    fact: DataFrame,
    dates: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    key_kind: str = "md5",
) -> DataFrame:
    """One row of key figures. The date range applies if both ends are given.

    A stage key is a hash of the stage name, hence a constant here and no join. The
    range selects rows of the date dimension, whose keys then filter the fact.
    """
    if start_date and end_date:
        within = dates.where(F.col("date_value").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date")))
        fact = fact.join(within.select("date_id"), "date_id", "left_semi")
    won_stage = F.col("stage_id") == surrogate_key(F.lit(WON), kind=key_kind)
    lost_stage = F.col("stage_id") == surrogate_key(F.lit(LOST), kind=key_kind)
    closed = F.col("closed_opportunity")
    revenue = F.col("forecasted_monthly_revenue")
    return fact.agg(
        row_count().alias("total_opportunities"),
        F.count_if(closed & won_stage).alias("won_deals"),
        F.count_if(closed & lost_stage).alias("lost_deals"),
        percent(F.count_if(closed & won_stage), F.count_if(closed)).alias("overall_win_rate"),
        money_total(revenue).alias("total_pipeline_value"),
        money_total(F.when(won_stage, revenue).otherwise(F.lit(0))).alias("total_revenue_won"),
        F.avg("sales_cycle_days").alias("avg_sales_cycle"),
    )


def top_performers(performance: DataFrame, metric: str = "total_revenue", limit: int = 10) -> DataFrame:
    """Best rows by a metric; an unknown metric ranks by revenue. Nulls come last."""
    ranking = PERFORMER_METRICS.get(metric, "actual_revenue")
    return (
        performance.select(
            "salesperson_name", "region", "segment", "total_leads", "won_deals", "lost_deals",
            "win_rate_percent", "total_pipeline_value", "actual_revenue", "avg_sales_cycle_days",
            "avg_deal_size",
        )
        .orderBy(F.col(ranking).desc_nulls_last(), "salesperson_name", "region", "segment")
        .limit(limit)
    )


def regional_performance(region_mart: DataFrame, legacy_counts: bool = False) -> DataFrame:
    """Pipeline and close rate per region, largest pipeline first.

    ``legacy_counts`` counts the rows of the monthly table in place of opportunities.
    """
    count = row_count() if legacy_counts else F.sum("total_opportunities")
    return (
        region_mart.groupBy("region")
        .agg(
            count.alias("total_opportunities"),
            F.sum("total_forecasted_revenue").cast(MONEY_SUM).alias("total_pipeline"),
            F.sum("closed_opportunities").alias("deals_closed"),
            percent(F.sum("closed_opportunities"), count).alias("close_rate"),
        )
        .orderBy(F.desc("total_pipeline"), "region")
    )


def funnel_by_stage(funnel: DataFrame, weighted: bool = False) -> DataFrame:
    """Stages in funnel order.

    The two means are by default means over the region and segment rows, each row
    counting the same; ``weighted`` weighs them by their number of opportunities.
    """
    if weighted:
        many = F.sum("opportunity_count")
        size = F.sum("stage_pipeline_value").cast("double") / many
        days = F.sum(F.col("avg_days_to_close") * F.col("opportunity_count")) / many
    else:
        size, days = F.avg("avg_opportunity_value"), F.avg("avg_days_to_close")
    return (
        funnel.groupBy("stage_name")
        .agg(
            F.sum("opportunity_count").alias("total_count"),
            F.sum("stage_pipeline_value").cast(MONEY_SUM).alias("total_value"),
            F.sum("stage_weighted_value").cast(MONEY_SUM).alias("weighted_value"),
            size.alias("avg_opportunity_size"),
            days.alias("avg_days_to_close"),
        )
        .withColumn("stage_rank", stage_rank(F.col("stage_name")).cast("bigint"))
        .orderBy("stage_rank", "stage_name")
    )


def trend_rollup(
    trends: DataFrame,
    as_of: date | str | None = None,
    last_months: int = 12,
    exact_months: bool = False,
    weighted: bool = False,
) -> DataFrame:
    """Months from the year in which the window begins on, newest first.

    ``exact_months`` begins with the month itself. ``as_of`` is today by default.
    """
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    begin = F.add_months(today, -last_months)
    if exact_months:
        recent = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)) >= F.trunc(begin, "month")
    else:
        recent = F.col("year") >= F.year(begin)
    size = F.avg("avg_monthly_deal_size")
    if weighted:
        size = F.sum("monthly_pipeline_added").cast("double") / F.sum("new_opportunities")
    return (
        trends.where(recent)
        .groupBy("year", "month", "region")
        .agg(
            F.sum("new_opportunities").alias("new_opportunities"),
            F.sum("deals_won").alias("deals_won"),
            F.sum("deals_lost").alias("deals_lost"),
            F.sum("monthly_revenue_won").cast(MONEY_SUM).alias("revenue_won"),
            size.alias("avg_deal_size"),
        )
        .orderBy(F.desc("year"), F.desc("month"), "region")
    )


def lead_insights(scoring: DataFrame, score: str | None = None, limit: int = 100) -> DataFrame:
    """Leads with the largest opportunities, of one score or of all."""
    if score:
        scoring = scoring.where(F.col("lead_score") == score)
    return (
        scoring.select(
            "lead_name", "segment", "region", "assigned_salesperson", "max_opportunity_value",
            "total_interactions", "engagement_duration_days", "lead_score", "status", "final_outcome",
        )
        .orderBy(
            F.col("max_opportunity_value").desc_nulls_last(), "lead_name", "segment", "region", "assigned_salesperson"
        )
        .limit(limit)
    )


def segment_analysis(region_mart: DataFrame, legacy_counts: bool = False) -> DataFrame:
    """As the regional report, per segment and region."""
    count = row_count() if legacy_counts else F.sum("total_opportunities")
    return (
        region_mart.groupBy("segment", "region")
        .agg(
            count.alias("total_opportunities"),
            F.sum("total_forecasted_revenue").cast(MONEY_SUM).alias("total_pipeline"),
            (F.sum("total_forecasted_revenue").cast("double") / F.count("total_forecasted_revenue")).alias(
                "avg_deal_size"
            ),
            F.sum("closed_opportunities").alias("closed_deals"),
            percent(F.sum("closed_opportunities"), count).alias("close_rate"),
        )
        .orderBy(F.desc("total_pipeline"), "segment", "region")
    )


def _long(df: DataFrame, section: str, label: str, measures: list[str]) -> DataFrame:
    wide = df.select("_rank", F.expr(label).alias("label"), *[F.col(m).cast("double").alias(m) for m in measures])
    return wide.unpivot(["_rank", "label"], measures, "metric", "value").select(
        F.lit(section).alias("section"), F.col("_rank").alias("rank"), "label", "metric", "value"
    )


def executive_summary(
    fact: DataFrame,
    dates: DataFrame,
    performance: DataFrame,
    region_mart: DataFrame,
    funnel: DataFrame,
) -> DataFrame:
    """Key figures, five best performers, regions and funnel as one long table."""
    kpis = kpi_summary(fact, dates)
    best = top_performers(performance, limit=5)
    best_order = [F.col("actual_revenue").desc_nulls_last(), F.col("salesperson_name"), F.col("region"), F.col("segment")]
    regions = regional_performance(region_mart)
    sections = [
        _long(kpis.withColumn("_rank", F.lit(1).cast("bigint")), "overall", "'all'", kpis.columns),
        _long(
            # at most five rows, so one task is enough
            best.withColumn("_rank", F.row_number().over(Window.orderBy(*best_order)).cast("bigint")),
            "top_performers",
            "concat(salesperson_name, ' (', region, ')')",
            ["actual_revenue"],
        ),
        _long(
            number_rows(regions, "_rank", [F.desc("total_pipeline"), F.col("region")], rows_unique=True),
            "regional",
            "region",
            ["total_pipeline", "close_rate"],
        ),
        _long(
            funnel_by_stage(funnel).withColumnRenamed("stage_rank", "_rank"),
            "funnel",
            "stage_name",
            ["total_count", "total_value"],
        ),
    ]
    first, *others = sections
    for section in others:
        first = first.unionByName(section)
    return first
