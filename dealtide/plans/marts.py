"""Aggregate tables over the cleaned sales, described once and built several ways.

Each table is described by its state, aggregates that can be merged, and by the columns made of it. So it is built in
full, or from a stored state and the state of an increment without the sales before, or refreshed for the
groups that changed rows belong to, which also covers replaced rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.functions.columns import (
    WON,
    all_present,
    cycle_days,
    is_lost,
    is_won,
    money_total,
    percent,
    row_count,
    won_revenue,
)
from dealtide.operators.increments import GroupFilter, replace_groups, rows_of_groups, rows_outside_groups
from dealtide.operators.numbering import number_rows
from dealtide.scratch import materialize

FORECAST = "forecasted_monthly_revenue"
WEIGHTED = "weighted_revenue"
# Type of sums of squares of money.
SQUARES = "decimal(38,4)"


@dataclass(frozen=True)
class Part:
    """One aggregate of a state: over sales, and over states of the same groups."""

    of_sales: Column
    merge: Callable[[Column], Column]


def _added(of_sales: Column) -> Part:
    """A sum or a count. Merged in its own type, which holds the sums of whole tables."""
    return Part(of_sales, F.sum)


@dataclass(frozen=True)
class Mart:
    name: str
    id_name: str
    groups: Mapping[str, str]  # output column -> SQL expression over the sales
    required: Sequence[str]  # rows with a null in one of these are left out
    state: Callable[[], dict[str, Part]]
    measures: Callable[[], list[Column]]  # of the state
    distinct: Mapping[str, str] = field(default_factory=dict)  # state column -> column whose values it counts
    monthly: bool = False  # grouped by year and month of the sale

    def _guarded(self, sales: DataFrame) -> DataFrame:
        return sales.where(all_present(self.required))

    def _group_columns(self) -> list[Column]:
        return [F.expr(e).alias(name) for name, e in self.groups.items()]

    def partial(self, sales: DataFrame) -> DataFrame:
        """The state of some sales, without distinct counts: one row per group. Tasks pre-aggregate before the only shuffle."""
        parts = [part.of_sales.alias(name) for name, part in self.state().items()]
        return self._guarded(sales).groupBy(*self._group_columns()).agg(*parts)

    def pairs(self, sales: DataFrame, column: str) -> DataFrame:
        """The distinct values of a column in each group."""
        value = F.col(self.distinct[column]).alias("value")
        return self._guarded(sales).select(*self._group_columns(), value).where("value IS NOT NULL").distinct()

    def new_pairs(self, kept: DataFrame, sales: DataFrame, column: str) -> DataFrame:
        """The pairs of some sales that are not among those kept; of these only the years in question are looked at."""
        found = materialize(self.pairs(sales, column), "pairs")
        if self.monthly:
            first, last = found.agg(F.min("year"), F.max("year")).first()
            kept = kept if first is None else kept.where(F.col("year").between(first, last))
        return rows_outside_groups(found, kept, [*self.groups, "value"])

    def with_counts(self, partial: DataFrame, pairs: Mapping[str, DataFrame]) -> DataFrame:
        """A state with the numbers of its pairs; groups without pairs count none."""
        for column, found in pairs.items():
            counts = found.groupBy(*[F.col(g).alias(f"_{g}") for g in self.groups]).agg(F.count(F.lit(1)).alias(column))
            same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in self.groups]
            partial = partial.join(counts, reduce(lambda a, b: a & b, same), "left").drop(*[f"_{g}" for g in self.groups])
            partial = partial.withColumn(column, F.coalesce(column, F.lit(0).cast("bigint")))
        return partial

    def merged(self, state: DataFrame, more: DataFrame) -> DataFrame:
        """The state of the sales of both states, if no pair is counted in both."""
        shape = {f.name: f.dataType for f in state.schema}
        merges = [part.merge(F.col(name)).cast(shape[name]).alias(name) for name, part in self.state().items()]
        counts = [F.sum(c).alias(c) for c in self.distinct]
        return state.unionByName(more).groupBy(*self.groups).agg(*merges, *counts)

    def finished(self, state: DataFrame) -> DataFrame:
        return state.select(*self.groups, *self.measures())

    def build(self, sales: DataFrame) -> DataFrame:
        """One row per group. Lazy; tasks pre-aggregate before the only shuffle."""
        parts = [part.of_sales.alias(name) for name, part in self.state().items()]
        parts += [F.count_distinct(value).alias(c) for c, value in self.distinct.items()]
        return self.finished(self._guarded(sales).groupBy(*self._group_columns()).agg(*parts))

    def with_ids(self, built: DataFrame) -> DataFrame:
        """The built table with its row number in group order as first column."""
        return number_rows(built, self.id_name, list(self.groups), rows_unique=True)

    def touched(self, changed: DataFrame) -> DataFrame:
        """Groups that the changed rows belong to."""
        return self._guarded(changed).select(*self._group_columns()).distinct()

    @staticmethod
    def _of_months(sales: DataFrame, touched: DataFrame) -> DataFrame:
        """Sales between the first and the last touched month.

        The bounds are literals on a plain column, so the scan skips the files and row
        groups of all other months; sales loaded day by day lie clustered that way.
        """
        first_day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
        first, last = touched.agg(F.min(first_day), F.last_day(F.max(first_day))).first()
        return sales if first is None else sales.where(F.col("sale_date").between(F.lit(first), F.lit(last)))

    def refresh(self, current: DataFrame, sales: DataFrame, changed: DataFrame) -> DataFrame:
        """``current`` brought up to date by recomputing the touched groups only.

        ``current`` is the table before the change, ``sales`` the full table after it, ``changed`` the new and the
        replaced rows. Whole groups are recomputed, so distinct counts, deviations and
        maxima come out as in a full build.

        Groups by more than the month are many, so a filter of bounded size tells them apart, and only the rows that it lets pass are
        shuffled, once. A group passes with all its rows or not at all; one that was not touched comes out as it was.
        """
        keys = list(self.groups)
        if not self.monthly:
            fresh = [f"_k_{k}" for k in keys]
            by_group = [self._guarded(rows).select("*", *[F.expr(e).alias(f"_k_{n}") for n, e in self.groups.items()]) for rows in (changed, sales)]
            found = GroupFilter(by_group[0], fresh)
            return found.outside(current, keys).unionByName(self.build(found.passing(by_group[1], fresh).drop(*fresh)))
        touched = materialize(self.touched(changed), "touched")
        sales = self._of_months(sales, touched)
        keyed = self._guarded(sales).select("*", *[F.expr(e).alias(f"_k_{n}") for n, e in self.groups.items()])
        wanted = touched.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        affected = rows_of_groups(keyed, wanted, [f"_k_{k}" for k in keys]).drop(*[f"_k_{k}" for k in keys])
        return replace_groups(current, self.build(affected), touched, keys)


def _count_where(condition: Column) -> Part:
    return _added(F.count_if(condition))


def _totals_state() -> dict[str, Part]:
    return {
        "n": _added(row_count()),
        "forecast": _added(money_total(F.col(FORECAST))),
        "weighted": _added(money_total(F.col(WEIGHTED))),
        "closed": _count_where(F.col("closed_opportunity")),
    }


def _totals() -> list[Column]:
    return [
        F.col("n").alias("total_opportunities"),
        F.col("forecast").alias("total_forecasted_revenue"),
        F.col("weighted").alias("total_weighted_revenue"),
        F.col("closed").alias("closed_opportunities"),
    ]


def _days_state() -> dict[str, Part]:
    return {"days": _added(F.sum(cycle_days())), "dated": _added(F.count(cycle_days()))}


def _mean(total: str, count: str) -> Column:
    return F.col(total).cast("double") / F.nullif(F.col(count), F.lit(0))


def _summary_state() -> dict[str, Part]:
    return {**_totals_state(), "active": _count_where(F.col("active_opportunity")), **_days_state()}


def _summary() -> list[Column]:
    return [*_totals(), F.col("active").alias("active_opportunities"), _mean("days", "dated").alias("avg_sales_cycle_days")]


def _deals_state() -> dict[str, Part]:
    return {
        "n": _added(row_count()),
        "won": _count_where(is_won()),
        "lost": _count_where(is_lost()),
        "forecast": _added(money_total(F.col(FORECAST))),
        "won_forecast": _added(won_revenue()),
        "priced": _added(F.count(FORECAST)),
    }


def _performance_state() -> dict[str, Part]:
    return {
        **_deals_state(),
        "closed": _count_where(F.col("closed_opportunity")),
        "squares": _added(F.sum(F.col(FORECAST) * F.col(FORECAST)).cast(SQUARES)),
        **_days_state(),
    }


def deviation(total: str, squares: str, count: str) -> Column:
    """Sample deviation from exact sums.

    The difference of the products is exact too unless they have over 34 digits before the point; only
    then it is one of doubles.
    """
    n, x, xx = F.col(count).cast("decimal(20,0)"), F.col(total), F.col(squares)
    exact = F.try_subtract(F.try_multiply(n, xx), F.try_multiply(x, x)).cast("double")
    rough = n.cast("double") * xx.cast("double") - x.cast("double") * x.cast("double")
    spread = F.greatest(F.coalesce(exact, rough), F.lit(0.0))
    return F.sqrt(spread / F.nullif(n.cast("double") * (n.cast("double") - 1), F.lit(0.0)))


def _performance() -> list[Column]:
    return [
        F.col("n").alias("total_leads"),
        F.col("won").alias("won_deals"),
        F.col("lost").alias("lost_deals"),
        percent(F.col("won"), F.col("closed")).alias("win_rate_percent"),
        F.col("forecast").alias("total_pipeline_value"),
        F.col("won_forecast").alias("actual_revenue"),
        _mean("days", "dated").alias("avg_sales_cycle_days"),
        _mean("forecast", "priced").alias("avg_deal_size"),
        deviation("forecast", "squares", "priced").alias("deal_size_variance"),
    ]


def _funnel_state() -> dict[str, Part]:
    return {
        "n": _added(row_count()),
        "forecast": _added(money_total(F.col(FORECAST))),
        "weighted": _added(money_total(F.col(WEIGHTED))),
        "priced": _added(F.count(FORECAST)),
        **_days_state(),
        "active": _count_where(F.col("active_opportunity")),
        "latest": _count_where(F.col("latest_status_entry")),
    }


def _funnel() -> list[Column]:
    return [
        F.col("n").alias("opportunity_count"),
        F.col("forecast").alias("stage_pipeline_value"),
        F.col("weighted").alias("stage_weighted_value"),
        _mean("forecast", "priced").alias("avg_opportunity_value"),
        _mean("days", "dated").alias("avg_days_to_close"),
        F.col("active").alias("active_opportunities"),
        F.col("latest").alias("recent_activity_count"),
    ]


def _deals() -> list[Column]:
    return [
        F.col("n").alias("new_opportunities"),
        F.col("won").alias("deals_won"),
        F.col("lost").alias("deals_lost"),
        F.col("forecast").alias("monthly_pipeline_added"),
        F.col("won_forecast").alias("monthly_revenue_won"),
        _mean("forecast", "priced").alias("avg_monthly_deal_size"),
    ]


# Distinct counts of the monthly trends and what they count.
_ACTIVE = {"active_salespeople": "salesperson", "unique_leads": "lead_name"}


def _trends() -> list[Column]:
    return [*_deals(), *[F.col(c) for c in _ACTIVE]]


def _sketched_state() -> dict[str, Part]:
    """Sketches instead of exact distinct counts; they merge, and need no values kept."""
    sketches = {c: Part(F.hll_sketch_agg(value), F.hll_union_agg) for c, value in _ACTIVE.items()}
    return {**_deals_state(), **sketches}


def _approximate_trends() -> list[Column]:
    return [*_deals(), *[F.hll_sketch_estimate(c).alias(c) for c in _ACTIVE]]


def _scoring_state() -> dict[str, Part]:
    stage = F.col("opportunity_stage")
    # the stage as flags, since text has no hash aggregation
    return {
        "n": _added(row_count()),
        "most": Part(F.max(FORECAST), F.max),
        "first": Part(F.min("sale_date"), F.min),
        "last": Part(F.max("sale_date"), F.max),
        "hot": _count_where(stage.isin("Qualified", "Contracting")),
        "warm": _count_where(stage == "Prospect"),
        "closed": Part(F.bool_or("closed_opportunity"), F.bool_or),
        "active": Part(F.bool_or("active_opportunity"), F.bool_or),
        "won": Part(F.bool_or(stage == WON), F.bool_or),
        "beyond": Part(F.bool_or(stage > WON), F.bool_or),
    }


def _scoring(any_won: bool = False) -> list[Column]:
    score = F.when(F.col("hot") > 0, "High").when(F.col("warm") > 0, "Medium").otherwise("Low")
    won = F.coalesce("won", F.lit(False))
    if not any_won:
        # the greatest stage is the won one
        won = won & ~F.coalesce("beyond", F.lit(False))
    outcome = F.when(F.col("closed"), F.when(won, "Won").otherwise("Lost")).otherwise("Open")
    return [
        F.col("most").alias("max_opportunity_value"),
        F.col("n").alias("total_interactions"),
        F.col("last").alias("last_interaction_date"),
        F.datediff("last", "first").cast("bigint").alias("engagement_duration_days"),
        score.alias("lead_score"),
        F.when(F.col("active"), "Active").otherwise("Inactive").alias("status"),
        outcome.alias("final_outcome"),
    ]


_PLACE = {"region": "region", "segment": "segment"}
_MONTH = {"year": "CAST(year(sale_date) AS BIGINT)", "month": "CAST(month(sale_date) AS BIGINT)"}

# Names, ids, group columns and guards of the aggregate tables.
SALES_SUMMARY = Mart(
    "gold_sales_overview",
    "summary_id",
    {"salesperson_name": "salesperson", **_PLACE},
    ("salesperson", "region", "segment"),
    _summary_state,
    _summary,
)
REGION_SUMMARY = Mart(
    "gold_sales_by_region",
    "region_summary_id",
    {**_PLACE, **_MONTH},
    ("region", "segment", "sale_date"),
    _totals_state,
    _totals,
    monthly=True,
)
PERFORMANCE = Mart(
    "gold_sales_performance_metrics",
    "performance_id",
    {"salesperson_name": "salesperson", **_PLACE},
    ("salesperson", "region", "segment"),
    _performance_state,
    _performance,
)
FUNNEL = Mart(
    "gold_opportunity_funnel",
    "funnel_id",
    {"stage_name": "opportunity_stage", **_PLACE},
    ("opportunity_stage", "region", "segment"),
    _funnel_state,
    _funnel,
)
TRENDS = Mart(
    "gold_monthly_sales_trends",
    "trends_id",
    {**_MONTH, "region": "region"},
    ("sale_date", "region"),
    _deals_state,
    _trends,
    distinct=_ACTIVE,
    monthly=True,
)
# The same with sketches instead of exact distinct counts, for tables where the
# exact ones cost too much. A table of its own, as the two must not meet in one.
APPROXIMATE_TRENDS = Mart(
    "gold_monthly_sales_trends_approximate",
    "trends_id",
    TRENDS.groups,
    TRENDS.required,
    _sketched_state,
    _approximate_trends,
    monthly=True,
)
LEAD_SCORING = Mart(
    "gold_lead_scoring",
    "scoring_id",
    {"lead_name": "lead_name", "segment": "segment", "region": "region", "assigned_salesperson": "salesperson"},
    ("lead_name",),
    _scoring_state,
    _scoring,
)
# The outcome of a lead is by default decided by its alphabetically greatest stage;
# here one won opportunity is enough, in a table of its own.
LEAD_SCORING_ANY_WON = Mart(
    "gold_lead_scoring_any_won",
    "scoring_id",
    LEAD_SCORING.groups,
    LEAD_SCORING.required,
    _scoring_state,
    lambda: _scoring(any_won=True),
)

SALES_MARTS = (SALES_SUMMARY, REGION_SUMMARY, PERFORMANCE, FUNNEL, TRENDS, LEAD_SCORING)


def _packed(df: DataFrame, column: str) -> Column:
    """A key for a shuffle: 32 hexadecimal digits, as of an md5, take half the bytes. Other texts and types stay what they are."""
    key = F.col(column)
    if df.schema[column].dataType.simpleString() != "string":
        return key
    digest = F.concat(F.lit(b"\x01"), F.unhex(key))
    return F.when(key.rlike("^[0-9a-f]{32}\\z"), digest).otherwise(F.concat(F.lit(b"\x00"), key.cast("binary")))


def _unpacked(column: str, kind: str) -> Column:
    if kind != "string":
        return F.col(column)
    value = F.substr(F.col(column), F.lit(2))
    return F.when(F.substr(F.col(column), F.lit(1), F.lit(1)) == F.lit(b"\x01"), F.lower(F.hex(value))).otherwise(value.cast("string"))


def summary_of_normalized(
    opportunities: DataFrame,
    salespeople: DataFrame,
    leads: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """Salesperson x region x segment from the four related tables.

    Opportunities meet their lead first, in the only shuffle of all of them: pairs of a salesperson and a lead hardly repeat, so sums by
    these would save nothing. AQE splits a lead with very many. Each task then sums by salesperson, region and segment, and few rows meet
    the salespeople. Every row of a table that an opportunity matches counts, as in a plain join of all four.
    """
    amounts = (FORECAST, WEIGHTED)
    flags = ("closed_opportunity", "active_opportunity")
    kinds = {c: opportunities.schema[c].dataType.simpleString() for c in ("salesperson_id", "lead_id")}
    sold = opportunities.join(dates.select("date_id"), "date_id").select(
        *[_packed(opportunities, c).alias(c) for c in kinds], F.col("opportunity_id").isNotNull().alias("_known"), *amounts, *flags
    )
    places = leads.select(_packed(leads, "lead_id").alias("lead_id"), "region", "segment")
    partial = (
        sold.join(places, "lead_id")
        .groupBy("salesperson_id", "region", "segment")
        .agg(
            F.count_if("_known").alias("_n"),
            *[F.sum(c).alias(f"_{c}") for c in amounts],
            *[F.count_if(c).alias(f"_{c}") for c in flags],
        )
        .withColumn("salesperson_id", _unpacked("salesperson_id", kinds["salesperson_id"]))
    )
    return (
        partial.join(salespeople.select("salesperson_id", "salesperson"), "salesperson_id")
        .groupBy("salesperson_id", "salesperson", "region", "segment")
        .agg(
            F.sum("_n").alias("total_opportunities"),
            money_total(F.col(f"_{FORECAST}")).alias("total_forecasted_revenue"),
            money_total(F.col(f"_{WEIGHTED}")).alias("total_weighted_revenue"),
            F.sum("_closed_opportunity").alias("closed_opportunities"),
            F.sum("_active_opportunity").alias("active_opportunities"),
        )
    )
