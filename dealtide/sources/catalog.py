"""Declared sources: columns, key, watermark column, transforms and quality rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from dealtide.operators.transforms import Step


@dataclass(frozen=True)
class Source:
    name: str
    columns: Mapping[str, str]  # as in the raw file
    key: str | None = None
    watermark: str | None = None  # raw column that orders the increments
    format: str = "csv"
    transforms: Sequence[Step] = ()
    rules: Sequence[Mapping[str, object]] = ()

    @property
    def bronze_table(self) -> str:
        return f"bronze_{self.name}"

    @property
    def silver_table(self) -> str:
        return f"silver_{self.name}"

    def incremental(self, wanted: bool = True) -> bool:
        """Increments need a watermark column; all other loads are full."""
        return bool(wanted and self.watermark)


def _clean(*columns: str) -> list[Step]:
    return [{"type": "clean_column", "column": c} for c in columns]


def _not_null(*columns: str) -> list[Mapping[str, object]]:
    return [{"column": c, "rule_type": "not_null"} for c in columns]


# The declared sources with their columns, keys, transforms and rules.
SALESPEOPLE = Source(
    name="salespeople",
    columns={"salesperson": "string", "salesperson_id": "string"},
    key="salesperson_id",
    transforms=_clean("salesperson"),
    rules=_not_null("salesperson_id", "salesperson"),
)

LEADS = Source(
    name="leads",
    columns={"lead_name": "string", "segment": "string", "region": "string", "lead_id": "string"},
    key="lead_id",
    transforms=_clean("lead_name", "segment", "region"),
    rules=_not_null("lead_id", "lead_name"),
)

DATES = Source(
    name="dates",
    columns={
        "full_date": "date",
        "date_id": "string",
        "day": "integer",
        "month": "integer",
        "year": "integer",
        "quarter": "integer",
    },
    key="date_id",
    watermark="full_date",
    rules=_not_null("date_id", "full_date"),
)

SALES_OPPORTUNITIES = Source(
    name="sales_opportunities",
    columns={
        "date_id": "string",
        "target_close_id": "string",
        "salesperson_id": "string",
        "lead_id": "string",
        "forecasted_monthly_revenue": "decimal(18,2)",
        "opportunity_stage": "string",
        "weighted_revenue": "decimal(18,2)",
        "closed_opportunity": "boolean",
        "active_opportunity": "boolean",
        "latest_status_entry": "boolean",
        "opportunity_id": "string",
    },
    key="opportunity_id",
    transforms=[
        {"type": "type_conversion", "column": "forecasted_monthly_revenue", "to_type": "decimal(18,2)"},
        {"type": "type_conversion", "column": "weighted_revenue", "to_type": "decimal(18,2)"},
    ],
    rules=[
        *_not_null("opportunity_id"),
        {"column": "forecasted_monthly_revenue", "rule_type": "greater_than_equal", "value": 0},
        {"column": "weighted_revenue", "rule_type": "greater_than_equal", "value": 0},
    ],
)

# Columns of the flat sales file, their types, and their names once cleaned.
SALES_FILE_COLUMNS = {
    "Date": ("string", "sale_date"),
    "Salesperson": ("string", "salesperson"),
    "Lead Name": ("string", "lead_name"),
    "Segment": ("string", "segment"),
    "Region": ("string", "region"),
    "Target Close": ("string", "target_close"),
    "Forecasted Monthly Revenue": ("decimal(18,2)", "forecasted_monthly_revenue"),
    "Opportunity Stage": ("string", "opportunity_stage"),
    "Weighted Revenue": ("decimal(18,2)", "weighted_revenue"),
    "Closed Opportunity": ("boolean", "closed_opportunity"),
    "Active Opportunity": ("boolean", "active_opportunity"),
    "Latest Status Entry": ("boolean", "latest_status_entry"),
}

SALES = Source(
    name="sales",
    columns={raw: kind for raw, (kind, _) in SALES_FILE_COLUMNS.items()},
    watermark="Date",
    transforms=[
        *_clean("Salesperson", "Lead Name", "Segment", "Region", "Opportunity Stage"),
        {"type": "date_conversion", "column": "Date", "from_format": "M/d/yyyy"},
        {"type": "date_conversion", "column": "Target Close", "from_format": "M/d/yyyy"},
        {"type": "type_conversion", "column": "Forecasted Monthly Revenue", "to_type": "decimal(18,2)"},
        {"type": "type_conversion", "column": "Weighted Revenue", "to_type": "decimal(18,2)"},
        *[{"type": "rename_column", "from": raw, "to": new} for raw, (_, new) in SALES_FILE_COLUMNS.items()],
    ],
    rules=_not_null("lead_name", "salesperson"),
)

SOURCES = {s.name: s for s in (SALESPEOPLE, LEADS, DATES, SALES_OPPORTUNITIES, SALES)}
