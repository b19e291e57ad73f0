"""Refresh by a filter of groups: few rows are shuffled, and no group is missed."""

from __future__ import annotations

import contextlib
import io
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from dealtide.operators import increments
from dealtide.plans import marts
from dealtide.scratch import materialize

SALE = (
    "sale_date date, salesperson string, lead_name string, segment string, region string, target_close date, "
    "forecasted_monthly_revenue decimal(18,2), weighted_revenue decimal(18,2), opportunity_stage string, "
    "closed_opportunity boolean, active_opportunity boolean, latest_status_entry boolean"
)


def sales(spark):
    rows = [
        (date(2000, 1 + i % 12, 1), f"p{i % 3}" if i % 7 else None, f"l{i % 97}", None if i % 5 == 0 else "s", "r", None, Decimal(i), None, "Lead", i % 2 == 0, True, None)
        for i in range(600)
    ]
    return materialize(spark.createDataFrame(rows, SALE), "sales")


def bag(df):
    return sorted(map(str, df.collect()))


def test_refresh_shuffles_only_what_may_be_touched(spark, monkeypatch):
    df, mart = sales(spark), marts.LEAD_SCORING
    late = F.col("lead_name").isin("l3", "l40") & (F.col("sale_date") > date(2000, 6, 1))
    current = materialize(mart.build(df.where(~late)), "current")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = mart.refresh(current, df, df.where(late))
        with contextlib.redirect_stdout(io.StringIO()) as out:
            found.explain()
        assert bag(found) == bag(mart.build(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # before: all sales and the whole table
    assert out.getvalue().count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in out.getvalue()


def test_full_filter_rebuilds_more_but_the_same(spark, monkeypatch):
    df = sales(spark)
    late = F.col("sale_date") > date(2000, 9, 1)
    for most in (1 << 15, 8):
        monkeypatch.setattr(increments, "MOST_BITS", most)
        for mart in (marts.LEAD_SCORING, marts.SALES_SUMMARY, marts.PERFORMANCE):
            current = mart.build(df.where(~late))
            assert bag(mart.refresh(current, df, df.where(late))) == bag(mart.build(df))
            # a replaced row may have been the last one of its group
            assert bag(mart.refresh(mart.build(df), df.where(~late), df.where(late))) == bag(current)


def test_filter_parts_rows(spark):
    groups = spark.createDataFrame([(i, None if i % 3 else "x") for i in range(500)], "a long, b string")
    rows = spark.createDataFrame([(i, None if i % 3 else "x") for i in range(5000)] * 2, "c int, d string")
    found = increments.GroupFilter(groups, ["a", "b"])
    passing, outside = ([r.c for r in kind(rows, ["c", "d"]).collect()] for kind in (found.passing, found.outside))
    assert sorted(passing + outside) == sorted(2 * list(range(5000)))
    assert set(range(500)) <= set(passing) and not set(passing) & set(outside) and len(passing) < 2 * 1500
