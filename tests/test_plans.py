"""Star schema, aggregate tables, reports, loads, run log and exploration."""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.operators import explore, runlog
from dealtide.plans import dashboard, marts, star
from dealtide.plans.loads import BROKEN, BUILT_FROM, DIMENSIONS, REJECTED, Lake
from dealtide.plans.sales_view import read_table
from dealtide.scratch import materialize
from dealtide.session import shuffle_partitions
from dealtide.sinks import jdbc
from dealtide.sinks.files import export_reports
from dealtide.sources import catalog
from dealtide.sources.tables import Mark

SALES_SCHEMA = (
    "sale_date date, salesperson string, lead_name string, segment string, region string, target_close date, "
    "forecasted_monthly_revenue decimal(18,2), opportunity_stage string, weighted_revenue decimal(18,2), "
    "closed_opportunity boolean, active_opportunity boolean, latest_status_entry boolean"
)


def sale(day, person, lead, stage, amount, segment="S1", region="EU", close=date(2017, 3, 1)):
    closed = stage.startswith("Closed") if stage else None
    active = None if closed is None else not closed
    return (day, person, lead, segment, region, close, Decimal(amount), stage, Decimal(amount) / 2, closed, active, True)


ROWS = [
    sale(date(2017, 1, 1), "Ann", "Acme", "Prospect", "10"),
    sale(date(2017, 1, 5), "Ann", "Acme", "Closed Won", "30"),
    sale(date(2017, 2, 1), "Bob", "Bolt", "Lead", "5"),
    sale(date(2017, 2, 2), "Bob", "Core", "Closed Lost", "8", segment="S2"),
    sale(date(2017, 2, 3), "Bob", "Core", "Closed Won", "9", segment="S2"),
    sale(date(2017, 2, 4), "Cid", "Dune", "Closed Won", "50", segment=None, region="US"),
    sale(date(2017, 2, 4), "Cid", "Dune", "Closed Won", "50", segment=None, region="US"),
    sale(None, "Cid", None, "Qualified", "1", region="US"),
]


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(ROWS, SALES_SCHEMA).cache()


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def bag(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rates_and_deviation(sales):
    built = by(marts.PERFORMANCE.build(sales), "salesperson_name", "segment")
    assert set(built) == {("Ann", "S1"), ("Bob", "S1"), ("Bob", "S2"), ("Cid", "S1")}
    assert built["Ann", "S1"].win_rate_percent == 100.0 and built["Ann", "S1"].actual_revenue == 30
    assert built["Bob", "S2"].win_rate_percent == 50.0
    assert built["Bob", "S1"].win_rate_percent is None and built["Bob", "S1"].deal_size_variance is None
    assert built["Ann", "S1"].avg_deal_size == 20.0 and round(built["Ann", "S1"].deal_size_variance, 4) == 14.1421


def test_lead_scores(sales):
    scored = by(marts.LEAD_SCORING.build(sales), "lead_name")
    assert scored[("Acme",)].final_outcome == "Lost"  # Prospect sorts after Closed Won
    assert scored[("Acme",)].lead_score == "Medium" and scored[("Acme",)].engagement_duration_days == 4
    assert scored[("Core",)].final_outcome == "Won" and scored[("Bolt",)].final_outcome == "Open"
    assert scored[("Dune",)].segment is None and scored[("Dune",)].status == "Inactive"
    eager = by(marts.LEAD_SCORING_ANY_WON.build(sales), "lead_name")
    assert eager[("Acme",)].final_outcome == "Won"


def test_outcome_is_that_of_the_greatest_stage(spark):
    stages = ["Lead", "Closed Won", "Closed Lost", "Zeta", None]
    rows = [sale(date(2017, 1, 1), "p", f"{a}-{b}", s, "1") for a in stages for b in stages for s in (a, b)]
    df = spark.createDataFrame(rows, SALES_SCHEMA)
    plain = df.groupBy("lead_name").agg(
        F.when(
            F.max("closed_opportunity"), F.when(F.max("opportunity_stage") == "Closed Won", "Won").otherwise("Lost")
        ).otherwise("Open").alias("o")
    )
    assert bag(marts.LEAD_SCORING.build(df).select("lead_name", "final_outcome")) == bag(plain)


def test_monthly_distinct_counts(sales):
    months = by(marts.TRENDS.build(sales), "year", "month", "region")
    feb = months[2017, 2, "EU"]
    assert (feb.new_opportunities, feb.active_salespeople, feb.unique_leads, feb.deals_lost) == (3, 1, 2, 1)
    approximate = by(marts.APPROXIMATE_TRENDS.build(sales), "year", "month", "region")
    assert approximate[2017, 2, "EU"].unique_leads == 2


@pytest.mark.parametrize("mart", [*marts.SALES_MARTS, marts.LEAD_SCORING_ANY_WON], ids=lambda m: m.id_name)
def test_refresh_equals_full_build(spark, sales, mart):
    late = F.coalesce(F.col("sale_date") > F.lit("2017-02-02").cast("date"), F.lit(False))
    current = mart.build(sales.where(~late))
    assert bag(mart.refresh(current, sales, sales.where(late))) == bag(mart.build(sales))
    assert bag(mart.refresh(current, sales.where(~late), sales.limit(0))) == bag(current)


def test_monthly_refresh_skips_other_months(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    sales.write.parquet(path)
    stored, mart = spark.read.parquet(path), marts.TRENDS
    changed = stored.where("sale_date >= date '2017-02-01'")
    plan = mart.refresh(mart.build(stored), stored, changed)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(sale_date,2017-02-01), LessThanOrEqual(sale_date,2017-02-28)" in plan


def test_partitions_follow_the_bytes():
    assert shuffle_partitions(1) == 200 and shuffle_partitions(1 << 40) == 8192
    assert shuffle_partitions(40 << 40) == 327_680 and shuffle_partitions(1 << 50) == 8_388_608


def test_fact_ids_and_copies(sales):
    fact = star.fact_sales(sales)
    assert sorted(r.sales_id for r in fact.collect()) == list(range(1, 8))
    order = Window.orderBy("sale_date", "lead_name", "salesperson", "opportunity_stage")
    guarded = sales.where("lead_name IS NOT NULL AND sale_date IS NOT NULL")
    wanted = guarded.select(
        F.row_number().over(order).cast("bigint").alias("sales_id"), F.md5("lead_name").alias("lead_id")
    )
    assert bag(fact.select("sales_id", "lead_id")) == bag(wanted)
    assert {r.sales_cycle_days for r in fact.collect()} == {59, 55, 28, 27, 26, 25}


def test_fact_of_a_stored_table(spark, sales, tmp_path):
    path = str(tmp_path / "sales")
    sales.repartition(3).write.parquet(path)
    stored = spark.read.parquet(path)
    assert bag(star.fact_sales(stored)) == bag(star.fact_sales(sales))


def test_facts_of_later_dates_follow_those_before(spark, sales):
    early, late = sales.where("sale_date < '2017-02-01'"), sales.where("sale_date >= '2017-02-01'")
    first = star.fact_sales(early)
    second = star.fact_sales(late, after=first.count())
    assert first.count() and second.count()
    assert bag(first.unionByName(second)) == bag(star.fact_sales(sales.where("sale_date IS NOT NULL")))


def test_lake_numbers_only_the_increment(spark, tmp_path):
    lake, source = Lake(spark, str(tmp_path / "lake")), catalog.SALES
    file = tmp_path / "sales.csv"

    def run(*lines, incremental=True):
        file.write_text("\n".join([SALES_HEADER, *lines]) + "\n")
        lake.ingest(source, str(file), incremental)
        lake.refine(source, incremental)

    def whole():
        rows = lake.table(source.silver_table).read()
        return bag(star.fact_sales(rows, key_by="triple"))

    def fact():
        return bag(lake.table("gold_fact_sales").read())

    old = [line("9/9/2016", "Ann", "Acme", "Lead", 10), line("9/8/2016", "Bob", "Bolt", "Lead", 1)]
    copies = [line("10/1/2016", "Ann", "Acme", "Closed Won", 20)] * 3
    run(*old)
    assert all(load.committed for load in lake.build_star().values())
    wanted = {name: bag(lake.table(name).read()) for name in DIMENSIONS}
    run(*old, *copies, line("10/1/2016", "Cid", "Acme", "Lead", 5))
    complete = whole()
    # what was there before is out of reach: only the increment is read
    away = [(f, f.with_name(f.name + "-away")) for f in (tmp_path / "lake" / "silver_sales").glob("v1-*")]
    for here, there in away:
        here.rename(there)
    done = lake.build_star()
    for here, there in away:
        there.rename(here)
    assert done["gold_fact_sales"].rows == 4 and fact() == complete
    assert (done["gold_dim_salesperson"].rows, done["gold_dim_lead"].rows, done["gold_dim_date"].rows) == (1, 0, 1)
    for name, build in DIMENSIONS.items():
        assert bag(lake.table(name).read()) == bag(build(lake.table(source.silver_table).read()))
        assert set(wanted[name]) <= set(bag(lake.table(name).read()))
    assert not any(load.committed for load in lake.build_star().values())

    # the same date again is not later, so the fact is built anew; so it is after a full load
    lake.ingest(source, str(file), lookback_days=0)
    silver = lake.table(source.silver_table)
    silver.append(silver.read().where("salesperson = 'Cid'"), load_id="by hand")
    assert lake.build_fact().rows == 7 and fact() == whole()
    run(*copies, incremental=False)
    assert lake.build_fact().rows == 3 and fact() == whole()


def test_states_merge_to_the_full_build(spark, sales):
    parts = [sales.where("sale_date < '2017-02-01' OR sale_date IS NULL"), sales.where("sale_date >= '2017-02-01'"), sales.where("false")]
    for mart in (*marts.SALES_MARTS, marts.APPROXIMATE_TRENDS, marts.LEAD_SCORING_ANY_WON):
        state, pairs = None, dict.fromkeys(mart.distinct)
        for part in parts:
            fresh = {c: mart.pairs(part, c) if old is None else mart.new_pairs(old, part, c) for c, old in pairs.items()}
            pairs = {c: materialize(new if pairs[c] is None else pairs[c].unionByName(new), "pairs") for c, new in fresh.items()}
            more = mart.with_counts(mart.partial(part), fresh)
            state = materialize(more if state is None else mart.merged(state, more), "state")
        assert bag(mart.finished(state)) == bag(mart.build(sales))


def test_deviation_is_exact(spark):
    def of(values):
        rows = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(18,2)")
        sums = rows.agg(F.sum("v").cast("decimal(28,2)").alias("x"), F.sum(F.col("v") * F.col("v")).cast(marts.SQUARES).alias("xx"), F.count("v").alias("n"))
        return sums.select(marts.deviation("x", "xx", "n")).first()[0]

    assert of(["5.10"] * 7) == 0.0 and of(["3"]) is None and of([]) is None
    assert of(["1000000000.01", "1000000000.02"]) == pytest.approx(0.01 / 2**0.5, rel=1e-12)
    assert of(["9999999999999999.99", "1"] * 50) == pytest.approx(5025189076296060.0, rel=1e-9)


def test_marts_read_only_the_increment(spark, tmp_path):
    lake, source = Lake(spark, str(tmp_path / "lake")), catalog.SALES
    file = tmp_path / "sales.csv"
    days = ["9/8/2016", "9/9/2016", "10/1/2016", "10/1/2016", "11/2/2016"]
    lines = [line(d, f"P{i % 3}", f"L{i % 2}", s, 10 + i) for i, (d, s) in enumerate(zip(days, ["Lead", "Closed Won", "Closed Lost", "Prospect", "Lead"], strict=True))]
    chosen = (marts.PERFORMANCE, marts.TRENDS)
    for n in (2, 4, 5):
        file.write_text("\n".join([SALES_HEADER, *lines[:n]]) + "\n")
        lake.ingest(source, str(file))
        lake.refine(source)
        old = sorted((tmp_path / "lake" / "silver_sales").glob("v*"), key=lambda f: f.stat().st_mtime)[:-1]
        for folder in old:
            folder.rename(folder.with_name(folder.name + "-away"))
        try:
            assert all(lake.build_mart(m).committed for m in chosen)
        finally:
            for folder in old:
                folder.with_name(folder.name + "-away").rename(folder)
        for mart in chosen:
            built = mart.with_ids(mart.build(lake.table(source.silver_table).read()))
            assert bag(lake.table(mart.name).read()) == bag(built)
    assert not lake.build_mart(marts.TRENDS).committed

    # a run that stopped between state and table, and one that stopped in a build of all pairs
    trends = lake.table(marts.TRENDS.name)
    wanted = bag(trends.read())
    trends.replace(trends.read().where("false"), mark=Mark(BUILT_FROM, value="0"))
    assert lake.build_mart(marts.TRENDS).committed and bag(trends.read()) == wanted
    lake._keep_pairs(marts.TRENDS, None, 99)
    silver = lake.table(source.silver_table)
    silver.append(silver.read().limit(1).withColumn("salesperson", F.lit("new")), load_id="by hand")
    lake.build_mart(marts.TRENDS)
    assert bag(trends.read()) == bag(marts.TRENDS.with_ids(marts.TRENDS.build(silver.read())))


def test_lead_keys(spark):
    moved = [sale(date(2017, 1, 1), "p", "Acme", "Lead", "1"), sale(date(2017, 1, 2), "p", "Acme", "Lead", "1", "S2")]
    df = spark.createDataFrame(moved, SALES_SCHEMA)
    assert star.repeated_keys(star.dim_lead(df), "lead_id").first().occurrences == 2
    triple = star.dim_lead(df, key_by="triple")
    assert star.repeated_keys(triple, "lead_id").count() == 0
    facts = star.fact_rows(df, key_by="triple")
    joined = star.star_join(facts, star.dim_salesperson(df), triple, star.dim_date(df), star.dim_stage(df))
    assert joined.count() == 2 and joined.select("segment").distinct().count() == 2
    by_name = star.star_join(star.fact_rows(df), star.dim_salesperson(df), star.dim_lead(df), star.dim_date(df), star.dim_stage(df))
    with pytest.raises(Exception, match="lead_id repeats"):
        by_name.collect()
    numbered = star.fact_sales(df, key_by="triple", key_kind="xxhash64")
    assert numbered.select("lead_id").distinct().count() == 2
    with pytest.raises(ValueError):
        star.lead_key("colour")


def test_hot_lead_is_split_in_the_star_join(spark, tmp_path):
    lead = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("lead "), F.col("id").cast("string")))
    wide = spark.range(60000).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("sale_date"),
        F.lit("Ann").alias("salesperson"),
        lead.alias("lead_name"),
        F.lit("S1").alias("segment"),
        F.lit("EU").alias("region"),
        F.lit("2020-03-01").cast("date").alias("target_close"),
        (F.abs(F.xxhash64("id")) % 10**9).cast("decimal(18,2)").alias("forecasted_monthly_revenue"),
        F.lit("Lead").alias("opportunity_stage"),
        (F.abs(F.xxhash64("id", F.lit(1))) % 10**9).cast("decimal(18,2)").alias("weighted_revenue"),
        F.lit(False).alias("closed_opportunity"),
        F.lit(True).alias("active_opportunity"),
        F.lit(True).alias("latest_status_entry"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "100k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sales = materialize(wide, "sales")
        dims = [
            materialize(build(sales), "dim")
            for build in (star.dim_salesperson, star.dim_lead, star.dim_date, star.dim_stage)
        ]
        joined = star.star_join(star.fact_rows(sales), *dims)
        assert len(joined.collect()) == 60000
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan.split("Initial Plan")[0] and plan.count("BroadcastHashJoin") >= 3


def test_calendar(spark):
    df = spark.createDataFrame([sale(date(2024, 1, 7), "p", "l", "Lead", "1")], SALES_SCHEMA)
    day = star.dim_date(df).first()
    assert (day.day_of_week, day.quarter, day.year, day.month, day.day) == (1, 1, 2024, 1, 7)


def test_key_figures(sales):
    fact, dates = star.fact_rows(sales), star.dim_date(sales)
    total = dashboard.kpi_summary(fact, dates).first()
    assert (total.total_opportunities, total.won_deals, total.lost_deals) == (7, 4, 1)
    assert total.overall_win_rate == 80.0 and total.total_revenue_won == 139
    some = dashboard.kpi_summary(fact, dates, "2017-02-01", "2017-02-03").first()
    assert some.total_opportunities == 3
    assert dashboard.kpi_summary(fact, dates, start_date="2017-02-01").first().total_opportunities == 7


def test_reports(sales):
    performance = marts.PERFORMANCE.build(sales)
    assert [r.salesperson_name for r in dashboard.top_performers(performance, "no such", 1).collect()] == ["Ann"]
    assert dashboard.top_performers(performance, "win_rate").collect()[-1].win_rate_percent is None
    regions = marts.REGION_SUMMARY.build(sales)
    literal = dashboard.regional_performance(regions, legacy_counts=True).first()
    assert (literal.region, literal.total_opportunities, literal.close_rate) == ("EU", 3, 100.0)
    assert dashboard.regional_performance(regions).first().total_opportunities == 5
    stages = dashboard.funnel_by_stage(marts.FUNNEL.build(sales)).collect()
    assert [r.stage_name for r in stages] == ["Lead", "Prospect", "Qualified", "Closed Won", "Closed Lost"]
    trends = marts.TRENDS.build(sales)
    assert dashboard.trend_rollup(trends, "2017-06-01", last_months=4, exact_months=True).count() == 2
    assert dashboard.trend_rollup(trends, "2017-06-01", last_months=4).count() == 3
    assert dashboard.trend_rollup(trends).count() == 0
    scoring = marts.LEAD_SCORING.build(sales)
    assert [r.lead_name for r in dashboard.lead_insights(scoring, limit=1).collect()] == ["Dune"]
    assert {r.lead_score for r in dashboard.lead_insights(scoring, "Low").collect()} == {"Low"}


SALES_HEADER = ",".join(catalog.SALES.columns)


def line(day, person, lead, stage, amount):
    closed = str(stage.startswith("Closed")).lower()
    active = str(not stage.startswith("Closed")).lower()
    return f"{day}, {person} ,{lead},S1,EU,3/1/2017,{amount},{stage},{amount},{closed},{active},true"


def test_lake_of_the_flat_file(spark, tmp_path):
    lake, source = Lake(spark, str(tmp_path / "lake")), catalog.SALES
    first = [line("9/9/2016", "Ann", "Acme", "Lead", 10), line("9/8/2016", "Bob", "", "Lead", 1)]
    later = [line("10/1/2016", "Ann", "Acme", "Closed Won", 20), line("10/1/2016", "Cid", "Bolt", "Lead", 5)]
    file = tmp_path / "sales.csv"

    def run(lines):
        file.write_text("\n".join([SALES_HEADER, *lines]) + "\n")
        bronze = lake.ingest(source, str(file))
        silver, report = lake.refine(source)
        return bronze, silver, report.collect()

    bronze, silver, report = run(first)
    assert (bronze.rows, silver.rows, [r.failed_count for r in report]) == (2, 1, [1])
    refreshed = (marts.TRENDS, marts.LEAD_SCORING)
    assert all(lake.build_mart(m).committed for m in refreshed)
    bronze, silver, report = run([*first, *later])
    assert (bronze.rows, silver.rows, report) == (2, 2, [])  # October comes after September
    bronze, silver, _ = run([*first, *later])
    assert not bronze.committed and not silver.committed
    table = lake.table(source.silver_table)
    assert table.mark("Date") == "2016-10-01" and table.read().count() == 3
    marks = lake.watermarks(source.bronze_table, source.silver_table, "absent").collect()
    assert {(m.table_name, m.column_name, m.max_value) for m in marks} == {
        ("bronze_sales", "Date", "2016-10-01"),
        ("silver_sales", "Date", "2016-10-01"),
    }

    lake.build_star()
    lake.build_marts()
    again = lake.build_marts()
    assert not any(load.committed for load in again.values())
    for mart in refreshed:
        assert bag(lake.table(mart.name).read()) == bag(mart.with_ids(mart.build(table.read())))
    assert lake.table("gold_fact_sales").read().count() == 3

    lake.register("gold_fact_sales")
    assert spark.sql("SELECT max(sales_id) FROM gold_fact_sales").first()[0] == 3
    written = export_reports(lake.reports(as_of="2016-12-31"), str(tmp_path / "out"), stamp="s")
    assert len(written) == 7

    file.write_text("\n".join([SALES_HEADER, first[0]]) + "\n")
    assert lake.ingest(source, str(file), incremental=False).rows == 1
    assert lake.refine(source, incremental=False)[0].rows == 1 and table.read().count() == 1
    assert lake.build_mart(marts.TRENDS).rows == 1

    rejected = lake.table(source.silver_table + REJECTED)
    assert rejected.read().count() == 0
    file.write_text(SALES_HEADER + "\n")
    assert not lake.ingest(source, str(file), incremental=False).committed  # kept, and said so
    file.write_text("\n".join([SALES_HEADER, first[1]]) + "\n")
    lake.ingest(source, str(file), incremental=False)
    assert lake.refine(source, incremental=False)[0].rows == 0 and table.read().count() == 0
    assert [tuple(r.failed_rules) for r in rejected.read().collect()] == [("not_null(lead_name)",)]
    assert lake.build_mart(marts.TRENDS).committed and lake.table(marts.TRENDS.name).read().count() == 0

    state = runlog.run_state(lake.log.rows())
    assert sorted({r.status for r in state.collect()}) == ["COMPLETED", "EMPTY_SOURCE"] and state.where("duration_seconds < 0").count() == 0
    noted = runlog.run_history(state, "bronze_sales", limit=50).collect()
    assert {(r.incremental_column, r.last_timestamp) for r in noted} == {
        (None, None), ("Date", "2016-09-09"), ("Date", "2016-10-01"),
    }


def test_broken_lines_are_stored_once_and_counted(spark, tmp_path):
    lake, source = Lake(spark, str(tmp_path / "lake")), catalog.SALES
    file = tmp_path / "sales.csv"
    good, wrong = line("9/9/2016", "Ann", "Acme", "Lead", 10), line("9/10/2016", "Ann", "Acme", "Lead", "ten")
    loose = "no date,at all"

    def run(*lines):
        file.write_text("\n".join([SALES_HEADER, *lines]) + "\n")
        return lake.ingest(source, str(file))

    assert run(good, wrong, loose).rows == 1
    broken = lake.table(source.bronze_table + BROKEN)
    assert bag(broken.read().select("_record", "_reason")) == [
        (wrong, "Forecasted Monthly Revenue: ten; Weighted Revenue: ten"), (loose, "fewer than 12 cells"),
    ]
    undated = line("soon", "Ann", "Acme", "Lead", 10)
    later, worse = line("10/1/2016", "Bob", "Bolt", "Lead", 1), line("10/2/2016", "Bob", "Bolt", "Lead", "1") + ",x"
    assert run(good, wrong, loose, later, worse, undated, "other,thing").rows == 1
    assert broken.read().count() == 4 and lake.table(source.bronze_table).read().count() == 2
    notes = lake.log.rows().where("status = 'COMPLETED'").orderBy("event_time").collect()
    assert json.loads(notes[0].metadata) == {"broken_records": 2}
    found = json.loads(notes[1].metadata)
    assert (found["broken_records"], found["unreadable"], found["last_timestamp"]) == (2, 1, "2016-09-09")
    # the report comes from the pass that wrote the rows
    load, report = lake.refine(source)
    assert load.rows == 2 and "bronze" not in report._jdf.queryExecution().toString() and report.collect() == []


def test_lake_of_related_files(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    files = {
        "salespeople": "salesperson,salesperson_id\n Ann ,p1\nBob,p2\n,p3\n",
        "leads": "lead_name,segment,region,lead_id\nAcme,S1,EU,l1\n",
        "dates": "full_date,date_id,day,month,year,quarter\n1/5/2017,d1,5,1,2017,1\n2017-01-06,d2,6,1,2017,1\n",
        "sales_opportunities": (
            "date_id,target_close_id,salesperson_id,lead_id,forecasted_monthly_revenue,opportunity_stage,"
            "weighted_revenue,closed_opportunity,active_opportunity,latest_status_entry,opportunity_id\n"
            "d1,d2,p1,l1,10,Lead,5,false,true,true,o1\nd2,d2,p1,l1,-3,Lead,1,true,false,true,o2\n"
            "d2,d2,p1,l1,7.5,Lead,,true,false,true,o3\n"
        ),
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    done = lake.load({name: str(tmp_path / f"{name}.csv") for name in files})
    assert done["silver_sales_opportunities"].rows == 2 and done["gold_sales_summary"].committed
    assert bag(lake.table("silver_dates").read().select("date_id", "full_date")) == [
        ("d1", date(2017, 1, 5)), ("d2", date(2017, 1, 6)),
    ]
    row = lake.table("gold_sales_summary").read().first()
    assert (row.salesperson, row.total_opportunities, row.total_forecasted_revenue) == ("Ann", 2, Decimal("17.50"))
    assert (row.closed_opportunities, row.active_opportunities) == (1, 1)

    # a keyed source without watermark is merged as well: the old salesperson stays
    (tmp_path / "salespeople.csv").write_text("salesperson,salesperson_id\nAnnie,p1\nDot,p4\n")
    lake.ingest(catalog.SALESPEOPLE, str(tmp_path / "salespeople.csv"))
    lake.refine(catalog.SALESPEOPLE)
    people = lake.table("silver_salespeople").read()
    assert bag(people.select("salesperson_id", "salesperson")) == [("p1", "Annie"), ("p2", "Bob"), ("p4", "Dot")]
    (tmp_path / "dates.csv").write_text(files["dates"] + "2017-02-01,d2,1,2,2017,1\n")
    lake.ingest(catalog.DATES, str(tmp_path / "dates.csv"))
    lake.refine(catalog.DATES)
    assert bag(lake.table("silver_dates").read().select("date_id", "full_date")) == [
        ("d1", date(2017, 1, 5)), ("d2", date(2017, 2, 1)),
    ]


def test_failed_loads_are_logged(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.ingest(catalog.LEADS, str(tmp_path / "absent.csv"))
    last = runlog.run_history(runlog.run_state(lake.log.rows())).first()
    assert last.status == "FAILED" and "PATH_NOT_FOUND" in last.error and last.end_time is not None


def test_run_state_and_history(spark):
    note = runlog.increment_note("d", "2017-01-01", True)
    assert runlog.increment_note("d", None, False) is None and json.loads(note)["incremental_column"] == "d"

    def entry(run, minute, status, records=0, error=None, metadata=None):
        return (run, "load", "s", "t", datetime(2024, 1, 1, 10, minute), status, records, error, "full", metadata)

    log = spark.createDataFrame(
        [
            entry("a", 0, "RUNNING"), entry("a", 2, "COMPLETED", 7, metadata=note),
            entry("b", 5, "RUNNING"), entry("b", 5, "FAILED", error="no"), entry("c", 9, "RUNNING"),
        ],
        runlog.LOG_SCHEMA,
    )
    history = runlog.run_history(runlog.run_state(log), limit=10).collect()
    assert [(r.run_id, r.status, r.duration_seconds, r.error) for r in history] == [
        ("c", "RUNNING", None, None), ("b", "FAILED", 0.0, "no"), ("a", "COMPLETED", 120.0, None),
    ]
    assert history[2].last_timestamp == "2017-01-01" and history[2].records_processed == 7


def test_exploration(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "n int, t string")
    assert bag(explore.preview(df, 2, ["n"])) == [(3, "n, t", 1, "a"), (3, "n, t", 2, "b")]
    tables = {"gold_x": df, "bronze.y": df, "misc": df, "silver_z": df.limit(0)}
    overview = explore.overview(tables).collect()
    assert [(r.layer, r.table_name, r.row_count) for r in overview] == [
        ("Bronze", "y", 3), ("Silver", "silver_z", 0), ("Gold", "gold_x", 3), ("Other", "misc", 3),
    ]
    assert [r.table_name for r in explore.overview(tables, "gold").collect()] == ["gold_x"]
    assert explore.samples(tables, rows=1, columns=1)["gold_x"].count() == 1
    assert bag(explore.profile(df)) == [(1, "n", "int", 3), (2, "t", "string", 3)]
    df.createOrReplaceTempView("gold_probe")
    assert explore.catalog_tables(spark)["gold_probe"].count() == 3


def test_database_options():
    schema = T.StructType(
        [T.StructField("a b", T.LongType()), T.StructField("c", T.DecimalType(18, 2)), T.StructField("d", T.DateType())]
    )
    types = jdbc.sql_column_types(schema)
    assert types == {"a b": "BIGINT", "c": "DECIMAL(18,2)", "d": "DATE"}
    options = jdbc.write_options("jdbc:x", "t", user="u", replace=True, column_types=types)
    assert options["truncate"] == "true" and options["createTableColumnTypes"] == "`a b` BIGINT, `c` DECIMAL(18,2), `d` DATE"
    assert "password" not in options and options["numPartitions"] == "8"
    assert jdbc.upsert_statement("g.t", "g.t_temp", ["id", "v"], "id") == (
        'INSERT INTO g.t ("id", "v") SELECT "id", "v" FROM g.t_temp ON CONFLICT ("id") DO UPDATE SET "v" = EXCLUDED."v"'
    )
    assert jdbc.upsert_statement("t", "s", ["id"], "id").endswith("DO NOTHING")
    with pytest.raises(ValueError):
        jdbc.sql_column_types(T.StructType([T.StructField("a", T.ArrayType(T.LongType()))]))


def test_a_rewritten_table_is_read_with_its_new_columns(spark, tmp_path):
    path = str(tmp_path / "region.parquet")
    spark.range(2).write.parquet(path)
    assert read_table(spark, str(tmp_path), "region").columns == ["id"]
    spark.range(3).withColumn("name", F.lit("x")).write.mode("overwrite").parquet(path)
    rewritten = read_table(spark, str(tmp_path), "region")
    assert rewritten.columns == ["id", "name"] and rewritten.count() == 3
