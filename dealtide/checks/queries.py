"""One registered query per operator, each over whole tables of a test data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.functions.columns import parse_date, row_count
from dealtide.operators import explore, increments, merge, quality, runlog
from dealtide.operators.numbering import number_rows
from dealtide.operators.transforms import apply_transforms
from dealtide.plans import dashboard, marts, star
from dealtide.plans.loads import BROKEN, FACT, REJECTED, Lake
from dealtide.plans.sales_view import LINE_KEY, normalized_from_sales, read_table, sales_from_orders
from dealtide.plans.silver import to_silver
from dealtide.scratch import folder_exists, materialize, scratch_path
from dealtide.sinks.files import export_reports, write_csv, write_parquet
from dealtide.sources import catalog
from dealtide.sources.catalog import SALES_FILE_COLUMNS
from dealtide.sources.files import REASON, RECORD, read_csv, read_source, register_views
from dealtide.sources.tables import Table, greatest
from dealtide.streaming.available_now import file_stream, merge_stream, newest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Where a table is split into what was there and what comes later.
CUT = "1999-06-15"
AS_OF = "2001-08-01"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _stored_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The sales as a stored silver table, for queries that read them several times."""
    return materialize(sales_from_orders(spark, folder), "sales")


# ---- star schema -------------------------------------------------------------------


@query
def dim_salesperson(spark, folder):
    return star.dim_salesperson(sales_from_orders(spark, folder))


@query
def dim_lead(spark, folder):
    return star.dim_lead(sales_from_orders(spark, folder))


@query
def dim_lead_by_triple(spark, folder):
    return star.dim_lead(sales_from_orders(spark, folder), key_by="triple")


@query
def dim_key_check(spark, folder):
    """Lead names that occur with more than one segment or region."""
    sales = sales_from_orders(spark, folder)
    by_close = sales.withColumn("segment", F.when(F.col("closed_opportunity"), "done").otherwise(F.col("segment")))
    return star.repeated_keys(star.dim_lead(by_close), "lead_id")


@query
def dim_date(spark, folder):
    return star.dim_date(sales_from_orders(spark, folder))


@query
def dim_stage(spark, folder):
    return star.dim_stage(sales_from_orders(spark, folder))


@query
def fact_sales(spark, folder):
    return star.fact_sales(sales_from_orders(spark, folder), tie_break=LINE_KEY)


@query
def fact_sales_stored(spark, folder):
    """The fact of a stored sales table, whose rows need not be written again."""
    return star.fact_sales(_stored_sales(spark, folder), tie_break=LINE_KEY)


@query
def star_join(spark, folder):
    sales = _stored_sales(spark, folder)
    people, leads, dates, stages = (
        materialize(build(sales), build.__name__)
        for build in (star.dim_salesperson, star.dim_lead, star.dim_date, star.dim_stage)
    )
    return star.star_join(star.fact_rows(sales), people, leads, dates, stages)


@query
def star_join_moving_leads(spark, folder):
    """Leads change their segment once a deal is closed; each fact still meets one of them."""
    moved = F.when(F.col("closed_opportunity"), "done").otherwise(F.col("segment"))
    sales = materialize(sales_from_orders(spark, folder).withColumn("segment", moved), "sales")
    leads = materialize(star.dim_lead(sales, key_by="triple"), "dim_lead")
    people, dates, stages = (
        materialize(build(sales), build.__name__) for build in (star.dim_salesperson, star.dim_date, star.dim_stage)
    )
    return star.star_join(star.fact_rows(sales, key_by="triple"), people, leads, dates, stages)


# ---- aggregate tables --------------------------------------------------------------


def _mart(mart: marts.Mart) -> Query:
    return lambda spark, folder: mart.with_ids(mart.build(sales_from_orders(spark, folder)))


QUERIES["sales_summary"] = _mart(marts.SALES_SUMMARY)
QUERIES["region_summary"] = _mart(marts.REGION_SUMMARY)
QUERIES["funnel"] = _mart(marts.FUNNEL)
QUERIES["monthly_trends"] = _mart(marts.TRENDS)
QUERIES["lead_scoring"] = _mart(marts.LEAD_SCORING)
QUERIES["lead_scoring_any_won"] = _mart(marts.LEAD_SCORING_ANY_WON)


@query
def performance(spark, folder):
    """Deviations are rounded: their last digits depend on the order of the rows."""
    mart = marts.PERFORMANCE
    built = mart.build(sales_from_orders(spark, folder))
    return mart.with_ids(built.withColumn("deal_size_variance", F.round("deal_size_variance", 4)))


@query
def sales_summary_normalized(spark, folder):
    parts = normalized_from_sales(_stored_sales(spark, folder))
    people, leads, dates = (materialize(parts[n], n) for n in ("salespeople", "leads", "dates"))
    return marts.summary_of_normalized(parts["sales_opportunities"], people, leads, dates)


@query
def gold_by_sql(spark, folder):
    """Gold as SQL text over a registered silver view."""
    register_views({"silver_sales": sales_from_orders(spark, folder)})
    return spark.sql(
        """
        SELECT region, count(*) AS opportunities, count_if(closed_opportunity) AS closed
        FROM silver_sales WHERE region IS NOT NULL GROUP BY region
        """
    )


# ---- reports -----------------------------------------------------------------------


@query
def kpi_summary(spark, folder):
    sales = sales_from_orders(spark, folder)
    return dashboard.kpi_summary(star.fact_rows(sales), star.dim_date(sales))


@query
def kpi_summary_range(spark, folder):
    sales = _stored_sales(spark, folder)
    dates = materialize(star.dim_date(sales), "dim_date")
    return dashboard.kpi_summary(star.fact_rows(sales), dates, "1996-01-01", "1998-12-31")


def _top(metric: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return dashboard.top_performers(marts.PERFORMANCE.build(sales_from_orders(spark, folder)), metric)

    return run


QUERIES["top_performers"] = _top("total_revenue")
QUERIES["top_performers_by_win_rate"] = _top("win_rate")
QUERIES["top_performers_by_deals"] = _top("deal_count")
QUERIES["top_performers_by_pipeline"] = _top("pipeline_value")


@query
def regional(spark, folder):
    return dashboard.regional_performance(marts.REGION_SUMMARY.build(sales_from_orders(spark, folder)))


@query
def regional_legacy(spark, folder):
    return dashboard.regional_performance(marts.REGION_SUMMARY.build(sales_from_orders(spark, folder)), True)


@query
def segment_analysis(spark, folder):
    return dashboard.segment_analysis(marts.REGION_SUMMARY.build(sales_from_orders(spark, folder)))


@query
def segment_analysis_legacy(spark, folder):
    return dashboard.segment_analysis(marts.REGION_SUMMARY.build(sales_from_orders(spark, folder)), True)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means of means depend on the order of their terms in the last digits."""
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query
def funnel_stage(spark, folder):
    rows = dashboard.funnel_by_stage(marts.FUNNEL.build(sales_from_orders(spark, folder)))
    return _rounded(rows, "avg_opportunity_size", "avg_days_to_close")


@query
def funnel_stage_weighted(spark, folder):
    rows = dashboard.funnel_by_stage(marts.FUNNEL.build(sales_from_orders(spark, folder)), weighted=True)
    return _rounded(rows, "avg_opportunity_size", "avg_days_to_close")


@query
def trend_rollup(spark, folder):
    return dashboard.trend_rollup(marts.TRENDS.build(sales_from_orders(spark, folder)), AS_OF)


@query
def trend_rollup_exact(spark, folder):
    trends = marts.TRENDS.build(sales_from_orders(spark, folder))
    return dashboard.trend_rollup(trends, AS_OF, last_months=6, exact_months=True, weighted=True)


@query
def lead_insights(spark, folder):
    return dashboard.lead_insights(marts.LEAD_SCORING.build(sales_from_orders(spark, folder)))


@query
def lead_insights_high(spark, folder):
    return dashboard.lead_insights(marts.LEAD_SCORING.build(sales_from_orders(spark, folder)), "High")


@query
def exec_summary(spark, folder):
    sales = _stored_sales(spark, folder)
    return dashboard.executive_summary(
        star.fact_rows(sales),
        star.dim_date(sales),
        marts.PERFORMANCE.build(sales),
        marts.REGION_SUMMARY.build(sales),
        marts.FUNNEL.build(sales),
    )


# ---- transforms and cleaning -------------------------------------------------------


@query
def clean_columns(spark, folder):
    padded = read_table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("Lead Name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("segment"),
    )
    steps = [{"type": "clean_column", "column": c} for c in ("Lead Name", "segment")]
    return apply_transforms(padded, [*steps, {"type": "rename_column", "from": "Lead Name", "to": "lead_name"}])


@query
def type_conversion(spark, folder):
    """Numbers as text, some of them no numbers."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    texts = read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(price).alias("price"),
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        (F.col("o_orderstatus") == "O").cast("string").alias("is_open"),
    )
    return apply_transforms(
        texts,
        [
            {"type": "type_conversion", "column": "price", "to_type": "double"},
            {"type": "type_conversion", "column": "customer", "to_type": "bigint"},
            {"type": "type_conversion", "column": "is_open", "to_type": "boolean"},
        ],
    )


def _date_text() -> Column:
    """Order dates as text, urgent orders in another layout than the rest."""
    day = F.to_date("o_orderdate")
    other = F.col("o_orderpriority") == "1-URGENT"
    return F.when(other, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "M/d/yyyy"))


def _dated_text(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select("o_orderkey", _date_text().alias("date_text"))


@query
def date_conversion(spark, folder):
    rows = _dated_text(spark, folder).withColumn("order_date", F.col("date_text"))
    return apply_transforms(rows, [{"type": "date_conversion", "column": "order_date", "from_format": "M/d/yyyy"}])


@query
def date_conversion_formats(spark, folder):
    rows = _dated_text(spark, folder)
    return rows.select("o_orderkey", parse_date(F.col("date_text")).alias("order_date"))


@query
def drop_rename(spark, folder):
    return apply_transforms(
        read_table(spark, folder, "supplier"),
        [
            {"type": "rename_column", "from": "s_name", "to": "salesperson"},
            {"type": "drop_column", "column": "s_acctbal"},
            {"type": "drop_column", "column": "not_there"},
        ],
    )


def _raw_sales(sales: DataFrame, *more: str) -> DataFrame:
    """The sales under the column names and in the layouts of the raw file, and some columns as they are."""
    text_dates = {"sale_date", "target_close"}
    return sales.select(
        [
            (F.date_format(new, "M/d/yyyy") if new in text_dates else F.col(new)).alias(raw)
            for raw, (_, new) in SALES_FILE_COLUMNS.items()
        ]
        + list(more)
    )


@query
def declarative_silver(spark, folder):
    """Padded names, unreadable dates and missing leads through the declared cleaning."""
    stage = F.col("Opportunity Stage")
    raw = _raw_sales(sales_from_orders(spark, folder)).withColumns(
        {
            "Salesperson": F.concat(F.lit(" "), "Salesperson", F.lit("  ")),
            "Lead Name": F.when((F.col("Region") != "EUROPE") | (stage != "Lead"), F.col("Lead Name")),
            "Target Close": F.when(stage != "Prospect", F.col("Target Close")).otherwise("13/45/2017"),
        }
    )
    return to_silver(raw, catalog.SALES).rows


def _silver(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        raw = normalized_from_sales(sales_from_orders(spark, folder))[name]
        for c in ("salesperson", "lead_name", "segment", "region"):
            if c in raw.columns:
                raw = raw.withColumn(c, F.concat(F.lit(" "), c, F.lit(" ")))
        return to_silver(raw, catalog.SOURCES[name]).rows

    return run


QUERIES["silver_salespeople"] = _silver("salespeople")
QUERIES["silver_leads"] = _silver("leads")
QUERIES["silver_dates"] = _silver("dates")
QUERIES["silver_opportunities"] = _silver("sales_opportunities")


# ---- quality rules -----------------------------------------------------------------


RULES = (
    {"column": "priority", "rule_type": "not_null"},
    {"column": "price", "rule_type": "greater_than", "value": 50000},
    {"column": "price", "rule_type": "greater_than_equal", "value": 100000},
    {"column": "priority", "rule_type": "regex", "pattern": "^[1-3]-"},
    {"column": "date_text", "rule_type": "date_format", "format": "M/d/yyyy"},
)


def _holed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with missing priorities and prices and dates in two layouts."""
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        _date_text().alias("date_text"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )


def _kept(rule: int) -> Query:
    return lambda spark, folder: quality.kept(_holed_orders(spark, folder), [RULES[rule]])


QUERIES["dq_not_null"] = _kept(0)
QUERIES["dq_gt"] = _kept(1)
QUERIES["dq_gte"] = _kept(2)
QUERIES["dq_regex"] = _kept(3)
QUERIES["dq_date_format"] = _kept(4)


@query
def dq_all_rules(spark, folder):
    return quality.kept(_holed_orders(spark, folder), RULES)


@query
def dq_report(spark, folder):
    return quality.report(_holed_orders(spark, folder), RULES)


@query
def dq_quarantine(spark, folder):
    rows = quality.quarantine(_holed_orders(spark, folder), RULES)
    return rows.withColumn("failed_rules", F.concat_ws("; ", "failed_rules"))


# ---- increments and merges ---------------------------------------------------------

LINE = ["l_orderkey", "l_linenumber"]


def _line_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as versions of (order, line); this pair occurs several times."""
    return read_table(spark, folder, "lineitem").select(
        *LINE, F.to_date("l_shipdate").alias("changed_on"), "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )


def _before_and_after(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = _line_versions(spark, folder)
    cut = F.lit(CUT).cast("date")
    before = merge.newest_per_key(rows.where(F.col("changed_on") <= cut), LINE, ["changed_on"])
    return before, rows.where(F.col("changed_on") > cut)


@query
def merge_upsert(spark, folder):
    before, after = _before_and_after(spark, folder)
    return merge.merge_rows(before, after, LINE, ["changed_on"])


@query
def merge_new_rows(spark, folder):
    return merge.new_rows(*_before_and_after(spark, folder), LINE)


@query
def merge_updates(spark, folder):
    return merge.updating_rows(*_before_and_after(spark, folder), LINE)


@query
def merge_by_partition(spark, folder):
    """Last order per customer and year, kept in a folder per year."""
    keys = ["order_year", "o_custkey"]
    orders = read_table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("order_year"),
        "o_custkey",
        F.to_date("o_orderdate").alias("order_date"),
        "o_orderkey",
        "o_totalprice",
    )
    cut = F.lit(CUT).cast("date")
    path = scratch_path(spark, "last-orders")
    first = merge.newest_per_key(orders.where(F.col("order_date") <= cut), keys, ["order_date"])
    write_parquet(first, path, partition_by=["order_year"])
    later = orders.where(F.col("order_date") > cut)
    merge.merge_partitions(spark.read.parquet(path), path, later, keys, ["order_year"], ["order_date"])
    return spark.read.parquet(path).select(*keys, "order_date", "o_orderkey", "o_totalprice")


@query
def append_increment(spark, folder):
    """A first load, then what is past its watermark; a repeated load adds nothing."""
    orders = read_table(spark, folder, "orders").withColumn("order_date", F.to_date("o_orderdate")).drop("o_orderdate")
    table = Table(spark, scratch_path(spark, "bronze_orders"))
    first = orders.where(F.col("order_date") <= F.lit(CUT).cast("date"))
    table.append(first, mark=greatest(first, "order_date"))
    for _ in range(2):
        last = table.mark("order_date")
        rows = increments.increment(orders, "order_date", last)
        table.append(rows, mark=greatest(rows, "order_date", last))
    return table.read()


@query
def incremental_filter(spark, folder):
    return increments.increment(read_table(spark, folder, "orders"), "o_orderdate", f"{CUT} 00:00:00")


@query
def incremental_filter_lookback(spark, folder):
    return increments.increment(read_table(spark, folder, "orders"), "o_orderdate", f"{CUT} 00:00:00", 30)


def _refreshed(mart: marts.Mart) -> Query:
    """The table of the earlier sales, brought up to date by the later ones."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        sales = _stored_sales(spark, folder)
        cut = F.lit(CUT).cast("date")
        current = materialize(mart.build(sales.where(F.col("sale_date") <= cut)), "current")
        return mart.refresh(current, sales, sales.where(F.col("sale_date") > cut))

    return run


def _folded(mart: marts.Mart) -> Query:
    """The stored state of the earlier sales merged with that of the later ones; the earlier sales are read once only."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        sales = _stored_sales(spark, folder)
        cut = F.lit(CUT).cast("date")
        before, after = sales.where(F.col("sale_date") <= cut), sales.where(F.col("sale_date") > cut)
        kept = {c: materialize(mart.pairs(before, c), "pairs") for c in mart.distinct}
        state = materialize(mart.with_counts(mart.partial(before), kept), "state")
        more = mart.with_counts(mart.partial(after), {c: mart.new_pairs(kept[c], after, c) for c in kept})
        found = mart.finished(mart.merged(state, more))
        rounded = {c: F.round(c, 4) for c in found.columns if c == "deal_size_variance"}
        return found.withColumns(rounded)

    return run


QUERIES["mart_state_summary"] = _folded(marts.SALES_SUMMARY)
QUERIES["mart_state_regions"] = _folded(marts.REGION_SUMMARY)
QUERIES["mart_state_performance"] = _folded(marts.PERFORMANCE)
QUERIES["mart_state_funnel"] = _folded(marts.FUNNEL)
QUERIES["mart_state_trends"] = _folded(marts.TRENDS)
QUERIES["mart_state_leads"] = _folded(marts.LEAD_SCORING)

QUERIES["incremental_gold"] = _refreshed(marts.TRENDS)
QUERIES["incremental_gold_leads"] = _refreshed(marts.LEAD_SCORING)


@query
def watermark_upsert(spark, folder):
    """Marks of two tables; one of them moves on, a third table is added."""
    orders = read_table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("o_orderdate"))
    lines = read_table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("l_shipdate"))
    events = read_table(spark, folder, "events").select(F.to_date("ts").alias("ts"))
    cut = F.lit(CUT).cast("date")
    current = increments.watermark_row(orders.where(F.col("o_orderdate") <= cut), "orders", "o_orderdate").unionByName(
        increments.watermark_row(lines.where(F.col("l_shipdate") <= cut), "lineitem", "l_shipdate")
    )
    updates = increments.watermark_row(orders, "orders", "o_orderdate").unionByName(
        increments.watermark_row(events, "events", "ts")
    )
    return increments.upsert_watermarks(current, updates)


@query
def stream_available_now(spark, folder):
    """Newest event per user, merged from a file stream; the second run finds nothing new."""
    schema = read_table(spark, folder, "events").schema
    table = Table(spark, scratch_path(spark, "user-state"))
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):
        stream = file_stream(spark, f"{folder}/events.parquet*", schema)
        merge_stream(stream, table, ["user_id"], ["ts", "event_id"], checkpoint)
    return table.read()


def _two_exports(sales: DataFrame, change: Callable[[DataFrame], DataFrame] = lambda raw: raw) -> tuple[str, str]:
    """Paths of two exports of the sales file: the earlier sales, and all. They are written once, the second path takes in the files of the first."""
    spark, path = sales.sparkSession, scratch_path(sales.sparkSession, "export")
    later = ~F.coalesce(F.col("sale_date") <= F.lit(CUT).cast("date"), F.lit(False))
    raw = change(_raw_sales(sales.withColumn("late", later), "late"))
    write_csv(raw, path, partition_by=["late"], codec="gzip")
    for side in ("late=false", "late=true"):
        if not folder_exists(spark, f"{path}/{side}"):
            write_csv(spark.createDataFrame([], raw.drop("late").schema), f"{path}/{side}")
    return f"{path}/late=false", f"{path}/late=*"


def _lake_of_two_loads(spark: SparkSession, folder: str, build: Callable[[Lake], object]) -> Lake:
    """Two exports of the sales file, the earlier sales and all, through bronze and silver; gold is built after each."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    for path in _two_exports(sales_from_orders(spark, folder)):
        lake.ingest(catalog.SALES, path)
        lake.refine(catalog.SALES)
        build(lake)
    return lake


def _late_events(spark: SparkSession, folder: str, run: Callable[[DataFrame, Table, str], None]) -> DataFrame:
    """Newest event per user; the files with the later half of the events arrive first, the others one run later."""
    events = read_table(spark, folder, "events")
    middle = events.agg(F.percentile_approx("ts", 0.5)).scalar()
    marked = materialize(events.withColumn("late", F.col("ts") <= middle), "events")
    files, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "stream")
    table = Table(spark, scratch_path(spark, "user-state"))
    for late in (False, True):
        marked.where(F.col("late") == late).drop("late").write.mode("append").parquet(files)
        run(file_stream(spark, files, events.schema), table, checkpoint)
    return table.read()


@query
def stream_late_files(spark, folder):
    """Late files merged into buckets of the users; what is stored may be newer and then stays."""
    return _late_events(spark, folder, lambda s, t, c: merge_stream(s, t, ["user_id"], ["ts", "event_id"], c, buckets=8))


@query
def stream_state(spark, folder):
    """The same with the newest event of each user in the state store."""
    return _late_events(spark, folder, lambda s, t, c: newest_stream(s, t, ["user_id"], ["ts", "event_id"], c, buckets=8))


@query
def merge_buckets(spark, folder):
    """Line items kept in buckets of their key; the later ones are merged into those they meet."""
    rows = _line_versions(spark, folder)
    cut = F.lit(CUT).cast("date")
    table = Table(spark, scratch_path(spark, "line-state"))
    for part in (rows.where(F.col("changed_on") <= cut), rows.where(F.col("changed_on") > cut)):
        table.merge(part, LINE, ["changed_on"], buckets=16)
    return table.read()


@query
def lake_load(spark, folder):
    """Two exports of the sales file through bronze and silver into a gold table."""
    return _lake_of_two_loads(spark, folder, lambda lake: lake.build_mart(marts.TRENDS)).table(marts.TRENDS.name).read()


@query
def lake_performance(spark, folder):
    """The performance table after two loads, from its stored state and the increment."""
    mart = marts.PERFORMANCE
    built = _lake_of_two_loads(spark, folder, lambda lake: lake.build_mart(mart)).table(mart.name).read()
    return built.withColumn("deal_size_variance", F.round("deal_size_variance", 4))


@query
def lake_fact(spark, folder):
    """The fact after two loads: the later sales are numbered by themselves and added."""
    return _lake_of_two_loads(spark, folder, lambda lake: lake.build_fact()).table(FACT).read()


@query
def lake_dim_lead(spark, folder):
    """The leads after two loads: those only the later sales have are added."""
    return _lake_of_two_loads(spark, folder, lambda lake: lake.build_dimension("gold_dim_lead")).table("gold_dim_lead").read()


@query
def lake_rejected(spark, folder):
    """Rows that the rules of silver reject in two exports of the sales file, each once."""
    sales = sales_from_orders(spark, folder)
    known = F.when((F.col("region") != "EUROPE") | (F.col("opportunity_stage") != "Lead"), F.col("lead_name"))
    sales = sales.withColumn("lead_name", known)
    lake = Lake(spark, scratch_path(spark, "lake"))
    for path in _two_exports(sales):
        lake.ingest(catalog.SALES, path)
        lake.refine(catalog.SALES)
    names = [new for _, new in SALES_FILE_COLUMNS.values()]
    rejected = lake.table(catalog.SALES.silver_table + REJECTED).read()
    return rejected.select(*names, F.concat_ws("; ", "failed_rules").alias("failed_rules"))


@query
def lake_report(spark, folder):
    """The quality report that the refining of a whole export gives, counted while its rows are written."""
    path = scratch_path(spark, "export")
    raw = _raw_sales(sales_from_orders(spark, folder))
    people = F.when(F.col("Region") != "ASIA", F.col("Salesperson"))
    write_csv(raw.withColumn("Lead Name", F.when(F.col("Segment") != "BUILDING", F.col("Lead Name"))).withColumn("Salesperson", people), path, codec="gzip")
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.ingest(catalog.SALES, path)
    return lake.refine(catalog.SALES)[1]


@query
def lake_broken(spark, folder):
    """Lines of two exports whose revenue is no number, each once, as they stand in the files."""
    revenue = F.col("Forecasted Monthly Revenue").cast("string")
    spoilt = (F.col("Region") == "EUROPE") & (F.col("Opportunity Stage") == "Lead")
    paths = _two_exports(
        sales_from_orders(spark, folder), lambda raw: raw.withColumn("Forecasted Monthly Revenue", F.when(spoilt, "n/a").otherwise(revenue))
    )
    lake = Lake(spark, scratch_path(spark, "lake"))
    for path in paths:
        lake.ingest(catalog.SALES, path)
    return lake.table(catalog.SALES.bronze_table + BROKEN).read().select(F.col(RECORD).alias("record"), F.col(REASON).alias("reason"))


@query
def append_drift(spark, folder):
    """Three appends to a table: columns come and go, keys and prices get wider types, and one comes back narrower."""
    orders = read_table(spark, folder, "orders").withColumn("order_date", F.to_date("o_orderdate")).drop("o_orderdate")
    table = Table(spark, scratch_path(spark, "drifting"))
    day = F.col("order_date")
    first, second = F.lit("1997-01-01").cast("date"), F.lit(CUT).cast("date")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    early = orders.where(day < first).withColumns({"o_orderkey": F.col("o_orderkey").cast("int"), "o_totalprice": price})
    table.append(early.drop("o_orderpriority"))
    middle = orders.where((day >= first) & (day < second)).withColumn("o_totalprice", price.cast("decimal(18,4)"))
    table.append(middle.drop("o_custkey"))
    late = orders.where(day >= second).withColumns({"o_totalprice": price, "o_custkey": F.col("o_custkey").cast("int")})
    table.append(late.drop("o_orderstatus"))
    return table.read()


# ---- sources and sinks -------------------------------------------------------------


@query
def csv_broken(spark, folder):
    """Lines with too many cells, too few, and a price that is no number, beside sound ones."""
    key = F.col("o_orderkey") % 7
    price = F.when(key == 2, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    cells = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", price)
    line = F.when(key == 3, F.concat_ws(",", "o_orderkey", "o_custkey")).when(key == 1, F.concat(cells, F.lit(",more"))).otherwise(cells)
    path = scratch_path(spark, "broken-csv")
    read_table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    columns = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "decimal(12,2)"}
    return read_csv(spark, path, columns, header=False, broken=True).withColumnsRenamed({RECORD: "record", REASON: "reason"})


@query
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "sales-csv")
    write_csv(_raw_sales(sales_from_orders(spark, folder)), path)
    return to_silver(read_source(spark, "csv", path, catalog.SALES.columns), catalog.SALES).rows


@query
def csv_inferred(spark, folder):
    path = scratch_path(spark, "customer-csv")
    write_csv(read_table(spark, folder, "customer"), path)
    return read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query
def json_source(spark, folder):
    path = scratch_path(spark, "orders-json")
    orders = read_table(spark, folder, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "MM/dd/yyyy"))
    orders.write.json(path)
    columns = {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "date",
        "o_orderpriority": "string",
    }
    return read_source(spark, "json", path, columns)


@query
def parquet_partitioned(spark, folder):
    path = scratch_path(spark, "orders-by-status")
    orders = read_table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    write_parquet(orders, path, partition_by=["o_orderstatus"])
    return read_source(spark, "parquet", path)


@query
def csv_report(spark, folder):
    """The segment report, exported next to others and read back."""
    sales = _stored_sales(spark, folder)
    regions = materialize(marts.REGION_SUMMARY.build(sales), "regions")
    written = export_reports(
        {
            "regional_performance": dashboard.regional_performance(regions),
            "segment_analysis": dashboard.segment_analysis(regions),
            "nothing": regions.where("region = 'no such region'"),
        },
        scratch_path(spark, "reports"),
    )
    columns = {
        "segment": "string",
        "region": "string",
        "total_opportunities": "bigint",
        "total_pipeline": "decimal(28,2)",
        "avg_deal_size": "double",
        "closed_deals": "bigint",
        "close_rate": "double",
    }
    return read_csv(spark, written["segment_analysis"], columns)


# ---- exploration and run log -------------------------------------------------------


@query
def table_preview(spark, folder):
    orders = read_table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return explore.preview(orders, 10, ["o_orderkey"])


@query
def warehouse_overview(spark, folder):
    sales = _stored_sales(spark, folder)
    names = ("lineitem", "orders", "events")
    tables = {f"bronze_{n}": read_table(spark, folder, n) for n in names}
    tables["silver_sales"] = sales
    tables["gold_dim_lead"] = star.dim_lead(sales)
    tables["gold_dim_opportunity_stage"] = star.dim_stage(sales)
    tables["customer"] = read_table(spark, folder, "customer")
    return explore.overview(tables)


@query
def source_profile(spark, folder):
    path = scratch_path(spark, "customer-csv")
    write_csv(read_table(spark, folder, "customer"), path)
    return explore.profile(read_csv(spark, path))


def _run_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A run log from the events: a run is what one user did on one day."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", runlog.COMPLETED).when(kind == "error", runlog.FAILED).otherwise(runlog.RUNNING)
    day = F.to_date("ts").cast("string")
    note = F.to_json(
        F.struct(
            F.lit("ts").alias("incremental_column"), day.alias("last_timestamp"), F.lit(True).alias("filtered_records")
        )
    )
    return read_table(spark, folder, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), day).alias("run_id"),
        F.concat(F.lit("weekday-"), F.dayofweek("ts").cast("string")).alias("pipeline_id"),
        F.lit("events").alias("source_name"),
        F.lit("runs").alias("destination_name"),
        F.col("ts").cast("timestamp").alias("event_time"),
        status.alias("status"),
        F.get_json_object("props", "$.k").cast("bigint").alias("records_processed"),
        F.when(kind == "error", F.concat(F.lit("event "), F.col("event_id").cast("string"))).alias("error"),
        F.when(kind == "signup", "full").otherwise("incremental").alias("load_type"),
        F.when(kind != "signup", note).alias("metadata"),
    )


def _plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


@query
def run_state(spark, folder):
    return _plain_times(runlog.run_state(_run_rows(spark, folder))).drop("metadata")


@query
def run_history(spark, folder):
    history = runlog.run_history(runlog.run_state(_run_rows(spark, folder)), limit=20)
    return _plain_times(history).drop("metadata")


@query
def run_history_of_one(spark, folder):
    history = runlog.run_history(runlog.run_state(_run_rows(spark, folder)), "weekday-2", limit=10)
    return _plain_times(history).drop("metadata")


@query
def numbered_copies(spark, folder):
    """Dense numbers over rows that repeat: order statuses with their priorities."""
    rows = read_table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority")
    numbered = number_rows(rows, "row_no", ["o_orderstatus", "o_orderpriority"])
    return numbered.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.min("row_no").alias("first_no"), F.max("row_no").alias("last_no"), row_count().alias("copies")
    )
