"""The registered queries in SQL for another engine, to compare results with."""

from __future__ import annotations

CUT = "DATE '1999-06-15'"

SALES = """sales AS (
  SELECT CAST(o_orderdate AS DATE) AS sale_date, s_name AS salesperson, c_name AS lead_name,
    c_mktsegment AS segment, r_name AS region, CAST(l_shipdate AS DATE) AS target_close,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS forecast,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
      AS weighted,
    CASE WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN 'Closed Lost'
         WHEN o_orderstatus = 'F' THEN 'Closed Won'
         WHEN o_orderstatus = 'P' AND l_linestatus = 'F' THEN 'Contracting'
         WHEN o_orderstatus = 'P' THEN 'Qualified'
         WHEN l_linestatus = 'F' THEN 'Prospect' ELSE 'Lead' END AS stage,
    o_orderstatus = 'F' AS closed, o_orderstatus <> 'F' AS active, l_linestatus = 'O' AS latest,
    l_orderkey, l_linenumber, l_partkey, l_suppkey,
    date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

TRIPLE = """md5(length(lead_name) || ':' || lead_name || '|' || length(segment) || ':' || segment || '|'
    || length(region) || ':' || region)"""

TOTALS = """COUNT(*) AS total_opportunities,
    CAST(SUM(forecast) AS DECIMAL(28,2)) AS total_forecasted_revenue,
    CAST(SUM(weighted) AS DECIMAL(28,2)) AS total_weighted_revenue,
    COUNT(*) FILTER (closed) AS closed_opportunities"""

REGION_MART = f"""region_mart AS (
  SELECT region, segment, CAST(year(sale_date) AS BIGINT) AS year, CAST(month(sale_date) AS BIGINT) AS month,
    {TOTALS}
  FROM sales GROUP BY ALL
)"""

SUMMARY_MART = f"""summary_mart AS (
  SELECT salesperson AS salesperson_name, region, segment, {TOTALS},
    COUNT(*) FILTER (active) AS active_opportunities, AVG(days) AS avg_sales_cycle_days
  FROM sales GROUP BY ALL
)"""

PERFORMANCE_MART = """performance_mart AS (
  SELECT salesperson AS salesperson_name, region, segment, COUNT(*) AS total_leads,
    COUNT(*) FILTER (closed AND stage = 'Closed Won') AS won_deals,
    COUNT(*) FILTER (closed AND stage = 'Closed Lost') AS lost_deals,
    ROUND(COUNT(*) FILTER (closed AND stage = 'Closed Won') * 100e0 / NULLIF(COUNT(*) FILTER (closed), 0), 2)
      AS win_rate_percent,
    CAST(SUM(forecast) AS DECIMAL(28,2)) AS total_pipeline_value,
    CAST(COALESCE(SUM(forecast) FILTER (stage = 'Closed Won'), 0) AS DECIMAL(28,2)) AS actual_revenue,
    AVG(days) AS avg_sales_cycle_days,
    CAST(SUM(forecast) AS DOUBLE) / COUNT(*) AS avg_deal_size,
    ROUND(stddev_samp(CAST(forecast AS DOUBLE)), 4) AS deal_size_variance
  FROM sales GROUP BY ALL
)"""

FUNNEL_MART = """funnel_mart AS (
  SELECT stage AS stage_name, region, segment, COUNT(*) AS opportunity_count,
    CAST(SUM(forecast) AS DECIMAL(28,2)) AS stage_pipeline_value,
    CAST(SUM(weighted) AS DECIMAL(28,2)) AS stage_weighted_value,
    CAST(SUM(forecast) AS DOUBLE) / COUNT(*) AS avg_opportunity_value,
    AVG(days) AS avg_days_to_close,
    COUNT(*) FILTER (active) AS active_opportunities,
    COUNT(*) FILTER (latest) AS recent_activity_count
  FROM sales GROUP BY ALL
)"""

TRENDS_MART = """trends_mart AS (
  SELECT CAST(year(sale_date) AS BIGINT) AS year, CAST(month(sale_date) AS BIGINT) AS month, region,
    COUNT(*) AS new_opportunities,
    COUNT(*) FILTER (closed AND stage = 'Closed Won') AS deals_won,
    COUNT(*) FILTER (closed AND stage = 'Closed Lost') AS deals_lost,
    CAST(SUM(forecast) AS DECIMAL(28,2)) AS monthly_pipeline_added,
    CAST(COALESCE(SUM(forecast) FILTER (stage = 'Closed Won'), 0) AS DECIMAL(28,2)) AS monthly_revenue_won,
    CAST(SUM(forecast) AS DOUBLE) / COUNT(*) AS avg_monthly_deal_size,
    COUNT(DISTINCT salesperson) AS active_salespeople,
    COUNT(DISTINCT lead_name) AS unique_leads
  FROM sales GROUP BY ALL
)"""


def _scoring_mart(won: str) -> str:
    return f"""scoring_mart AS (
  SELECT lead_name, segment, region, salesperson AS assigned_salesperson,
    MAX(forecast) AS max_opportunity_value, COUNT(*) AS total_interactions,
    MAX(sale_date) AS last_interaction_date,
    date_diff('day', MIN(sale_date), MAX(sale_date)) AS engagement_duration_days,
    CASE WHEN bool_or(stage IN ('Qualified', 'Contracting')) THEN 'High'
         WHEN bool_or(stage = 'Prospect') THEN 'Medium' ELSE 'Low' END AS lead_score,
    CASE WHEN bool_or(active) THEN 'Active' ELSE 'Inactive' END AS status,
    CASE WHEN NOT bool_or(closed) THEN 'Open' WHEN {won} THEN 'Won' ELSE 'Lost' END AS final_outcome
  FROM sales GROUP BY ALL
)"""


SCORING_MART = _scoring_mart("MAX(stage) = 'Closed Won'")


def _numbered(mart: str, table: str, id_name: str, order: str) -> str:
    return f"WITH {SALES}, {mart} SELECT row_number() OVER (ORDER BY {order}) AS {id_name}, * FROM {table}"


def _top(column: str) -> str:
    return f"""WITH {SALES}, {PERFORMANCE_MART}
SELECT * EXCLUDE (deal_size_variance) FROM performance_mart
ORDER BY {column} DESC NULLS LAST, salesperson_name, region, segment LIMIT 10"""


def _regional(count: str) -> str:
    return f"""WITH {SALES}, {REGION_MART}
SELECT region, CAST({count} AS BIGINT) AS total_opportunities,
  CAST(SUM(total_forecasted_revenue) AS DECIMAL(28,2)) AS total_pipeline,
  CAST(SUM(closed_opportunities) AS BIGINT) AS deals_closed,
  ROUND(CAST(SUM(closed_opportunities) AS DOUBLE) * 100e0 / {count}, 2) AS close_rate
FROM region_mart GROUP BY region"""


def _segments(count: str) -> str:
    return f"""WITH {SALES}, {REGION_MART}
SELECT segment, region, CAST({count} AS BIGINT) AS total_opportunities,
  CAST(SUM(total_forecasted_revenue) AS DECIMAL(28,2)) AS total_pipeline,
  CAST(SUM(total_forecasted_revenue) AS DOUBLE) / COUNT(*) AS avg_deal_size,
  CAST(SUM(closed_opportunities) AS BIGINT) AS closed_deals,
  ROUND(CAST(SUM(closed_opportunities) AS DOUBLE) * 100e0 / {count}, 2) AS close_rate
FROM region_mart GROUP BY segment, region"""


STAGE_RANK = """CASE stage_name WHEN 'Lead' THEN 1 WHEN 'Prospect' THEN 2 WHEN 'Qualified' THEN 3
  WHEN 'Contracting' THEN 4 WHEN 'Closed Won' THEN 5 WHEN 'Closed Lost' THEN 6 ELSE 7 END"""


def _funnel_stage(size: str, days: str) -> str:
    return f"""WITH {SALES}, {FUNNEL_MART}
SELECT stage_name, CAST(SUM(opportunity_count) AS BIGINT) AS total_count,
  CAST(SUM(stage_pipeline_value) AS DECIMAL(28,2)) AS total_value,
  CAST(SUM(stage_weighted_value) AS DECIMAL(28,2)) AS weighted_value,
  ROUND({size}, 4) AS avg_opportunity_size, ROUND({days}, 4) AS avg_days_to_close,
  CAST({STAGE_RANK} AS BIGINT) AS stage_rank
FROM funnel_mart GROUP BY stage_name"""


def _trend_rollup(recent: str, size: str) -> str:
    return f"""WITH {SALES}, {TRENDS_MART}
SELECT year, month, region, CAST(SUM(new_opportunities) AS BIGINT) AS new_opportunities,
  CAST(SUM(deals_won) AS BIGINT) AS deals_won, CAST(SUM(deals_lost) AS BIGINT) AS deals_lost,
  CAST(SUM(monthly_revenue_won) AS DECIMAL(28,2)) AS revenue_won, {size} AS avg_deal_size
FROM trends_mart WHERE {recent} GROUP BY year, month, region"""


def _insights(condition: str) -> str:
    return f"""WITH {SALES}, {SCORING_MART}
SELECT * EXCLUDE (last_interaction_date) FROM scoring_mart WHERE {condition}
ORDER BY max_opportunity_value DESC, lead_name, segment, region, assigned_salesperson LIMIT 100"""


def _kpi(condition: str) -> str:
    return f"""WITH {SALES}
SELECT COUNT(*) AS total_opportunities,
  COUNT(*) FILTER (closed AND stage = 'Closed Won') AS won_deals,
  COUNT(*) FILTER (closed AND stage = 'Closed Lost') AS lost_deals,
  ROUND(COUNT(*) FILTER (closed AND stage = 'Closed Won') * 100e0 / NULLIF(COUNT(*) FILTER (closed), 0), 2)
    AS overall_win_rate,
  CAST(SUM(forecast) AS DECIMAL(28,2)) AS total_pipeline_value,
  CAST(SUM(forecast) FILTER (stage = 'Closed Won') AS DECIMAL(28,2)) AS total_revenue_won,
  AVG(days) AS avg_sales_cycle
FROM sales WHERE {condition}"""


SALES_NAMED = """sale_date, salesperson, lead_name, segment, region, target_close,
  forecast AS forecasted_monthly_revenue, stage AS opportunity_stage, weighted AS weighted_revenue,
  closed AS closed_opportunity, active AS active_opportunity, latest AS latest_status_entry"""

TEXT_DATE = """CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE strftime(o_orderdate, '%-m/%-d/%Y') END"""

HOLED = f"""holed AS (
  SELECT o_orderkey, {TEXT_DATE} AS date_text,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
  FROM orders
)"""

# What each rule demands, in rule order; nulls pass the comparisons only.
DEMANDS = (
    "priority IS NOT NULL",
    "COALESCE(price > 50000, true)",
    "COALESCE(price >= 100000, true)",
    "COALESCE(regexp_matches(priority, '^[1-3]-'), false)",
    "try_strptime(date_text, '%-m/%-d/%Y') IS NOT NULL",
)
RULE_TEXTS = (
    ("priority", "not_null", "NULL values"),
    ("price", "greater_than", "values not greater than 50000"),
    ("price", "greater_than_equal", "values less than 100000"),
    ("priority", "regex", "values not matching pattern ''^[1-3]-''"),
    ("date_text", "date_format", "values not in date format ''M/d/yyyy''"),
)


def _kept(rule: int) -> str:
    return f"WITH {HOLED} SELECT * FROM holed WHERE {DEMANDS[rule]}"


def _report() -> str:
    lines = []
    for i, (column, kind, text) in enumerate(RULE_TEXTS):
        failing = " AND ".join([*DEMANDS[:i], f"NOT ({DEMANDS[i]})"])
        lines.append(
            f"SELECT CAST({i + 1} AS BIGINT) AS rule_no, '{column}' AS column_name, '{kind}' AS rule_type, "
            f"'Column ''{column}'' contains ' || COUNT(*) || ' {text}' AS message, "
            f"COUNT(*) AS failed_count FROM holed WHERE {failing}"
        )
    union = " UNION ALL ".join(lines)
    return f"WITH {HOLED} SELECT * FROM ({union}) WHERE failed_count > 0"


def _quarantine() -> str:
    broken = ", ".join(
        f"CASE WHEN NOT ({demand}) THEN '{kind}({column})' END"
        for demand, (column, kind, _) in zip(DEMANDS, RULE_TEXTS)
    )
    return f"""WITH {HOLED}
SELECT *, concat_ws('; ', {broken}) AS failed_rules FROM holed
WHERE NOT ({" AND ".join(DEMANDS)})"""


VERSIONS = f"""versions AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS changed_on, l_partkey, l_suppkey, l_quantity,
    l_returnflag
  FROM lineitem
), parted AS (
  SELECT *, changed_on > {CUT} AS later FROM versions
), before_cut AS (
  SELECT l_orderkey, l_linenumber FROM parted WHERE NOT later
)"""

MERGED = f"""WITH {VERSIONS}
SELECT l_orderkey, l_linenumber, changed_on, l_partkey, l_suppkey, l_quantity, l_returnflag FROM parted
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY later DESC, changed_on DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC
) = 1"""


def _of_increment(condition: str) -> str:
    return f"""WITH {VERSIONS}
SELECT l_orderkey, l_linenumber, changed_on, l_partkey, l_suppkey, l_quantity, l_returnflag
FROM parted p WHERE later AND {condition} (
  SELECT 1 FROM before_cut b WHERE b.l_orderkey = p.l_orderkey AND b.l_linenumber = p.l_linenumber
)"""


RUNS = """log AS (
  SELECT user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, 'weekday-' || (dayofweek(ts) + 1) AS pipeline_id,
    'events' AS source_name, 'runs' AS destination_name, ts,
    CASE event_type WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS records_processed,
    CASE WHEN event_type = 'error' THEN 'event ' || event_id END AS error,
    CASE WHEN event_type = 'signup' THEN 'full' ELSE 'incremental' END AS load_type,
    CASE WHEN event_type <> 'signup' THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS last_timestamp
  FROM events
), newest AS (
  SELECT *, MIN(ts) OVER (PARTITION BY run_id) AS start_time FROM log
  QUALIFY row_number() OVER (
    PARTITION BY run_id
    ORDER BY ts DESC, status <> 'RUNNING' DESC, status DESC, records_processed DESC, error DESC
  ) = 1
), state AS (
  SELECT run_id, pipeline_id, source_name, destination_name, start_time,
    CASE WHEN status <> 'RUNNING' THEN ts END AS end_time, records_processed, status, error, load_type,
    (epoch_us(CASE WHEN status <> 'RUNNING' THEN ts END) - epoch_us(start_time)) / 1e6 AS duration_seconds,
    last_timestamp
  FROM newest
), history AS (
  SELECT * EXCLUDE (last_timestamp), CASE WHEN last_timestamp IS NOT NULL THEN 'ts' END AS incremental_column,
    last_timestamp, CASE WHEN last_timestamp IS NOT NULL THEN true END AS filtered_records
  FROM state
)"""


def _counted(table: str, rank: int, layer: str, source: str, columns: str) -> str:
    return (
        f"SELECT CAST({rank} AS BIGINT) AS layer_rank, '{layer}' AS layer, '{table}' AS table_name, "
        f"COUNT(*) AS row_count, '{columns}...' AS column_preview FROM {source}"
    )


ORACLES: dict[str, str] = {
    "dim_salesperson": f"""WITH {SALES}
SELECT DISTINCT md5(salesperson) AS salesperson_id, salesperson AS salesperson_name FROM sales""",
    "dim_lead": f"""WITH {SALES}
SELECT DISTINCT md5(lead_name) AS lead_id, lead_name, segment, region FROM sales""",
    "dim_lead_by_triple": f"""WITH {SALES}
SELECT DISTINCT {TRIPLE} AS lead_id, lead_name, segment, region FROM sales""",
    "dim_key_check": f"""WITH {SALES}
SELECT md5(lead_name) AS lead_id, COUNT(DISTINCT CASE WHEN closed THEN 'done' ELSE segment END) AS occurrences
FROM sales GROUP BY lead_name HAVING COUNT(DISTINCT CASE WHEN closed THEN 'done' ELSE segment END) > 1""",
    "dim_date": f"""WITH {SALES}
SELECT DISTINCT md5(CAST(sale_date AS VARCHAR)) AS date_id, sale_date AS date_value,
  CAST(year(sale_date) AS BIGINT) AS year, CAST(month(sale_date) AS BIGINT) AS month,
  CAST(day(sale_date) AS BIGINT) AS day, CAST(quarter(sale_date) AS BIGINT) AS quarter,
  CAST(dayofweek(sale_date) + 1 AS BIGINT) AS day_of_week
FROM sales""",
    "dim_stage": f"""WITH {SALES}
SELECT DISTINCT md5(stage) AS stage_id, stage AS stage_name FROM sales""",
    "fact_sales": f"""WITH {SALES}
SELECT row_number() OVER (ORDER BY sale_date, lead_name, salesperson, l_orderkey, l_linenumber, l_partkey,
    l_suppkey, stage, target_close, forecast, weighted, closed, active, latest) AS sales_id,
  md5(CAST(sale_date AS VARCHAR)) AS date_id, md5(lead_name) AS lead_id, md5(salesperson) AS salesperson_id,
  md5(stage) AS stage_id, target_close AS target_close_date, forecast AS forecasted_monthly_revenue,
  weighted AS weighted_revenue, closed AS closed_opportunity, active AS active_opportunity,
  latest AS latest_status_entry, days AS sales_cycle_days
FROM sales""",
    "lake_fact": f"""WITH {SALES}
SELECT row_number() OVER (ORDER BY sale_date, lead_name, salesperson, stage, target_close, forecast, weighted,
    closed, active, latest, segment, region) AS sales_id,
  md5(CAST(sale_date AS VARCHAR)) AS date_id, {TRIPLE} AS lead_id, md5(salesperson) AS salesperson_id,
  md5(stage) AS stage_id, target_close AS target_close_date, forecast AS forecasted_monthly_revenue,
  weighted AS weighted_revenue, closed AS closed_opportunity, active AS active_opportunity,
  latest AS latest_status_entry, days AS sales_cycle_days
FROM sales""",
    "star_join": f"""WITH {SALES}
SELECT sale_date AS date_value, CAST(year(sale_date) AS BIGINT) AS year, CAST(month(sale_date) AS BIGINT) AS month,
  salesperson AS salesperson_name, lead_name, segment, region, stage AS stage_name,
  target_close AS target_close_date, forecast AS forecasted_monthly_revenue, weighted AS weighted_revenue,
  closed AS closed_opportunity, active AS active_opportunity, latest AS latest_status_entry,
  days AS sales_cycle_days
FROM sales""",
    "star_join_moving_leads": f"""WITH {SALES}
SELECT sale_date AS date_value, CAST(year(sale_date) AS BIGINT) AS year, CAST(month(sale_date) AS BIGINT) AS month,
  salesperson AS salesperson_name, lead_name, CASE WHEN closed THEN 'done' ELSE segment END AS segment, region,
  stage AS stage_name, target_close AS target_close_date, forecast AS forecasted_monthly_revenue,
  weighted AS weighted_revenue, closed AS closed_opportunity, active AS active_opportunity,
  latest AS latest_status_entry, days AS sales_cycle_days
FROM sales""",
    "lake_report": f"""WITH {SALES}, counted AS (
  SELECT COUNT(*) FILTER (segment = 'BUILDING') AS leads,
    COUNT(*) FILTER (segment <> 'BUILDING' AND region = 'ASIA') AS people FROM sales
)
SELECT 1::BIGINT AS rule_no, 'lead_name' AS column_name, 'not_null' AS rule_type,
  'Column ''lead_name'' contains ' || leads || ' NULL values' AS message, leads AS failed_count FROM counted
UNION ALL SELECT 2, 'salesperson', 'not_null', 'Column ''salesperson'' contains ' || people || ' NULL values', people FROM counted""",
    "lake_broken": f"""WITH {SALES}
SELECT concat_ws(',', strftime(sale_date, '%-m/%-d/%Y'), salesperson, lead_name, segment, region,
  strftime(target_close, '%-m/%-d/%Y'), 'n/a', stage, CAST(weighted AS VARCHAR), CAST(closed AS VARCHAR),
  CAST(active AS VARCHAR), CAST(latest AS VARCHAR)) AS record, 'Forecasted Monthly Revenue: n/a' AS reason
FROM sales WHERE region = 'EUROPE' AND stage = 'Lead'""",
    "append_drift": f"""SELECT o_orderkey,
  CASE WHEN o_orderdate < '1997-01-01' OR o_orderdate >= {CUT} THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderdate < {CUT} THEN o_orderstatus END AS o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS o_totalprice,
  CASE WHEN o_orderdate >= '1997-01-01' THEN o_orderpriority END AS o_orderpriority,
  CAST(o_orderdate AS DATE) AS order_date
FROM orders""",
    "csv_broken": """WITH cells AS (
  SELECT *, o_orderkey % 7 AS k, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM orders
)
SELECT o_orderkey, o_custkey, CASE WHEN k <> 3 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN k NOT IN (2, 3) THEN CAST(price AS DECIMAL(12,2)) END AS o_totalprice,
  CASE k WHEN 1 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, price, 'more')
    WHEN 2 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'n/a')
    WHEN 3 THEN concat_ws(',', o_orderkey, o_custkey) END AS record,
  CASE k WHEN 1 THEN 'more than 4 cells' WHEN 2 THEN 'o_totalprice: n/a' WHEN 3 THEN 'fewer than 4 cells' END AS reason
FROM cells""",
    "lake_rejected": f"""WITH {SALES}, named AS (
  SELECT {SALES_NAMED} FROM sales WHERE region = 'EUROPE' AND stage = 'Lead'
)
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS lead_name), 'not_null(lead_name)' AS failed_rules FROM named""",
    "sales_summary": _numbered(SUMMARY_MART, "summary_mart", "summary_id", "salesperson_name, region, segment"),
    "mart_state_summary": f"WITH {SALES}, {SUMMARY_MART} SELECT * FROM summary_mart",
    "mart_state_regions": f"WITH {SALES}, {REGION_MART} SELECT * FROM region_mart",
    "mart_state_performance": f"WITH {SALES}, {PERFORMANCE_MART} SELECT * FROM performance_mart",
    "mart_state_funnel": f"WITH {SALES}, {FUNNEL_MART} SELECT * FROM funnel_mart",
    "mart_state_trends": f"WITH {SALES}, {TRENDS_MART} SELECT * FROM trends_mart",
    "mart_state_leads": f"WITH {SALES}, {SCORING_MART} SELECT * FROM scoring_mart",
    "region_summary": _numbered(REGION_MART, "region_mart", "region_summary_id", "region, segment, year, month"),
    "performance": _numbered(
        PERFORMANCE_MART, "performance_mart", "performance_id", "salesperson_name, region, segment"
    ),
    "funnel": _numbered(FUNNEL_MART, "funnel_mart", "funnel_id", "stage_name, region, segment"),
    "monthly_trends": _numbered(TRENDS_MART, "trends_mart", "trends_id", "year, month, region"),
    "lead_scoring": _numbered(
        SCORING_MART, "scoring_mart", "scoring_id", "lead_name, segment, region, assigned_salesperson"
    ),
    "lead_scoring_any_won": _numbered(
        _scoring_mart("bool_or(stage = 'Closed Won')"),
        "scoring_mart",
        "scoring_id",
        "lead_name, segment, region, assigned_salesperson",
    ),
    "sales_summary_normalized": f"""WITH {SALES}
SELECT md5(salesperson) AS salesperson_id, salesperson, region, segment, COUNT(*) AS total_opportunities,
  CAST(SUM(forecast) AS DECIMAL(28,2)) AS total_forecasted_revenue,
  CAST(SUM(weighted) AS DECIMAL(28,2)) AS total_weighted_revenue,
  COUNT(*) FILTER (closed) AS closed_opportunities, COUNT(*) FILTER (active) AS active_opportunities
FROM sales GROUP BY salesperson, region, segment""",
    "gold_by_sql": f"""WITH {SALES}
SELECT region, COUNT(*) AS opportunities, COUNT(*) FILTER (closed) AS closed FROM sales GROUP BY region""",
    "kpi_summary": _kpi("true"),
    "kpi_summary_range": _kpi("sale_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"),
    "top_performers": _top("actual_revenue"),
    "top_performers_by_win_rate": _top("win_rate_percent"),
    "top_performers_by_deals": _top("won_deals"),
    "top_performers_by_pipeline": _top("total_pipeline_value"),
    "regional": _regional("SUM(total_opportunities)"),
    "regional_legacy": _regional("COUNT(*)"),
    "segment_analysis": _segments("SUM(total_opportunities)"),
    "segment_analysis_legacy": _segments("COUNT(*)"),
    "funnel_stage": _funnel_stage("AVG(avg_opportunity_value)", "AVG(avg_days_to_close)"),
    "funnel_stage_weighted": _funnel_stage(
        "CAST(SUM(stage_pipeline_value) AS DOUBLE) / SUM(opportunity_count)",
        "SUM(avg_days_to_close * opportunity_count) / SUM(opportunity_count)",
    ),
    "trend_rollup": _trend_rollup("year >= 2000", "AVG(avg_monthly_deal_size)"),
    "trend_rollup_exact": _trend_rollup(
        "make_date(year, month, 1) >= DATE '2001-02-01'",
        "CAST(SUM(monthly_pipeline_added) AS DOUBLE) / SUM(new_opportunities)",
    ),
    "lead_insights": _insights("true"),
    "lead_insights_high": _insights("lead_score = 'High'"),
    "exec_summary": f"""WITH {SALES}, {REGION_MART}, {PERFORMANCE_MART}, {FUNNEL_MART}, kpi AS (
  SELECT COUNT(*) AS n, COUNT(*) FILTER (closed AND stage = 'Closed Won') AS won,
    COUNT(*) FILTER (closed AND stage = 'Closed Lost') AS lost, COUNT(*) FILTER (closed) AS done,
    SUM(forecast) AS pipeline, SUM(forecast) FILTER (stage = 'Closed Won') AS revenue, AVG(days) AS cycle
  FROM sales
), best AS (
  SELECT * FROM performance_mart ORDER BY actual_revenue DESC, salesperson_name, region, segment LIMIT 5
), regions AS (
  SELECT region, SUM(total_forecasted_revenue) AS pipeline,
    ROUND(CAST(SUM(closed_opportunities) AS DOUBLE) * 100e0 / SUM(total_opportunities), 2) AS close_rate
  FROM region_mart GROUP BY region
), ranked_regions AS (
  SELECT *, row_number() OVER (ORDER BY pipeline DESC, region) AS rank FROM regions
), stages AS (
  SELECT stage_name, CAST({STAGE_RANK} AS BIGINT) AS rank, SUM(opportunity_count) AS n,
    SUM(stage_pipeline_value) AS value
  FROM funnel_mart GROUP BY stage_name
)
SELECT 'overall' AS section, CAST(1 AS BIGINT) AS rank, 'all' AS label, metric, value FROM (
  SELECT unnest(['total_opportunities', 'won_deals', 'lost_deals', 'overall_win_rate', 'total_pipeline_value',
      'total_revenue_won', 'avg_sales_cycle']) AS metric,
    unnest([CAST(n AS DOUBLE), CAST(won AS DOUBLE), CAST(lost AS DOUBLE), ROUND(won * 100e0 / done, 2),
      CAST(pipeline AS DOUBLE), CAST(revenue AS DOUBLE), cycle]) AS value
  FROM kpi
)
UNION ALL
SELECT 'top_performers', row_number() OVER (ORDER BY actual_revenue DESC, salesperson_name, region, segment),
  salesperson_name || ' (' || region || ')', 'actual_revenue', CAST(actual_revenue AS DOUBLE)
FROM best
UNION ALL
SELECT 'regional', rank, region, 'total_pipeline', CAST(pipeline AS DOUBLE) FROM ranked_regions
UNION ALL
SELECT 'regional', rank, region, 'close_rate', close_rate FROM ranked_regions
UNION ALL
SELECT 'funnel', rank, stage_name, 'total_count', CAST(n AS DOUBLE) FROM stages
UNION ALL
SELECT 'funnel', rank, stage_name, 'total_value', CAST(value AS DOUBLE) FROM stages""",
    "clean_columns": """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS lead_name,
  c_mktsegment AS segment
FROM customer""",
    "type_conversion": """SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS price,
  CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS customer, o_orderstatus = 'O' AS is_open
FROM orders""",
    "date_conversion": f"""SELECT o_orderkey, {TEXT_DATE} AS date_text,
  CAST(try_strptime({TEXT_DATE}, '%-m/%-d/%Y') AS DATE) AS order_date
FROM orders""",
    "date_conversion_formats": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders",
    "drop_rename": "SELECT s_suppkey, s_name AS salesperson, s_nationkey FROM supplier",
    "declarative_silver": f"""WITH {SALES}
SELECT {SALES_NAMED.replace(
        "target_close,", "CASE WHEN stage <> 'Prospect' THEN target_close END AS target_close,"
    )}
FROM sales WHERE region <> 'EUROPE' OR stage <> 'Lead'""",
    "silver_salespeople": f"""WITH {SALES}
SELECT DISTINCT salesperson, md5(salesperson) AS salesperson_id FROM sales""",
    "silver_leads": f"""WITH {SALES}
SELECT DISTINCT lead_name, segment, region, md5(lead_name) AS lead_id FROM sales""",
    "silver_dates": f"""WITH {SALES}
SELECT DISTINCT sale_date AS full_date, md5(CAST(sale_date AS VARCHAR)) AS date_id,
  CAST(day(sale_date) AS INTEGER) AS day, CAST(month(sale_date) AS INTEGER) AS month,
  CAST(year(sale_date) AS INTEGER) AS year, CAST(quarter(sale_date) AS INTEGER) AS quarter
FROM sales""",
    "silver_opportunities": f"""WITH {SALES}
SELECT md5(CAST(sale_date AS VARCHAR)) AS date_id, md5(CAST(target_close AS VARCHAR)) AS target_close_id,
  md5(salesperson) AS salesperson_id, md5(lead_name) AS lead_id, forecast AS forecasted_monthly_revenue,
  stage AS opportunity_stage, weighted AS weighted_revenue, closed AS closed_opportunity,
  active AS active_opportunity, latest AS latest_status_entry,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS opportunity_id
FROM sales WHERE forecast >= 0 AND weighted >= 0""",
    "dq_not_null": _kept(0),
    "dq_gt": _kept(1),
    "dq_gte": _kept(2),
    "dq_regex": _kept(3),
    "dq_date_format": _kept(4),
    "dq_all_rules": f"WITH {HOLED} SELECT * FROM holed WHERE {' AND '.join(DEMANDS)}",
    "dq_report": _report(),
    "dq_quarantine": _quarantine(),
    "merge_upsert": MERGED,
    "merge_new_rows": _of_increment("NOT EXISTS"),
    "merge_updates": _of_increment("EXISTS"),
    "merge_by_partition": f"""WITH placed AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
    o_orderkey, o_totalprice
  FROM orders
)
SELECT * FROM placed
QUALIFY row_number() OVER (
  PARTITION BY order_year, o_custkey
  ORDER BY order_date > {CUT} DESC, order_date DESC, o_orderkey DESC, o_totalprice DESC
) = 1""",
    "append_increment": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS order_date, o_orderpriority
FROM orders""",
    "incremental_filter": f"SELECT * FROM orders WHERE o_orderdate > {CUT}",
    "incremental_filter_lookback": f"SELECT * FROM orders WHERE o_orderdate > {CUT} - INTERVAL 30 DAY",
    "incremental_gold": f"WITH {SALES}, {TRENDS_MART} SELECT * FROM trends_mart",
    "incremental_gold_leads": f"WITH {SALES}, {SCORING_MART} SELECT * FROM scoring_mart",
    "watermark_upsert": f"""SELECT 'orders' AS table_name, 'o_orderdate' AS column_name,
  CAST(CAST(MAX(o_orderdate) AS DATE) AS VARCHAR) AS max_value
FROM orders
UNION ALL
SELECT 'lineitem', 'l_shipdate', CAST(MAX(CAST(l_shipdate AS DATE)) AS VARCHAR)
FROM lineitem WHERE CAST(l_shipdate AS DATE) <= {CUT}
UNION ALL
SELECT 'events', 'ts', CAST(CAST(MAX(ts) AS DATE) AS VARCHAR) FROM events""",
    "stream_available_now": """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "lake_load": _numbered(TRENDS_MART, "trends_mart", "trends_id", "year, month, region"),
    "csv_roundtrip": f"WITH {SALES} SELECT {SALES_NAMED} FROM sales",
    "csv_inferred": "SELECT * FROM customer",
    "json_source": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""",
    "parquet_partitioned": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""",
    "csv_report": _segments("SUM(total_opportunities)"),
    "table_preview": """SELECT (SELECT COUNT(*) FROM orders) AS total_rows,
  'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' AS column_names,
  o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 10""",
    "warehouse_overview": f"WITH {SALES} "
    + " UNION ALL ".join(
        [
            _counted("bronze_lineitem", 1, "Bronze", "lineitem", "l_orderkey, l_partkey, l_suppkey"),
            _counted("bronze_orders", 1, "Bronze", "orders", "o_orderkey, o_custkey, o_orderstatus"),
            _counted("bronze_events", 1, "Bronze", "events", "event_id, ts, user_id"),
            _counted("silver_sales", 2, "Silver", "sales", "sale_date, salesperson, lead_name"),
            _counted(
                "gold_dim_lead",
                3,
                "Gold",
                "(SELECT DISTINCT lead_name, segment, region FROM sales)",
                "lead_id, lead_name, segment",
            ),
            _counted(
                "gold_dim_opportunity_stage", 3, "Gold", "(SELECT DISTINCT stage FROM sales)", "stage_id, stage_name"
            ).replace("stage_name...", "stage_name"),
            _counted("customer", 4, "Other", "customer", "c_custkey, c_name, c_nationkey"),
        ]
    ),
    "source_profile": """SELECT CAST(position AS BIGINT) AS position, column_name, data_type,
  (SELECT COUNT(*) FROM customer) AS total_rows
FROM (VALUES (1, 'c_custkey', 'int'), (2, 'c_name', 'string'), (3, 'c_nationkey', 'int'),
  (4, 'c_acctbal', 'double'), (5, 'c_mktsegment', 'string')) AS t(position, column_name, data_type)""",
    "run_state": f"WITH {RUNS} SELECT * EXCLUDE (last_timestamp) FROM state",
    "run_history": f"WITH {RUNS} SELECT * FROM history ORDER BY start_time DESC, run_id LIMIT 20",
    "run_history_of_one": f"""WITH {RUNS}
SELECT * FROM history WHERE pipeline_id = 'weekday-2' ORDER BY start_time DESC, run_id LIMIT 10""",
    "numbered_copies": """WITH numbered AS (
  SELECT row_number() OVER (ORDER BY o_orderstatus, o_orderpriority) AS row_no, o_orderstatus, o_orderpriority
  FROM orders
)
SELECT o_orderstatus, o_orderpriority, MIN(row_no) AS first_no, MAX(row_no) AS last_no, COUNT(*) AS copies
FROM numbered GROUP BY o_orderstatus, o_orderpriority""",
}
ORACLES["fact_sales_stored"] = ORACLES["fact_sales"]
ORACLES["lake_dim_lead"] = ORACLES["dim_lead_by_triple"]
ORACLES["lake_performance"] = ORACLES["performance"]
ORACLES["merge_buckets"] = ORACLES["merge_upsert"]
ORACLES["stream_late_files"] = ORACLES["stream_available_now"]
ORACLES["stream_state"] = ORACLES["stream_available_now"]
