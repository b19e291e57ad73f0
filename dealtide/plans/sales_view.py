"""Sales opportunities derived from order tables, one per line item.

Stands in for the sales file wherever only order data is at hand; the columns are
those of the cleaned sales table plus the four columns that identify a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.functions.columns import MONEY

LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan of a stored table, with the schema it has now."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Line items joined to their order, customer, region and supplier.

    Orders meet the customers before the line items, so the larger table is shuffled
    for the order key and the supplier key only. Every other side is a plain scan, whose
    size Spark knows: it broadcasts the small ones. Between line items and orders, which
    both grow with the data, a sort-merge join is asked for: it spills, and AQE splits
    its skewed partitions.
    """
    regions = read_table(spark, folder, "region").select("r_regionkey", F.col("r_name").alias("region"))
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    customers = read_table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_name").alias("lead_name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = read_table(spark, folder, "supplier").select("s_suppkey", F.col("s_name").alias("salesperson"))
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("sale_date")
    )
    # only what the sales need goes through the shuffle, in its shortest form
    lines = read_table(spark, folder, "lineitem").select(
        *LINE_KEY,
        "l_extendedprice",
        "l_discount",
        F.to_date("l_shipdate").alias("target_close"),
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_linestatus") == "F").alias("line_final"),
        (F.col("l_linestatus") == "O").alias("latest_status_entry"),
    )

    placed = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "o_orderstatus", "sale_date", "lead_name", "segment", "region")
    )
    sold = lines.join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )

    final = F.col("o_orderstatus") == "F"
    line_final = F.col("line_final")
    stage = (
        F.when(final & F.col("returned"), "Closed Lost")
        .when(final, "Closed Won")
        .when((F.col("o_orderstatus") == "P") & line_final, "Contracting")
        .when(F.col("o_orderstatus") == "P", "Qualified")
        .when(line_final, "Prospect")
        .otherwise("Lead")
    )
    forecast = F.col("l_extendedprice").cast(MONEY)
    share = (1 - F.col("l_discount")).cast("decimal(4,2)")
    return sold.select(
        "sale_date",
        "salesperson",
        "lead_name",
        "segment",
        "region",
        "target_close",
        forecast.alias("forecasted_monthly_revenue"),
        F.round(forecast * share, 2).cast(MONEY).alias("weighted_revenue"),
        stage.alias("opportunity_stage"),
        final.alias("closed_opportunity"),
        (~final).alias("active_opportunity"),
        "latest_status_entry",
        *LINE_KEY,
    )


def normalized_from_sales(sales: DataFrame) -> dict[str, DataFrame]:
    """The same sales as four related tables: people, leads, dates, opportunities."""
    date_id = F.md5(F.col("sale_date").cast("string"))
    person_id = F.md5("salesperson")
    lead_id = F.md5("lead_name")
    return {
        "salespeople": sales.select("salesperson", person_id.alias("salesperson_id")).distinct(),
        "leads": sales.select("lead_name", "segment", "region", lead_id.alias("lead_id")).distinct(),
        "dates": sales.select(F.col("sale_date").alias("full_date"))
        .distinct()
        .select(
            "full_date",
            F.md5(F.col("full_date").cast("string")).alias("date_id"),
            F.day("full_date").alias("day"),
            F.month("full_date").alias("month"),
            F.year("full_date").alias("year"),
            F.quarter("full_date").alias("quarter"),
        ),
        "sales_opportunities": sales.select(
            date_id.alias("date_id"),
            F.md5(F.col("target_close").cast("string")).alias("target_close_id"),
            person_id.alias("salesperson_id"),
            lead_id.alias("lead_id"),
            "forecasted_monthly_revenue",
            "opportunity_stage",
            "weighted_revenue",
            "closed_opportunity",
            "active_opportunity",
            "latest_status_entry",
            F.concat_ws("-", *LINE_KEY).alias("opportunity_id"),
        ),
    }
