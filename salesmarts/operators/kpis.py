"""Headline figures and the small views a report puts on top of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmarts.functions.dates import short_month
from salesmarts.functions.numeric import half_up_ratio, percent

# The columns of the roster.
ROSTER_COLUMNS = (
    "customer_id", "company_name", "region", "frequency_orders", "monetary_total",
    "recency_days", "customer_segment",
)


def kpi_sales(monthly: DataFrame) -> DataFrame:
    """Total revenue, total orders, average order value and number of months, in one row."""
    return monthly.agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
        F.count("*").alias("months"),
    ).withColumn("avg_order_value", half_up_ratio(F.col("total_revenue"), F.col("total_orders"), 2))


def kpi_churn(churn: DataFrame) -> DataFrame:
    """Customers, churned, at risk, active and churn rate, in one row."""
    return churn.agg(
        F.count("*").alias("total_customers"),
        F.count_if("is_churned").alias("churned_customers"),
        F.count_if(F.col("customer_segment") == "At Risk").alias("at_risk_customers"),
        F.count_if(F.col("customer_segment") == "Active").alias("active_customers"),
    ).withColumn("churn_rate_pct", percent(F.col("churned_customers"), F.col("total_customers")))


def sales_mom(monthly: DataFrame) -> DataFrame:
    """Change against the month before in percent; null for the first and after a zero.

    Sales of unknown month sort first but are no month before. The window has no partition,
    so one task sees every month: at most twelve rows a year, however many lines were sold.
    """
    months = Window.orderBy("year_month")
    before = F.when(
        F.lag("year_month").over(months).isNotNull(), F.lag("total_revenue").over(months)
    )
    return monthly.select("year_month", "total_revenue", before.alias("prev_revenue")).withColumn(
        "mom_change_pct", percent(F.col("total_revenue") - F.col("prev_revenue"), F.col("prev_revenue"))
    )


def latest_month(monthly: DataFrame) -> DataFrame:
    """The last month on record."""
    return monthly.orderBy(F.desc("year_month")).limit(1)


def month_label(monthly: DataFrame) -> DataFrame:
    return monthly.select("year_month", short_month(F.col("year_month")).alias("month_label"), "total_revenue")


def _with_largest(mart: DataFrame, value: str) -> DataFrame:
    """The mart with its largest ``value`` beside each row, computed once.

    The window has no partition. That is for marts only: they hold a row per month, category,
    region or product of a top-k list, however many lines were sold.
    """
    return mart.withColumn("_largest", F.max(value).over(Window.partitionBy()))


def share_of_max(mart: DataFrame, value: str) -> DataFrame:
    """``value`` as a percentage of its largest, to one place."""
    share = percent(F.col(value), F.col("_largest"))
    return _with_largest(mart, value).withColumn("share_of_max_pct", share).drop("_largest")


def fraction_of_max(mart: DataFrame, value: str) -> DataFrame:
    """``value`` as a plain fraction of its largest."""
    part = F.try_divide(F.col(value).cast("double"), F.col("_largest").cast("double"))
    return _with_largest(mart, value).withColumn("fraction_of_max", part).drop("_largest")


def ranked(top: DataFrame) -> DataFrame:
    """Number a top-k list from 1. Only for lists a limit has made short."""
    order = Window.orderBy(F.desc("total_revenue"), "product_id")
    return top.withColumn("rank", F.row_number().over(order))


def customer_roster(
    churn: DataFrame,
    segment: str | None = None,
    sort_key: str = "recency_days",
    descending: bool = True,
) -> DataFrame:
    """Customers of one segment (or all), sorted on any column of the roster."""
    if sort_key not in ROSTER_COLUMNS:
        raise ValueError(f"sort_key must be one of {ROSTER_COLUMNS}")
    if segment is not None:
        churn = churn.where(F.col("customer_segment") == segment)
    key = F.desc(sort_key) if descending else F.asc(sort_key)
    return churn.select(*ROSTER_COLUMNS).orderBy(key, "customer_id")
