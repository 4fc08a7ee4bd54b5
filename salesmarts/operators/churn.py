"""Recency, frequency and value per customer, the churn rules and the churn marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmarts.functions.dates import as_date
from salesmarts.functions.numeric import from_cents, half_up_ratio, percent

# The columns of the stored churn mart.
CHURN_COLUMNS = (
    "customer_id", "company_name", "country", "region",
    "frequency_orders", "monetary_total", "last_order_date", "first_order_date",
    "recency_days", "avg_order_value", "is_churned", "customer_segment",
)


def customer_rfm(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per customer: orders, total, first and last day, region of the last order."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("frequency_orders"),
        from_cents(F.sum("revenue_cents")).alias("monetary_total"),
        F.max("order_date").alias("last_order_date"),
        F.min("order_date").alias("first_order_date"),
        F.max_by("region", F.struct("order_date", "order_id")).alias("region"),
    )
    return per_customer.join(
        customers.select("customer_id", "company_name", "country"), "customer_id", "left"
    ).select(*CHURN_COLUMNS[:8])


def customer_segment(recency: Column, churn_days: int, active_days: int) -> Column:
    """A customer of unknown recency is neither churned nor active, hence at risk."""
    return (
        F.when(recency > churn_days, "Churned")
        .when(recency <= active_days, "Active")
        .otherwise("At Risk")
    )


def customer_churn(
    rfm: DataFrame,
    activity: DataFrame,
    ref_date: Column | dt.date | str,
    churn_days: int = 180,
    active_days: int = 60,
) -> DataFrame:
    """Add recency, average order value, churn flag and segment.

    Recency is the activity export's, or else counted from the reference day. The smallest
    count stands for a customer the export lists more than once, so that churn keeps one
    row per customer.
    """
    exported = activity.groupBy("customer_id").agg(
        F.min("days_since_last_order").alias("days_since_last_order")
    )
    recency = F.col("recency_days")
    return (
        rfm.join(exported, "customer_id", "left")
        .withColumn(
            "recency_days",
            F.coalesce(
                "days_since_last_order", F.datediff(as_date(ref_date), F.col("last_order_date"))
            ),
        )
        .withColumns(
            {
                "avg_order_value": half_up_ratio(
                    F.col("monetary_total"), F.col("frequency_orders"), 2
                ),
                "is_churned": F.coalesce(recency > churn_days, F.lit(False)),
                "customer_segment": customer_segment(recency, churn_days, active_days),
            }
        )
        .select(*CHURN_COLUMNS)
    )


def churn_summary(churn: DataFrame) -> DataFrame:
    """Customers, churned customers and churn rate per region."""
    return (
        churn.groupBy("region")
        .agg(
            F.count("*").alias("total_customers"),
            F.count_if("is_churned").alias("churned_customers"),
        )
        .withColumn("churn_rate_pct", percent(F.col("churned_customers"), F.col("total_customers")))
    )


def customer_activity_export(
    customers: DataFrame, orders: DataFrame, ref_date: Column | dt.date | str
) -> DataFrame:
    """Order activity of every customer, those without orders included."""
    activity = orders.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return customers.select("customer_id").join(activity, "customer_id", "left").select(
        "customer_id",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "first_order_date",
        "last_order_date",
        F.datediff(as_date(ref_date), F.col("last_order_date")).alias("days_since_last_order"),
    )
