"""Sales marts, from the order- and product-grain sums of ``fact``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmarts.functions.dates import month_start, year_month
from salesmarts.functions.numeric import from_cents


def _revenue() -> Column:
    return from_cents(F.sum("revenue_cents")).alias("total_revenue")


def sales_monthly(orders: DataFrame) -> DataFrame:
    """Revenue, orders and buying customers per month."""
    return (
        orders.groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(
            _revenue(),
            F.count("order_id").alias("order_count"),
            F.count_distinct("customer_id").alias("active_customers"),
        )
        .select(
            year_month(F.col("month")).alias("year_month"),
            "total_revenue", "order_count", "active_customers",
        )
    )


def sales_by_category(products: DataFrame) -> DataFrame:
    """Revenue and units per category."""
    return products.groupBy("category_name").agg(_revenue(), F.sum("units").alias("units_sold"))


def sales_by_region(orders: DataFrame) -> DataFrame:
    """Revenue and orders per region; orders of unknown region form one row."""
    return orders.groupBy("region").agg(_revenue(), F.count("order_id").alias("order_count"))


def top_products(sums: DataFrame, n: int = 10, products: DataFrame | None = None) -> DataFrame:
    """The ``n`` products with the most revenue; the lower id wins a tie.

    The limit comes before the products' names are joined, so only ``n`` rows meet them.
    ``sums`` that hold the names already need no ``products``.
    """
    best = sums.orderBy(F.desc("revenue_cents"), "product_id").limit(n)
    if products is not None:
        names = products.select("product_id", "product_name", "category_name")
        best = best.join(names, "product_id", "left")
    return best.select(
        "product_id", "product_name", "category_name",
        from_cents(F.col("revenue_cents")).alias("total_revenue"),
        F.col("units").alias("units_sold"),
    )
