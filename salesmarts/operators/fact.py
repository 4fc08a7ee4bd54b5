"""The line-grain sales fact, and the order- and product-grain sums the marts are built on.

Every dimension holds one row per key, so a left join to it changes no line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmarts.functions.numeric import CENTS, total_cents
from salesmarts.operators.joins import attach

# The columns of the stored fact.
FACT_COLUMNS = (
    "order_id", "order_date", "shipped_date", "region",
    "customer_id", "company_name", "country",
    "employee_id", "first_name", "last_name",
    "product_id", "product_name", "category_name",
    "quantity", "unit_price", "discount", "line_revenue",
)


def sales_fact(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    employees: DataFrame,
    how: str = "left",
    split_hot: bool = True,
) -> DataFrame:
    """One row per order line with its order, product, customer and employee.

    Customers and employees belong to the order, so they are joined to the orders, which
    are fewer and narrower than the lines. The lines themselves move twice: once to their
    product while they are still narrow, once to their order. ``how="inner"`` drops lines
    whose order is unknown. ``split_hot=False`` is for counting (see ``attach``).
    """
    sold = orders.select(
        "order_id", "order_date", "shipped_date", "region", "customer_id", "employee_id"
    )
    sold = attach(sold, employees.select("employee_id", "first_name", "last_name"), "employee_id", split_hot=split_hot)
    sold = attach(sold, customers.select("customer_id", "company_name", "country"), "customer_id", split_hot=split_hot)
    named = attach(
        lines, products.select("product_id", "product_name", "category_name"), "product_id",
        split_hot=split_hot,
    )
    return attach(named, sold, "order_id", how=how, split_hot=split_hot).select(*FACT_COLUMNS)


def _sums(lines: DataFrame, *keys: str) -> DataFrame:
    """Revenue in cents and units per key, from lines with or without their revenue in parts."""
    if "revenue_cents" in lines.columns:
        ordinary = F.col("revenue_cents")
        large = F.col("large_cents") if "large_cents" in lines.columns else F.lit(None)
    else:
        # Below 10^7 the double closest to an amount times 100 rounds to its cents.
        amount = F.col("line_revenue").cast("double")
        plain = F.abs(amount) < 10.0**7
        ordinary = F.when(plain, F.rint(amount * 100).cast("bigint"))
        large = F.when(~plain, (F.col("line_revenue") * 100).cast(CENTS))
    return lines.groupBy(*keys).agg(
        total_cents(ordinary, large).alias("revenue_cents"), F.sum("quantity").alias("units")
    )


def order_sales(lines: DataFrame, orders: DataFrame, how: str = "left") -> DataFrame:
    """Revenue and units per order with the order's own columns.

    The lines are summed before the join: both sides then hold one row per order, so no
    order, however many lines it has, makes the join uneven.
    """
    return _sums(lines, "order_id").join(orders, "order_id", how)


def order_sales_of(fact: DataFrame) -> DataFrame:
    """The same sums from a stored fact."""
    return _sums(fact, "order_id", "order_date", "customer_id", "region")


def product_sums(lines: DataFrame) -> DataFrame:
    """Revenue and units per product id."""
    return _sums(lines, "product_id")


def product_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue and units per product, summed before the product's columns are joined."""
    return _sums(lines, "product_id").join(
        products.select("product_id", "product_name", "category_name"), "product_id", "left"
    )


def product_sales_of(fact: DataFrame) -> DataFrame:
    """The same sums from a stored fact."""
    return _sums(fact, "product_id", "product_name", "category_name")
