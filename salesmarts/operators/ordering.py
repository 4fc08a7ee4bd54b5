"""The order of rows that readers of the marts expect.

A stored table keeps no order, so marts are built unsorted and sorted where they leave the
library: in an export, or in a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns in order of precedence; a minus sign means largest first.
ORDER = {
    "sales_monthly": ("year_month",),
    "sales_by_category": ("-total_revenue", "category_name"),
    "sales_by_region": ("-total_revenue", "region"),
    "top_products": ("-total_revenue", "product_id"),
    "churn_summary": ("-churn_rate_pct", "region"),
}


def ordered(name: str, mart: DataFrame) -> DataFrame:
    """``mart`` sorted as its readers expect; marts without an order are left as they are."""
    keys = [F.desc(k[1:]) if k[0] == "-" else F.asc(k) for k in ORDER.get(name, ())]
    return mart.orderBy(*keys) if keys else mart
