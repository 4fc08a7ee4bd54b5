"""Silver: clean, typed and joined tables from raw ones.

Each table is described by its columns in order of precedence: the order also decides which
of two rows with the same key is kept (see ``keep_one``). ``columns`` narrows a table to the
first few of them, which keeps the same winners and spares what the others cost to produce.
Ids and counts are bigint: int overflows on the row counts this is meant for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmarts.functions.dates import iso_date
from salesmarts.functions.numeric import (
    CENTS,
    DISCOUNT,
    PRICE,
    from_cents,
    line_revenue_cents,
    to_cents,
)
from salesmarts.functions.text import clean_text, conform_key
from salesmarts.operators.dedup import keep_one
from salesmarts.operators.joins import attach

Rule = tuple[str, Callable[[Column], Column]]


def _bigint(c: Column) -> Column:
    return c.try_cast("bigint")


def _price(c: Column) -> Column:
    return from_cents(to_cents(c), PRICE)


CUSTOMERS: dict[str, Rule] = {
    "customer_id": ("CustomerID", conform_key),
    "company_name": ("CompanyName", clean_text),
    "contact_name": ("ContactName", clean_text),
    "country": ("Country", clean_text),
}
EMPLOYEES: dict[str, Rule] = {
    "employee_id": ("EmployeeID", _bigint),
    "first_name": ("FirstName", clean_text),
    "last_name": ("LastName", clean_text),
    "title": ("Title", clean_text),
}
ORDERS: dict[str, Rule] = {
    "order_id": ("OrderID", _bigint),
    "order_date": ("OrderDate", iso_date),
    "customer_id": ("CustomerID", conform_key),
    "ship_country": ("ShipCountry", clean_text),
    "employee_id": ("EmployeeID", _bigint),
    "shipped_date": ("ShippedDate", iso_date),
    "shipper_id": ("ShipVia", _bigint),
}
PRODUCTS: dict[str, Rule] = {
    "product_id": ("ProductID", _bigint),
    "product_name": ("ProductName", clean_text),
    "category_id": ("CategoryID", _bigint),
    "unit_price": ("UnitPrice", _price),
    "supplier_id": ("SupplierID", _bigint),
}
ORDER_DETAILS: dict[str, Rule] = {
    "order_id": ("OrderID", _bigint),
    "product_id": ("ProductID", _bigint),
    "price_cents": ("UnitPrice", to_cents),
    "quantity": ("Quantity", _bigint),
    "discount_cents": ("Discount", lambda c: to_cents(c, DISCOUNT)),
}
ACTIVITY: dict[str, Rule] = {
    "customer_id": ("CustomerID", conform_key),
    "total_orders_export": ("TotalOrders", _bigint),
    "first_order_date": ("FirstOrderDate", iso_date),
    "last_order_date": ("LastOrderDate", iso_date),
    "days_since_last_order": ("DaysSinceLastOrder", _bigint),
}
REGIONS: dict[str, Rule] = {
    "country_key": ("Country", conform_key),
    "region": ("Region", lambda c: c),
}
CATEGORIES: dict[str, Rule] = {
    "category_id": ("CategoryID", _bigint),
    "category_name": ("CategoryName", clean_text),
}
SUPPLIERS: dict[str, Rule] = {
    "supplier_id": ("SupplierID", _bigint),
    "supplier_name": ("CompanyName", clean_text),
    "supplier_country": ("Country", clean_text),
}

# The column order of the conformed tables.
SILVER_ORDERS = (
    "order_id", "customer_id", "employee_id", "order_date", "shipped_date", "shipper_id",
    "ship_country", "region",
)
SILVER_PRODUCTS = (
    "product_id", "product_name", "category_id", "supplier_id", "unit_price",
    "category_name", "supplier_name", "supplier_country",
)


def conform(raw: DataFrame, rules: dict[str, Rule], columns: Sequence[str] | None = None) -> DataFrame:
    """Rename and convert the columns of ``raw`` by ``rules``."""
    names = list(rules)
    if columns is not None:
        names = [n for n in names if n in columns]
        if names != list(rules)[: len(names)] or len(names) != len(set(columns)):
            raise ValueError(f"columns must be the first of {list(rules)}, got {list(columns)}")
    return raw.select(*[rules[n][1](F.col(rules[n][0])).alias(n) for n in names])


_NEVER_BLANK = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def rejected(raw: DataFrame, rules: dict[str, Rule]) -> list[Column]:
    """Per column of ``rules`` the number of raw values that are not blank but become null.

    Aggregates to observe while a table is written: values lost in conversion are then counted
    without running the plan again. Numbers, dates and truth values are never blank and so are
    not turned into text.
    """
    counts = []
    for name, (source, rule) in rules.items():
        value = F.col(source)
        never_blank = isinstance(raw.select(source).schema[0].dataType, _NEVER_BLANK)
        given = value.isNotNull() if never_blank else F.trim(value.cast("string")) != ""
        counts.append(F.count_if(rule(value).isNull() & given).alias(name))
    return counts


def lost_revenue(raw: DataFrame) -> Column:
    """Number of raw order lines whose values all convert but whose revenue has too many digits."""
    parts = [rule(F.col(source)) for source, rule in (ORDER_DETAILS[n] for n in ("price_cents", "quantity", "discount_cents"))]
    ordinary, large = line_revenue_cents(*parts)
    whole = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    return F.count_if(whole & ordinary.isNull() & large.isNull())


def silver_customers(raw: DataFrame) -> DataFrame:
    return keep_one(conform(raw, CUSTOMERS), ["customer_id"])


def silver_employees(raw: DataFrame) -> DataFrame:
    return keep_one(conform(raw, EMPLOYEES), ["employee_id"])


def with_region(orders: DataFrame, region_lookup: DataFrame) -> DataFrame:
    """Add the region of the ship country; an unknown country keeps its order, region null."""
    lookup = keep_one(conform(region_lookup, REGIONS), ["country_key"])
    return attach(orders, lookup, "country_key", on=conform_key(orders["ship_country"]))


def silver_orders(
    raw: DataFrame,
    region_lookup: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    orders = keep_one(conform(raw, ORDERS, columns), ["order_id"])
    if region_lookup is not None:
        orders = with_region(orders, region_lookup)
    present = set(orders.columns)
    return orders.select(*[c for c in SILVER_ORDERS if c in present])


def silver_products(
    raw: DataFrame,
    categories: DataFrame | None = None,
    suppliers: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    products = keep_one(conform(raw, PRODUCTS, columns), ["product_id"])
    if categories is not None:
        named = keep_one(conform(categories, CATEGORIES), ["category_id"])
        products = attach(products, named, "category_id")
    if suppliers is not None:
        named = keep_one(conform(suppliers, SUPPLIERS), ["supplier_id"])
        products = attach(products, named, "supplier_id")
    present = set(products.columns)
    return products.select(*[c for c in SILVER_PRODUCTS if c in present])


def order_lines(raw: DataFrame) -> DataFrame:
    """Order details with the line's revenue also in the two parts that are summed."""
    ordinary, large = line_revenue_cents(F.col("price_cents"), F.col("quantity"), F.col("discount_cents"))
    lines = conform(raw, ORDER_DETAILS).withColumns({"revenue_cents": ordinary, "large_cents": large})
    cents = F.coalesce(F.col("revenue_cents").cast(CENTS), "large_cents")
    return lines.select(
        "order_id",
        "product_id",
        from_cents(F.col("price_cents"), PRICE).alias("unit_price"),
        "quantity",
        from_cents(F.col("discount_cents"), DISCOUNT).alias("discount"),
        from_cents(cents).alias("line_revenue"),
        "revenue_cents",
        "large_cents",
    )


def silver_order_details(raw: DataFrame) -> DataFrame:
    return order_lines(raw).drop("revenue_cents", "large_cents")


def silver_customer_activity(raw: DataFrame) -> DataFrame:
    return conform(raw, ACTIVITY)
