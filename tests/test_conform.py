from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows

from salesmarts.operators import conform
from salesmarts.operators.dedup import distinct_rows, keep_one
from salesmarts.sources.schemas import CSV_FILES, DATABASE_TABLES, JSON_RECORDS

LOOKUP = [("Germany", "EMEA"), ("UK", "EMEA"), ("Mexico", "AMER"), ("Japan", "APAC")]


def _orders(spark, data):
    return spark.createDataFrame(data, DATABASE_TABLES["orders"])


def test_same_key_in_other_spelling_is_one_customer(spark):
    raw = spark.createDataFrame(
        [(" alfki ", "A", "x", " Germany "), ("ALFKI", "A", "x", "Germany"), ("BERGS", "B", "y", "UK")],
        DATABASE_TABLES["customers"],
    )
    assert rows(conform.silver_customers(raw)) == [
        ("ALFKI", "A", "x", "Germany"), ("BERGS", "B", "y", "UK"),
    ]


def test_trim_removes_spaces_only(spark):
    raw = spark.createDataFrame([("A", "\tTab ", None, "UK")], DATABASE_TABLES["customers"])
    assert rows(conform.silver_customers(raw)) == [("A", "\tTab", None, "UK")]


def test_kept_row_does_not_depend_on_partitioning(spark):
    data = [(k, None if v == 3 else f"v{v}", v % 4) for k in range(5) for v in range(12)]
    df = spark.createDataFrame(data, "k int, name string, n int")
    want = rows(keep_one(df, ["k"], prefer=["n"]))
    assert want == [(k, "v7", 3) for k in range(5)]
    for parts in (1, 3, 7):
        assert rows(keep_one(df.orderBy("name").repartition(parts), ["k"], prefer=["n"])) == want


def test_kept_row_is_whole_and_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 9, None)], "k int, n int, s string")
    assert rows(keep_one(df, ["k"])) == [(None, 2, "b"), (1, 9, None)]


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "k int, s string")
    assert len(rows(distinct_rows(df))) == 3


def test_orders_take_the_region_of_their_country(spark):
    raw = _orders(
        spark,
        [
            (1, " alfki", 3, "2024-01-05", "2024-01-09", 1, " germany "),
            (1, "ALFKI", 3, "2024-01-05", "2024-01-09", 1, "germany"),
            (2, "BERGS", 4, "", "not a date", 2, "Atlantis"),
            (3, "BERGS", None, "2024-02-30", None, 2, None),
        ],
    )
    lookup = spark.createDataFrame(LOOKUP + [("GERMANY ", "EMEA")], "Country string, Region string")
    day = dt.date
    assert rows(conform.silver_orders(raw, lookup)) == [
        (1, "ALFKI", 3, day(2024, 1, 5), day(2024, 1, 9), 1, "germany", "EMEA"),
        (2, "BERGS", 4, None, None, 2, "Atlantis", None),
        (3, "BERGS", None, None, None, 2, None, None),
    ]


def test_fewer_columns_keep_the_same_orders(spark):
    raw = _orders(
        spark,
        [(i % 40, f"C{i % 7}", i % 5, f"2024-01-{i % 28 + 1:02d}", None, i % 3, "UK") for i in range(200)],
    )
    few = ("order_id", "order_date", "customer_id")
    full = conform.silver_orders(raw)
    part = conform.silver_orders(raw.select("OrderID", "OrderDate", "CustomerID"), columns=few)
    assert rows(full.select(*few)) == rows(part.select(*few))
    with pytest.raises(ValueError):
        conform.silver_orders(raw, columns=("order_id", "shipper_id"))


def test_products_with_category_and_supplier(spark):
    products = spark.createDataFrame(
        [(1, " Chai ", 1, 1, 18.0), (2, "Chang", 1, 9, 19.005), (3, "Odd", 77, 1, None)],
        JSON_RECORDS["products"],
    )
    categories = spark.createDataFrame([(1, "Beverages ", "drinks, and so on")], CSV_FILES["categories"])
    suppliers = spark.createDataFrame([(1, "Exotic", "c", "London", "UK")], CSV_FILES["suppliers"])
    assert rows(conform.silver_products(products, categories, suppliers)) == [
        (1, "Chai", 1, 1, Decimal("18.00"), "Beverages", "Exotic", "UK"),
        (2, "Chang", 1, 9, Decimal("19.01"), "Beverages", None, None),
        (3, "Odd", 77, 1, None, None, "Exotic", "UK"),
    ]


def test_order_details_are_exact(spark):
    raw = spark.createDataFrame(
        [(1, 1, 17.45, 1, 0.1), (1, 2, 10.0, 3, 1.0), (2, 1, None, 3, 0.0)],
        DATABASE_TABLES["orderdetails"],
    )
    out = conform.silver_order_details(raw)
    assert out.columns == ["order_id", "product_id", "unit_price", "quantity", "discount", "line_revenue"]
    assert [r.line_revenue for r in out.orderBy("order_id", "product_id").collect()] == [
        Decimal("15.71"), Decimal("0.00"), None,
    ]


def test_activity_of_a_customer_without_orders(spark):
    raw = spark.createDataFrame(
        [(" alfki", 4, "2023-01-27", "2023-07-03", 548), ("NEW", 0, None, "", None)],
        CSV_FILES["customer_activity_export"],
    )
    assert rows(conform.silver_customer_activity(raw)) == [
        ("ALFKI", 4, dt.date(2023, 1, 27), dt.date(2023, 7, 3), 548),
        ("NEW", 0, None, None, None),
    ]


def test_employees_and_rename(spark):
    raw = spark.createDataFrame([(1, " Ann ", "Lee", None), (1, "Ann", "Lee", None)], DATABASE_TABLES["employees"])
    assert rows(conform.silver_employees(raw)) == [(1, "Ann", "Lee", None)]
    assert conform.silver_employees(raw).columns[0] == "employee_id"


def test_rejected_values_are_counted_without_turning_numbers_into_text(spark):
    raw = [(1.5, "x", "2024-01-01"), (float("nan"), " ", None), (None, "7", "soon"), (1e30, None, "")]
    df = spark.createDataFrame(raw, "price double, n string, day string")
    rules = {"price": ("PRICE", conform.to_cents), "n": ("n", conform._bigint), "day": ("day", conform.iso_date)}
    counted = df.agg(*conform.rejected(df, rules))
    assert counted.first()[:] == (2, 1, 1)
    assert "cast(price" not in counted._jdf.queryExecution().analyzed().toString()
