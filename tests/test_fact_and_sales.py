from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows
from golden import MONTHS
from pyspark.sql import functions as F

from salesmarts.operators.ordering import ordered  # noqa: I001
from salesmarts.operators import fact, kpis, sales

D = Decimal


@pytest.fixture(scope="module")
def silver(spark):
    day = dt.date
    lines = spark.createDataFrame(
        [
            (1, 10, D("18.00"), 2, D("0.00"), D("36.00")),
            (1, 11, D("19.00"), 1, D("0.10"), D("17.10")),
            (2, 10, D("18.00"), 1, D("0.00"), D("18.00")),
            (3, 99, D("5.00"), 4, D("0.00"), D("20.00")),
            (8, 11, D("7.00"), 1, D("0.00"), D("7.00")),  # no such order
        ],
        "order_id bigint, product_id bigint, unit_price decimal(12,2), quantity int, "
        "discount decimal(4,2), line_revenue decimal(18,2)",
    )
    orders = spark.createDataFrame(
        [
            (1, "A", 5, day(2024, 1, 31), day(2024, 2, 3), 1, "UK", "EMEA"),
            (2, "A", 6, day(2024, 2, 1), None, 1, "Mexico", "AMER"),
            (3, "Z", None, day(2024, 2, 9), None, 1, "Atlantis", None),
        ],
        "order_id bigint, customer_id string, employee_id bigint, order_date date, "
        "shipped_date date, shipper_id bigint, ship_country string, region string",
    )
    products = spark.createDataFrame(
        [(10, "Chai", "Beverages"), (11, "Chang", "Beverages")],
        "product_id bigint, product_name string, category_name string",
    )
    customers = spark.createDataFrame([("A", "Alfreds", "UK")], "customer_id string, company_name string, country string")
    employees = spark.createDataFrame([(5, "Ann", "Lee")], "employee_id bigint, first_name string, last_name string")
    return lines, orders, products, customers, employees


def test_fact_keeps_every_line(silver):
    out = fact.sales_fact(*silver)
    assert out.columns == list(fact.FACT_COLUMNS)
    got = {(r.order_id, r.product_id): r for r in out.collect()}
    assert len(got) == 5
    first = got[(1, 10)]
    assert (first.company_name, first.first_name, first.category_name, first.region) == (
        "Alfreds", "Ann", "Beverages", "EMEA",
    )
    assert got[(3, 99)].category_name is None and got[(3, 99)].company_name is None
    assert got[(8, 11)].order_date is None and got[(8, 11)].product_name == "Chang"
    assert got[(1, 11)].unit_price == D("19.00")


def test_inner_fact_drops_lines_without_order(silver):
    assert sorted(r.order_id for r in fact.sales_fact(*silver, how="inner").collect()) == [1, 1, 2, 3]


def test_marts_keep_null_groups(silver):
    lines, orders, products, *_ = silver
    by_order, by_product = fact.order_sales(lines, orders), fact.product_sales(lines, products)
    assert rows(sales.sales_by_region(by_order)) == [
        (None, D("27.00"), 2), ("AMER", D("18.00"), 1), ("EMEA", D("53.10"), 1),
    ]
    assert rows(sales.sales_by_category(by_product)) == [
        (None, D("20.00"), 4), ("Beverages", D("78.10"), 5),
    ]
    assert rows(sales.sales_monthly(by_order)) == [
        (None, D("7.00"), 1, 0), ("2024-01", D("53.10"), 1, 1), ("2024-02", D("38.00"), 2, 2),
    ]


def test_marts_from_a_stored_fact_are_the_same(silver):
    lines, orders, products, *_ = silver
    stored = fact.sales_fact(*silver)
    for mart in (sales.sales_monthly, sales.sales_by_region):
        assert rows(mart(fact.order_sales_of(stored))) == rows(mart(fact.order_sales(lines, orders)))
    for mart in (sales.sales_by_category, sales.top_products):
        assert rows(mart(fact.product_sales_of(stored))) == rows(mart(fact.product_sales(lines, products)))


def test_marts_are_sorted(spark, silver):
    lines, orders, products, *_ = silver
    months = [r.year_month for r in ordered("sales_monthly", sales.sales_monthly(fact.order_sales(lines, orders))).collect()]
    assert months == [None, "2024-01", "2024-02"]
    totals = [r.total_revenue for r in ordered("sales_by_category", sales.sales_by_category(fact.product_sales(lines, products))).collect()]
    assert totals == sorted(totals, reverse=True)


def test_tie_at_the_last_rank_goes_to_the_lower_id(spark):
    sums = spark.createDataFrame(
        [(i, f"p{i}", "c", 500 if i > 3 else 900, 1) for i in range(15, 0, -1)],
        "product_id bigint, product_name string, category_name string, revenue_cents bigint, units bigint",
    )
    assert [r.product_id for r in ordered("top_products", sales.top_products(sums)).collect()] == list(range(1, 11))
    named = spark.createDataFrame([(1, "one", "c")], "product_id bigint, product_name string, category_name string")
    joined = sales.top_products(sums.select("product_id", "revenue_cents", "units"), 2, named)
    assert rows(joined) == [(1, "one", "c", D("9.00"), 1), (2, None, None, D("9.00"), 1)]
    assert len(sales.top_products(sums, 3).collect()) == 3
    assert [(r.product_id, r["rank"]) for r in kpis.ranked(sales.top_products(sums, 3)).orderBy("rank").collect()] == [
        (1, 1), (2, 2), (3, 3),
    ]


def test_every_mart_sums_to_the_fact_however_rows_are_ordered(spark):
    rnd = random.Random(3)
    data = [
        (rnd.randint(1, 60), rnd.randint(1, 9), rnd.randint(1, 30), rnd.randint(0, 99999)) for _ in range(400)
    ]
    def lines(d):
        return spark.createDataFrame(d, "order_id bigint, product_id bigint, quantity int, revenue_cents bigint")
    orders = spark.createDataFrame(
        [(i, dt.date(2024, 1 + i % 5, 1 + i % 28), f"C{i % 11}", ["EMEA", "AMER", None][i % 3]) for i in range(1, 61)],
        "order_id bigint, order_date date, customer_id string, region string",
    )
    products = spark.createDataFrame(
        [(i, f"p{i}", f"c{i % 4}") for i in range(1, 10)],
        "product_id bigint, product_name string, category_name string",
    )
    total = D(sum(r[3] for r in data)).scaleb(-2)
    seen = len({r[0] for r in data})
    shuffled = data[:]
    rnd.shuffle(shuffled)
    results = []
    for d in (lines(data), lines(shuffled).repartition(5)):
        by_order, by_product = fact.order_sales(d, orders), fact.product_sales(d, products)
        marts = [
            sales.sales_monthly(by_order), sales.sales_by_region(by_order),
            sales.sales_by_category(by_product), sales.top_products(by_product, 100),
        ]
        results.append([rows(m) for m in marts])
        for m in marts:
            assert m.agg(F.sum("total_revenue")).first()[0] == total
        for m in marts[:2]:
            assert m.agg(F.sum("order_count")).first()[0] == seen
        for m in marts[2:]:
            assert m.agg(F.sum("units_sold")).first()[0] == sum(r[2] for r in data)
    assert results[0] == results[1]


@pytest.fixture(scope="module")
def monthly(spark):
    return spark.createDataFrame(
        [(m, D(v), o, c) for m, v, o, c in MONTHS],
        "year_month string, total_revenue decimal(28,2), order_count bigint, active_customers bigint",
    )


def test_golden_kpis(monthly):
    row = kpis.kpi_sales(monthly).first()
    assert (row.total_revenue, row.total_orders, row.months) == (D("190643.76"), 158, 24)
    assert row.avg_order_value == D("1206.61")


def test_golden_change_of_the_latest_month(monthly):
    change = {r.year_month: r.mom_change_pct for r in kpis.sales_mom(monthly).collect()}
    assert change["2024-12"] == D("86.7") and change["2023-01"] is None
    assert change["2023-06"] == D("-45.9")
    assert kpis.latest_month(monthly).first().year_month == "2024-12"


def test_change_after_a_month_of_zero_is_null(spark):
    df = spark.createDataFrame(
        [("2024-01", D("0.00")), ("2024-02", D("5.00"))], "year_month string, total_revenue decimal(18,2)"
    )
    assert [r.mom_change_pct for r in kpis.sales_mom(df).collect()] == [None, None]


def test_sales_of_unknown_month_are_no_month_before(spark):
    df = spark.createDataFrame(
        [(None, D("9.00")), ("2024-01", D("4.00")), ("2024-02", D("5.00"))],
        "year_month string, total_revenue decimal(18,2)",
    )
    got = {r.year_month: r.mom_change_pct for r in kpis.sales_mom(df).collect()}
    assert got == {None: None, "2024-01": None, "2024-02": D("25.0")}
    assert kpis.latest_month(df).first().year_month == "2024-02"


def test_shares_and_labels(monthly):
    share = {r.year_month: r.share_of_max_pct for r in kpis.share_of_max(monthly, "total_revenue").collect()}
    assert share["2024-12"] == D("100.0") and share["2024-11"] == D("53.6")
    part = {r.year_month: r.fraction_of_max for r in kpis.fraction_of_max(monthly, "total_revenue").collect()}
    assert part["2024-12"] == 1.0 and part["2024-11"] == 9564.80 / 17856.33
    assert kpis.month_label(monthly).orderBy("year_month").first().month_label == "23-01"
