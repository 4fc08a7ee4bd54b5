from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from golden import CUSTOMERS
from pyspark.sql import functions as F

from salesmarts.operators.ordering import ordered  # noqa: I001
from salesmarts.operators import churn, kpis

REF = dt.date(2025, 1, 1)
ACTIVITY = "customer_id string, days_since_last_order int"


@pytest.fixture(scope="module")
def rfm(spark):
    day = dt.date.fromisoformat
    return spark.createDataFrame(
        [
            (c, f"Company {c}", None, region, n, Decimal(total), day(last), day(first))
            for c, region, n, total, last, first, *_ in CUSTOMERS
        ],
        "customer_id string, company_name string, country string, region string, "
        "frequency_orders bigint, monetary_total decimal(18,2), last_order_date date, "
        "first_order_date date",
    )


@pytest.fixture(scope="module", params=["exported", "counted"])
def golden(request, spark, rfm):
    """The same recency from the activity export and from the reference day."""
    listed = [(r[0], r[6]) for r in CUSTOMERS] if request.param == "exported" else []
    return churn.customer_churn(rfm, spark.createDataFrame(listed, ACTIVITY), REF)


def test_golden_customers(golden):
    assert golden.columns == list(churn.CHURN_COLUMNS)
    got = {
        r.customer_id: (r.recency_days, float(r.avg_order_value), r.customer_segment, r.is_churned)
        for r in golden.collect()
    }
    assert got == {r[0]: (*r[6:9], r[8] == "Churned") for r in CUSTOMERS}


def test_golden_summary_and_kpis(golden):
    assert rows(churn.churn_summary(golden)) == [
        ("AMER", 7, 2, Decimal("28.6")), ("EMEA", 18, 8, Decimal("44.4")),
    ]
    assert [r.region for r in ordered("churn_summary", churn.churn_summary(golden)).collect()] == ["EMEA", "AMER"]
    assert tuple(kpis.kpi_churn(golden).first()) == (25, 10, 2, 13, Decimal("40.0"))


def test_roster(golden):
    at_risk = kpis.customer_roster(golden, segment="At Risk")
    assert [r.customer_id for r in at_risk.collect()] == ["DUMON", "BERGS"]
    everyone = kpis.customer_roster(golden, sort_key="monetary_total", descending=False).collect()
    assert len(everyone) == 25 and everyone[0].customer_id == "BSBEV"
    with pytest.raises(ValueError):
        kpis.customer_roster(golden, sort_key="nothing")


@pytest.mark.parametrize(
    "days, segment, churned",
    [(60, "Active", False), (61, "At Risk", False), (180, "At Risk", False), (181, "Churned", True), (None, "At Risk", False)],
)
def test_segment_bounds(spark, rfm, days, segment, churned):
    one = rfm.limit(1).withColumn("customer_id", F.lit("X")).withColumn("last_order_date", F.lit(None).cast("date"))
    row = churn.customer_churn(one, spark.createDataFrame([("X", days)], ACTIVITY), REF).first()
    assert (row.recency_days, row.customer_segment, row.is_churned) == (days, segment, churned)


def test_other_thresholds(spark, rfm):
    none = spark.createDataFrame([], ACTIVITY)
    row = {r.customer_id: r for r in churn.customer_churn(rfm, none, "2025-01-01", 70, 10).collect()}
    assert row["BERGS"].customer_segment == "Churned" and row["BOLID"].customer_segment == "At Risk"
    assert row["BONAP"].customer_segment == "Active"


def test_customer_listed_twice_in_the_export_stays_one_row(spark, rfm):
    activity = spark.createDataFrame([("ALFKI", 548), ("ALFKI", 20), ("ANATR", None)], ACTIVITY)
    got = {r.customer_id: r.recency_days for r in churn.customer_churn(rfm, activity, REF).collect()}
    assert len(got) == 25 and got["ALFKI"] == 20 and got["ANATR"] == 379


def test_rfm_takes_the_region_of_the_last_order(spark):
    day = dt.date
    orders = spark.createDataFrame(
        [
            (1, day(2024, 1, 1), "A", "AMER", 100, 1),
            (2, day(2024, 5, 1), "A", "AMER", 250, 1),
            (3, day(2024, 5, 1), "A", "EMEA", 50, 1),
            (4, day(2024, 2, 1), "B", None, 10, 1),
            (5, None, None, None, 7, 1),
        ],
        "order_id bigint, order_date date, customer_id string, region string, revenue_cents bigint, units bigint",
    )
    customers = spark.createDataFrame([("A", "Alfreds", "UK")], "customer_id string, company_name string, country string")
    assert rows(churn.customer_rfm(orders, customers)) == [
        (None, None, None, None, 1, Decimal("0.07"), None, None),
        ("A", "Alfreds", "UK", "EMEA", 3, Decimal("4.00"), day(2024, 5, 1), day(2024, 1, 1)),
        ("B", None, None, None, 1, Decimal("0.10"), day(2024, 2, 1), day(2024, 2, 1)),
    ]


def test_activity_export_lists_customers_without_orders(spark):
    customers = spark.createDataFrame([("A",), ("N",)], "customer_id string")
    orders = spark.createDataFrame(
        [(1, "A", dt.date(2024, 12, 1)), (2, "A", dt.date(2024, 3, 1))],
        "order_id bigint, customer_id string, order_date date",
    )
    assert rows(churn.customer_activity_export(customers, orders, REF)) == [
        ("A", 2, dt.date(2024, 3, 1), dt.date(2024, 12, 1), 31), ("N", 0, None, None, None),
    ]


def test_segments_partition_the_customers(golden):
    counts = kpis.kpi_churn(golden).first()
    assert counts.total_customers == counts.churned_customers + counts.at_risk_customers + counts.active_customers
