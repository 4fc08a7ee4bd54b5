"""Plans as they are when nothing can be broadcast, and what the adaptive planner makes of a
hot key."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from salesmarts.bound import queries
from salesmarts.bound.queries import all_queries
from salesmarts.bound.tables import BoundTables
from salesmarts.operators import fact
from salesmarts.operators.dedup import keep_one
from salesmarts.operators.joins import attach

SF = "/root/testdata/sf0.001"


@pytest.fixture
def large(spark):
    """Settings under which small test data is treated as too large to broadcast."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join_and_no_python(large, name):
    plan = _plan(all_queries()[name](large, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_monthly_reads_only_what_it_needs(large):
    plan = _plan(all_queries()["sales_monthly"](large, SF))
    read = set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan))
    columns = {re.sub(r"#\d+L?", "", c) for group in read for c in group.split(",")}
    assert columns == {
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "o_orderkey", "o_custkey", "o_orderdate",
    }
    assert plan.count("Join") == 1


def test_lines_are_summed_before_they_are_shuffled(large):
    plan = _plan(all_queries()["sales_by_category"](large, SF))
    lines = plan[: plan.index("l_partkey")]
    last = lines.rindex("Exchange")
    assert "partial_sum" in lines[last:]


def test_top_products_needs_no_total_sort(large):
    assert "TakeOrderedAndProject" in _plan(all_queries()["top_products"](large, SF))


def test_unused_dimension_is_not_joined(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 7)
    dimension = keep_one(spark.range(7).select(F.col("id").alias("k"), F.lit("n").alias("name")), ["k"])
    assert "Join" not in _plan(big.join(dimension, "k", "left").select("id"))


@pytest.mark.parametrize("name", ["category_share_of_max", "region_share_of_max", "product_share_of_max", "churn_share_of_max"])
def test_lines_are_scanned_once_for_shares(large, name):
    plan = _plan(all_queries()[name](large, SF))
    scans = re.findall(r"FileScan parquet \[([^\]]*l_orderkey[^\]]*|[^\]]*l_partkey[^\]]*)\]", plan)
    assert len(scans) == 1 and "Subquery" not in plan


def test_counts_join_the_fact_once(large):
    counted = queries._fact(BoundTables(large, SF), split_hot=False).agg(F.count("*"))
    joins = re.findall(r"SortMergeJoin \[(\w+)", _plan(counted))
    assert joins.count("order_id") == 1 and not {"customer_id", "employee_id"} & set(joins)


def test_top_products_are_limited_before_their_names_are_joined(large):
    plan = _plan(all_queries()["top_products"](large, SF))
    assert plan.index("Join") < plan.index("TakeOrderedAndProject", plan.index("Join"))


def test_products_are_not_shuffled_by_category(spark):
    plan = _plan(all_queries()["silver_products"](spark, SF))
    assert re.search(r"BroadcastHashJoin \[category_id", plan)
    assert "SortMergeJoin [category_id" not in plan


def _written_plans(spark, build):
    """Plans of all that ``build`` writes while it runs, and of what it returns."""
    seen = []
    frame = type(spark.range(0))
    plain = frame.write.fget

    def write(self):
        seen.append(_plan(self))
        return plain(self)

    frame.write = property(write)
    try:
        seen.append(_plan(build()))
    finally:
        frame.write = property(plain)
    return seen


@pytest.mark.parametrize("name", ["scan_csv", "null_tokens", "scan_json", "export_csv", "export_json", "gold_run", "gzip_scan", "raw_json_view"])
def test_what_is_written_has_no_cross_join_and_no_python(large, name):
    plans = _written_plans(large, lambda: all_queries()[name](large, SF))
    assert len(plans) > 1
    for plan in plans:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_hot_key_is_split(large):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    big = large.range(0, 300000, 1, 8).select(
        hot.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("text")
    )
    dimension = keep_one(
        large.range(10000).select((F.col("id") % 5000).alias("k"), F.concat(F.lit("n"), "id").alias("name")), ["k"]
    )
    joined = attach(big, dimension, "k")
    assert "SortMergeJoin(skew=true)" in _final_plan(joined)
    assert joined.agg(F.count("*"), F.count("name"), F.sum("id")).first()[:] == (300000, 300000, 44999850000)


def test_fact_with_a_hot_order_product_and_customer(large):
    """A third of the lines on one product, another on one order, most orders on one customer."""
    n = 240000
    i = F.col("id")
    lines = large.range(0, n, 1, 8).select(
        F.when(i % 3 == 1, 5).otherwise(i % 20000).alias("order_id"),
        F.when(i % 3 == 0, 7).otherwise(i % 4000).alias("product_id"),
        F.lit("9.99").cast("decimal(12,2)").alias("unit_price"),
        F.lit(1).alias("quantity"),
        F.lit("0.00").cast("decimal(4,2)").alias("discount"),
        (i % 100000).cast("decimal(18,2)").alias("line_revenue"),
    )
    orders = keep_one(
        large.range(40000).select(
            (i % 20000).alias("order_id"),
            F.lit("2024-05-06").cast("date").alias("order_date"),
            F.lit(None).cast("date").alias("shipped_date"),
            F.when(i % 20000 < 15000, "hot").otherwise(F.concat(F.lit("C"), i % 20000)).alias("customer_id"),
            (i % 9).alias("employee_id"),
            F.lit("EMEA").alias("region"),
        ),
        ["order_id"],
    )
    products = keep_one(
        large.range(4000).select(
            i.alias("product_id"), F.sha2(i.cast("string"), 256).alias("product_name"), F.lit("c").alias("category_name")
        ),
        ["product_id"],
    )
    customers = keep_one(
        large.createDataFrame([("hot", "Hot", "UK")], "customer_id string, company_name string, country string"),
        ["customer_id"],
    )
    employees = large.range(9).select(i.alias("employee_id"), F.lit("f").alias("first_name"), F.lit("l").alias("last_name"))
    out = fact.sales_fact(lines, orders, products, customers, employees)
    assert _final_plan(out).split("Initial Plan")[0].count("skew=true") >= 2
    hot_orders = 15000
    want_hot = sum(1 for k in range(n) if (5 if k % 3 == 1 else k % 20000) < hot_orders)
    got = out.agg(
        F.count("*"), F.sum("line_revenue").cast("bigint"), F.count("product_name"), F.count("company_name")
    ).first()
    assert got[:] == (n, sum(k % 100000 for k in range(n)), n, want_hot)


def test_hot_key_sends_one_row_per_map_task(large):
    rows = large.range(0, 80000, 1, 8).select(F.lit(1).alias("k"), "id")
    kept = keep_one(rows, ["k"])
    plan = kept._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    assert "partial_max" in plan.toString()
    assert kept.collect()[0][:] == (1, 79999)


def test_extremes_round_the_extremes_only(spark):
    amounts = ["-0.01", "9999999.99", "10000000.00", None, "2.50"]
    df = spark.createDataFrame([(a, a) for a in amounts], "t string, a string").withColumn("a", F.col("a").cast("decimal(38,2)"))
    found = queries._extremes(df)
    want = {"rows": "5", "nulls": "1", "least": "-1", "greatest": "1000000000"}
    assert {r.field: r.value for r in found.where("row_key = 'a'").collect()} == want
    assert {r.field: r.value for r in found.where("row_key = 't'").collect()} == want | {"least": "-0.01", "greatest": "9999999.99"}
    plan = _plan(found)
    assert "min(a" in plan and "min(cast(round" not in plan


def test_sums_of_a_fact_multiply_no_decimal_of_an_ordinary_line(spark):
    amounts = ["-0.01", "9999999.99", "10000000.00", None, "-10000000.01", "0.29", "1234567890123456789012345.67"]
    lines = spark.createDataFrame([(i // 4, a, 1) for i, a in enumerate(amounts)], "product_id bigint, line_revenue string, quantity bigint")
    sums = fact.product_sums(lines.withColumn("line_revenue", F.col("line_revenue").cast("decimal(38,2)")))
    assert {r.product_id: int(r.revenue_cents) for r in sums.collect()} == {
        0: 1999999998, 1: 123456789012345678901234567 - 1000000001 + 29,
    }
    assert "rint" in _plan(sums).lower()
