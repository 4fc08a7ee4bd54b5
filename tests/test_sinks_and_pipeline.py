from __future__ import annotations

import datetime as dt
import glob
import json
import os
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_sources import CATEGORIES, LOOKUP

from salesmarts import PipelineConfig, run_pipeline
from salesmarts.operators.audit import layer_row_counts
from salesmarts.operators.ordering import ordered
from salesmarts.plans.pipeline import FEED, read_object_store
from salesmarts.session import scratch, scratch_path, sized
from salesmarts.sinks.exports import export_csv, export_json, export_json_document
from salesmarts.sinks.tables import (
    ensure_schema,
    load_table,
    publish_view,
    replace_table,
    use_schema,
)
from salesmarts.sources.database import TableSplit
from salesmarts.sources.files import read_csv
from salesmarts.sources.schemas import DATABASE_TABLES


def test_replace_table_counts_what_it_writes(spark):
    ensure_schema(spark, "sink_test")
    assert replace_table(spark.range(50).repartition(3), "sink_test.t") == 50
    assert replace_table(spark.range(7).orderBy("id"), "sink_test.t") == 7
    assert spark.table("sink_test.t").count() == 7
    assert replace_table(spark.range(0), "sink_test.empty") == 0


def test_replace_table_by_partition(spark):
    ensure_schema(spark, "sink_test")
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    assert replace_table(df, "sink_test.parts", partition_by=("p",)) == 10
    assert spark.sql("SHOW PARTITIONS sink_test.parts").count() == 2


def test_load_renames_and_appends_only_when_asked(spark):
    use_schema(spark, "sink_test")
    raw = spark.createDataFrame([(1, "Speedy")], DATABASE_TABLES["shippers"])
    for mode, want in (("overwrite", 1), ("overwrite", 1), ("append", 2)):
        load_table(raw, "sink_test.shippers", {"ShipperID": "shipper_id", "CompanyName": "company_name"}, mode)
        assert spark.table("shippers").count() == want
    assert spark.table("sink_test.shippers").columns == ["shipper_id", "company_name"]
    spark.sql("USE default")


def test_view(spark):
    publish_view(spark.range(3), "three")
    assert spark.sql("SELECT sum(id) FROM three").first()[0] == 3


def test_csv_export_reads_back(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'a "b", c', True, Decimal("1.10"), dt.date(2024, 1, 2)), (2, None, False, None, None)],
        "id int, note string, flag boolean, amount decimal(18,2), day date",
    )
    path = str(tmp_path / "out")
    export_csv(df, path, files=1)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1
    assert rows(read_csv(spark, path, df.schema)) == rows(df)


def test_csv_export_keeps_spaces_quotes_and_line_breaks(spark, tmp_path):
    texts = [" lead", "trail ", " both ", 'say "no"', "back\\slash", "two\nlines", "comma, too", 'end"', "\ttab"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, note string")
    export_csv(df, str(tmp_path / "out"))
    assert rows(read_csv(spark, str(tmp_path / "out"), df.schema, multi_line=True)) == rows(df)


def test_ordered_exports_stay_in_order(spark, tmp_path):
    months = [(f"{y}-{m:02d}", y * m) for y in range(1900, 2000) for m in range(1, 13)]
    random.Random(1).shuffle(months)
    df = spark.createDataFrame(months, "year_month string, total_revenue bigint").repartition(6)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_csv(ordered("sales_monthly", df), str(tmp_path / "m"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    parts = sorted((tmp_path / "m").glob("part-*.csv"))
    lines = [x for p in parts for x in p.read_text().splitlines()[1:]]
    assert len(parts) > 1 and [x.split(",")[0] for x in lines] == sorted(m for m, _ in months)
    top = ordered("top_products", spark.createDataFrame([(2, 5), (1, 5), (3, 9)], "product_id int, total_revenue int"))
    assert [r.product_id for r in top.collect()] == [3, 1, 2]


def test_lost_values_are_counted(spark, sources, tmp_path):
    _, database, lines = sources
    bad = spark.createDataFrame(
        [("1", "1", "1e17", "2", "0"), ("2", "1", "abc", "2", "0"), ("3", "x", "1.5", "many", "0"), ("4", "1", "", None, "0")],
        "OrderID string, ProductID string, UnitPrice string, Quantity string, Discount string",
    )
    cfg = PipelineConfig(
        object_store_path=sources[0], bronze_schema="b_lost", silver_schema="s_lost", gold_schema="g_lost",
        location=str(tmp_path / "tables"), fact_partition_by=("year_month",),
    )
    lost = {}
    run_pipeline(spark, cfg, database | {"orderdetails": bad}, rejected=lost)
    assert lost == {"order_details.price_cents": 2, "order_details.product_id": 1, "order_details.quantity": 1}
    assert (tmp_path / "tables" / "gold").is_dir()
    one = spark.table(cfg.table("gold", "sales_fact")).where("year_month = '2024-03'")
    assert "PartitionFilters: [isnotnull(year_month" in one._jdf.queryExecution().executedPlan().toString()


def test_order_tables_are_read_in_parallel_by_default():
    cfg = PipelineConfig(database_partitions=12, database_splits={"customers": TableSplit("X", 3)})
    assert cfg.split("orders") == cfg.split("orderdetails") == TableSplit("OrderID", 12)
    assert cfg.split("customers").partitions == 3 and cfg.split("shippers").partitions == 1


def test_json_feed(spark, tmp_path):
    df = spark.createDataFrame([("EMEA", None), ("AMER", 2)], "region string, n int")
    export_json({"gold_a": df, "gold_b": df.limit(0)}, str(tmp_path))
    lines = [json.loads(s) for p in (tmp_path / "gold_a").glob("part-*") for s in p.read_text().splitlines()]
    assert sorted(lines, key=str) == [{"region": "AMER", "n": 2}, {"region": "EMEA", "n": None}]
    assert spark.read.schema(df.schema).json(str(tmp_path / "gold_b")).count() == 0


def test_json_document(spark, tmp_path):
    months = [(f"{y}-{m:02d}", Decimal(y * m) / 4) for y in range(1990, 2000) for m in range(1, 13)]
    random.Random(1).shuffle(months)
    monthly = spark.createDataFrame(months, "year_month string, total_revenue decimal(18,2)").repartition(5)
    regions = spark.createDataFrame([(None, 1), ("EMEA", None), ('a "b"', 2)], "region string, n int").repartition(3)
    export_json_document({"m": ordered("sales_monthly", monthly), "none": regions.limit(0), "r": regions}, str(tmp_path / "doc"))
    parts = sorted((tmp_path / "doc").glob("part-*.txt"))
    found = json.loads("".join(p.read_text() for p in parts))
    assert list(found) == ["m", "none", "r"] and len(parts) > 3 and found["none"] == []
    assert found["m"] == [{"year_month": m, "total_revenue": float(v)} for m, v in sorted(months)]
    assert sorted(map(str, found["r"])) == sorted(map(str, [{"region": r.region, "n": r.n} for r in regions.collect()]))


def test_layer_row_counts(spark):
    counts = layer_row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(counts) == [("a", 3), ("b", 0)]


def test_scratch_paths_are_in_the_shared_folder_and_fresh(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_is_deleted_afterwards(spark):
    with scratch(spark, "gone") as path:
        spark.range(3).write.parquet(path)
        assert os.path.isdir(path)
    assert not os.path.exists(path)
    with scratch(spark, "never-written"):
        pass


def test_sizes_grow_with_the_input_up_to_what_a_driver_tracks():
    assert sized(0) == {
        "spark.sql.files.maxPartitionBytes": str(128 << 20), "spark.sql.shuffle.partitions": "8",
    }
    assert sized(1 << 40)["spark.sql.shuffle.partitions"] == "4096"
    large = {k: int(v) for k, v in sized(100 << 40).items()}
    assert large["spark.sql.shuffle.partitions"] == 50_000
    assert (100 << 40) / large["spark.sql.files.maxPartitionBytes"] <= 200_000
    assert int(sized(1 << 50)["spark.sql.files.maxPartitionBytes"]) >= (1 << 50) // 200_000
    assert sized(1 << 40, max_reducers=100)["spark.sql.shuffle.partitions"] == "100"


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """A small year of sales over the sample files."""
    rnd = random.Random(11)
    store = tmp_path_factory.mktemp("store")
    (store / "categories.csv").write_text(CATEGORIES)
    (store / "suppliers.csv").write_text("SupplierID,CompanyName,ContactName,City,Country\n1,Exotic,C,London,UK\n")
    (store / "customer_activity_export.csv").write_text(
        "CustomerID,TotalOrders,FirstOrderDate,LastOrderDate,DaysSinceLastOrder\nC1,3,2024-01-01,2024-10-01,92\nC9,0,,,\n"
    )
    (store / "products.json").write_text(
        json.dumps(
            [
                {"ProductID": i, "ProductName": f"P{i}", "CategoryID": 1 if i % 2 else 4, "SupplierID": 1, "UnitPrice": 10.0 + i}
                for i in range(1, 13)
            ]
        )
    )
    (store / "order_region_lookup.json").write_text(LOOKUP)
    countries = ["UK", "Mexico", "Germany", "Atlantis"]
    orders = [
        (i, f" c{i % 9} ", i % 3 + 1, f"2024-{i % 12 + 1:02d}-{i % 28 + 1:02d}", "", 1, countries[i % 4]) for i in range(1, 101)
    ]
    lines = [
        (rnd.randint(1, 104), p, 10.0 + p, rnd.randint(1, 30), rnd.choice([0.0, 0.05, 0.1, 0.2])) for p in range(1, 14) for _ in range(30)
    ]
    frames = {
        "customers": [(f"C{i}", f"Company {i}", "x", "UK") for i in range(9)],
        "employees": [(i, f"F{i}", f"L{i}", "Rep") for i in range(1, 4)],
        "shippers": [(1, "Speedy")],
        "orders": orders + orders[:5],
        "orderdetails": lines,
    }
    return str(store), {n: spark.createDataFrame(d, DATABASE_TABLES[n]) for n, d in frames.items()}, lines


@pytest.fixture(scope="module", params=["left", "inner"])
def run(request, spark, sources, tmp_path_factory):
    store, database, _ = sources
    how = request.param
    cfg = PipelineConfig(
        object_store_path=store,
        bronze_schema=f"b_{how}", silver_schema=f"s_{how}", gold_schema=f"g_{how}",
        fact_join=how, top_n=5, export_path=str(tmp_path_factory.mktemp("export")), feed_document=True,
        fact_partition_by=("region",) if how == "inner" else (),
    )
    return cfg, run_pipeline(spark, cfg, database)


def test_pipeline_writes_every_table(spark, run, sources):
    cfg, counts = run
    assert len(counts) == 23
    assert all(spark.table(t).count() == n for t, n in counts.items())
    assert counts[cfg.table("silver", "orders")] == 100
    kept = [ln for ln in sources[2] if cfg.fact_join == "left" or ln[0] <= 100]
    assert counts[cfg.table("gold", "sales_fact")] == len(kept)
    assert counts[cfg.table("gold", "top_products")] == 5
    bronze = spark.table(cfg.table("bronze", "orders"))
    assert bronze.columns[-2:] == ["_ingest_ts", "_source_system"]
    assert spark.table(cfg.table("bronze", "products")).first()._source_system == "object_store"


def test_pipeline_marts_sum_to_the_lines(spark, run, sources):
    cfg, _ = run
    kept = [ln for ln in sources[2] if cfg.fact_join == "left" or ln[0] <= 100]
    cents = Decimal("0.01")
    total = sum(
        (Decimal(str(p)) * q * (1 - Decimal(str(d)))).quantize(cents, "ROUND_HALF_UP") for _, _, p, q, d in kept
    )
    def gold(name):
        return spark.table(cfg.table("gold", name))
    for name, column in (
        ("sales_fact", "line_revenue"), ("sales_monthly", "total_revenue"), ("sales_by_region", "total_revenue"),
        ("sales_by_category", "total_revenue"), ("customer_churn", "monetary_total"),
    ):
        assert gold(name).agg(F.sum(column)).first()[0] == total, name
    orders = len({ln[0] for ln in kept})
    assert gold("sales_monthly").agg(F.sum("order_count")).first()[0] == orders
    assert gold("customer_churn").agg(F.sum("frequency_orders")).first()[0] == orders
    assert gold("sales_by_category").where("category_name IS NULL").count() == 1  # product 13 is unknown
    assert gold("sales_by_region").where("region IS NULL").count() == 1
    assert gold("churn_summary").agg(F.sum("total_customers")).first()[0] == gold("customer_churn").count()
    assert gold("customer_churn").where("customer_id = 'C1'").first().recency_days == 92


def test_pipeline_exports(spark, run):
    cfg, counts = run
    fact = spark.table(cfg.table("gold", "sales_fact"))
    back = read_csv(spark, f"{cfg.export_path}/csv/gold_sales_fact", fact.schema)
    assert rows(back) == rows(fact)
    feed = spark.read.json(f"{cfg.export_path}/feed/gold_customer_churn")
    assert feed.count() == counts[cfg.table("gold", "customer_churn")]
    parts = sorted(glob.glob(f"{cfg.export_path}/feed_document/part-*"))
    document = json.loads("".join(open(p).read() for p in parts))
    assert {t: len(rows_) for t, rows_ in document.items()} == {
        f"gold_{n}": counts[cfg.table("gold", n)] for n in FEED
    }


def test_lined_json_and_compressed_files(spark, sources, tmp_path):
    import gzip
    import shutil

    store, database, _ = sources
    for name in os.listdir(store):
        shutil.copy(os.path.join(store, name), tmp_path / name)
    with open(os.path.join(store, "products.json")) as f:
        (tmp_path / "products.json").write_text("\n".join(json.dumps(x) for x in json.load(f)))
    (tmp_path / "cats.csv.gz").write_bytes(gzip.compress((tmp_path / "categories.csv").read_bytes()))
    cfg = PipelineConfig(object_store_path=str(tmp_path), json_lines=True, file_names={"categories": "cats.csv.gz"})
    plain = PipelineConfig(object_store_path=store)
    for name in ("products", "categories"):
        a, b = read_object_store(spark, cfg)[name], read_object_store(spark, plain)[name]
        assert rows(a) == rows(b) and a.count() > 0


def test_a_run_leaves_no_scratch_data(spark, run, sources):
    shared = spark.conf.get("spark.checkpoint.dir")
    folder = os.path.join(shared, f"scratch-{spark.sparkContext.applicationId}")
    before = set(os.listdir(folder))
    run_pipeline(spark, run[0], sources[1])
    assert set(os.listdir(folder)) <= before


def test_pipeline_can_be_run_again(spark, run, sources):
    cfg, counts = run
    assert run_pipeline(spark, cfg, sources[1]) == counts
