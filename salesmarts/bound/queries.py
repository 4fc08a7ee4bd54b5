"""One named query per operator, over the star schema of ``BoundTables``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmarts.bound.tables import BoundTables
from salesmarts.functions.numeric import published
from salesmarts.operators import audit, churn, conform, dedup, fact, kpis, sales
from salesmarts.operators.ordering import ordered
from salesmarts.plans.config import PipelineConfig
from salesmarts.plans.pipeline import EXPORTED, Source, run_pipeline, stored_tables
from salesmarts.session import scratch_path
from salesmarts.sinks.exports import export_csv, export_json
from salesmarts.sinks.tables import (
    drop_schema,
    ensure_schema,
    load_table,
    publish_json_view,
    replace_table,
    table_location,
    version_folder,
)
from salesmarts.sources.files import (
    json_fields,
    json_object_rows,
    read_csv,
    read_json_records,
    read_raw_json,
)
from salesmarts.sources.lineage import with_lineage
from salesmarts.sources.loads import listed_files, load_checked, load_new_files
from salesmarts.sources.schemas import JSON_FIELDS

Query = Callable[[SparkSession, str], DataFrame]
Build = Callable[[BoundTables], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(name: str) -> Callable[[Build], Build]:
    """Register a query under ``name``, with its decimals published as doubles."""

    def register(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return published(build(BoundTables(spark, sf_dir)))

        _REGISTRY[name] = run
        return build

    return register


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# Grains shared by the queries


def _order_sales(t: BoundTables, region: bool = False) -> DataFrame:
    orders = t.placed_orders() if region else t.dated_orders()
    return fact.order_sales(t.order_lines(), orders)


def _product_sales(t: BoundTables) -> DataFrame:
    return fact.product_sales(t.order_lines(), t.sold_products())


def _fact(
    t: BoundTables, how: str = "left", orders: DataFrame | None = None, split_hot: bool = True
) -> DataFrame:
    return fact.sales_fact(
        t.silver_order_details(), orders or t.silver_orders(), t.sold_products(), t.silver_customers(),
        t.silver_employees(), how, split_hot,
    )


def _churn(t: BoundTables, churn_days: int = 180, orders: DataFrame | None = None) -> DataFrame:
    rfm = churn.customer_rfm(orders or _order_sales(t, region=True), t.silver_customers())
    return churn.customer_churn(
        rfm, t.silver_customer_activity(), t.reference_day(), churn_days
    )


def _stored(t: BoundTables, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once, for queries that use it several times."""
    path = scratch_path(t.spark, label)
    df.write.parquet(path)
    return t.spark.read.schema(df.schema).parquet(path)


def _marts(t: BoundTables) -> dict[str, DataFrame]:
    """The six marts from one pass over the lines per grain."""
    orders = _stored(t, _order_sales(t, region=True), "order-sums")
    products = _stored(t, _product_sales(t), "product-sums")
    customers = _stored(t, _churn(t, orders=orders), "churn")
    return {
        "sales_monthly": sales.sales_monthly(orders),
        "sales_by_category": sales.sales_by_category(products),
        "sales_by_region": sales.sales_by_region(orders),
        "top_products": sales.top_products(products),
        "customer_churn": customers,
        "churn_summary": churn.churn_summary(customers),
    }


# Sources


@_query("scan_csv")
def scan_csv(t: BoundTables) -> DataFrame:
    path = scratch_path(t.spark, "activity")
    export_csv(customer_activity_export(t), path)
    schema = (
        "customer_id STRING, total_orders BIGINT, first_order_date DATE, last_order_date DATE, "
        "days_since_last_order INT"
    )
    return read_csv(t.spark, path, schema)


@_query("null_tokens")
def null_tokens(t: BoundTables) -> DataFrame:
    """Every way a CSV field can be null, and quoted text with a comma."""
    segment = F.col("c_mktsegment")
    field = (
        F.when(segment == "BUILDING", "")
        .when(segment == "MACHINERY", '""')
        .when(segment == "FURNITURE", "NULL")
        .otherwise(F.concat(F.lit('"'), F.col("c_name"), F.lit(', '), segment, F.lit('"')))
    )
    lines = t.read("customer").select(F.concat_ws(",", F.col("c_custkey"), field).alias("value"))
    path = scratch_path(t.spark, "tokens")
    lines.write.text(path)
    return read_csv(t.spark, path, "customer_id BIGINT, note STRING", header=False)


@_query("scan_json")
def scan_json(t: BoundTables) -> DataFrame:
    """Products from JSON files that hold an array of records per line."""
    record = F.struct("ProductID", "ProductName", "CategoryID", "SupplierID", "UnitPrice")
    path = scratch_path(t.spark, "products")
    t.products().select(F.to_json(F.array(record)).alias("value")).write.text(path)
    schema = "ProductID BIGINT, ProductName STRING, CategoryID STRING, SupplierID BIGINT, UnitPrice DOUBLE"
    return read_json_records(t.spark, path, schema, multi_line=False)


@_query("json_object_rows")
def event_properties(t: BoundTables) -> DataFrame:
    return json_object_rows(t.read("events"), "props", keep=["event_id"])


@_query("json_path")
def json_path(t: BoundTables) -> DataFrame:
    return json_fields(t.read("events"), "props", {"k": ("$.k", "bigint")}, keep=["event_id", "user_id"])


@_query("ingest_lineage")
def ingest_lineage(t: BoundTables) -> DataFrame:
    """Raw orders with their source tag; the time of landing is left out as it varies."""
    return with_lineage(t.orders(), "db_source").drop("_ingest_ts")


# Conforming


@_query("silver_customers")
def silver_customers(t: BoundTables) -> DataFrame:
    return t.silver_customers()


@_query("silver_employees")
def silver_employees(t: BoundTables) -> DataFrame:
    return t.silver_employees()


@_query("silver_orders")
def silver_orders(t: BoundTables) -> DataFrame:
    return t.silver_orders()


@_query("silver_products")
def silver_products(t: BoundTables) -> DataFrame:
    return t.silver_products()


@_query("silver_order_details")
def silver_order_details(t: BoundTables) -> DataFrame:
    return t.silver_order_details()


@_query("silver_activity")
def silver_activity(t: BoundTables) -> DataFrame:
    return t.silver_customer_activity()


@_query("line_revenue")
def line_revenue(t: BoundTables) -> DataFrame:
    return t.silver_order_details().select("order_id", "product_id", "line_revenue")


@_query("dedup_by_key")
def dedup_by_key(t: BoundTables) -> DataFrame:
    lines = t.read("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return dedup.keep_one(lines, ["l_orderkey", "l_linenumber"], prefer=["l_shipdate", "l_partkey"])


@_query("distinct_rows")
def distinct_rows(t: BoundTables) -> DataFrame:
    """Whole lines, those of even orders given twice."""
    lines = t.read("lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return dedup.distinct_rows(lines.unionAll(lines.where("l_orderkey % 2 = 0")))


# Fact and sales marts


@_query("sales_fact")
def sales_fact(t: BoundTables) -> DataFrame:
    return _fact(t)


@_query("sales_fact_inner")
def sales_fact_inner(t: BoundTables) -> DataFrame:
    """Lines of finished orders: the others' orders are missing from the orders joined."""
    finished = t.read("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_id"))
    return _fact(t, "inner", t.silver_orders().join(finished, "order_id", "left_semi"))


def sales_monthly(t: BoundTables) -> DataFrame:
    return sales.sales_monthly(_order_sales(t))


def sales_by_category(t: BoundTables) -> DataFrame:
    return sales.sales_by_category(_product_sales(t))


def sales_by_region(t: BoundTables) -> DataFrame:
    return sales.sales_by_region(_order_sales(t, region=True))


def top_products(t: BoundTables) -> DataFrame:
    return sales.top_products(fact.product_sums(t.order_lines()), products=t.sold_products())


@_query("sales_monthly")
def ordered_monthly(t: BoundTables) -> DataFrame:
    return ordered("sales_monthly", sales_monthly(t))


@_query("sales_by_category")
def ordered_by_category(t: BoundTables) -> DataFrame:
    return ordered("sales_by_category", sales_by_category(t))


@_query("sales_by_region")
def ordered_by_region(t: BoundTables) -> DataFrame:
    return ordered("sales_by_region", sales_by_region(t))


@_query("top_products")
def ordered_top_products(t: BoundTables) -> DataFrame:
    return ordered("top_products", top_products(t))


# Churn


@_query("customer_rfm")
def customer_rfm(t: BoundTables) -> DataFrame:
    return churn.customer_rfm(_order_sales(t, region=True), t.silver_customers())


@_query("customer_churn")
def customer_churn(t: BoundTables) -> DataFrame:
    return _churn(t)


@_query("churn_threshold_90")
def churn_threshold_90(t: BoundTables) -> DataFrame:
    return _churn(t, churn_days=90)


@_query("churn_summary")
def churn_summary(t: BoundTables) -> DataFrame:
    return ordered("churn_summary", churn.churn_summary(_churn(t)))


@_query("customer_activity_export")
def customer_activity_export(t: BoundTables) -> DataFrame:
    return churn.customer_activity_export(t.silver_customers(), t.dated_orders(), t.reference_day())


# Headline figures and report views


@_query("kpi_sales")
def kpi_sales(t: BoundTables) -> DataFrame:
    return kpis.kpi_sales(sales_monthly(t))


@_query("kpi_churn")
def kpi_churn(t: BoundTables) -> DataFrame:
    return kpis.kpi_churn(_churn(t))


@_query("sales_mom")
def sales_mom(t: BoundTables) -> DataFrame:
    return kpis.sales_mom(sales_monthly(t))


@_query("sales_latest_month")
def sales_latest_month(t: BoundTables) -> DataFrame:
    return kpis.latest_month(sales_monthly(t))


@_query("month_label")
def month_label(t: BoundTables) -> DataFrame:
    return kpis.month_label(sales_monthly(t))


@_query("category_share_of_max")
def category_share_of_max(t: BoundTables) -> DataFrame:
    return kpis.share_of_max(sales_by_category(t), "total_revenue")


@_query("region_share_of_max")
def region_share_of_max(t: BoundTables) -> DataFrame:
    return kpis.share_of_max(sales_by_region(t), "total_revenue")


@_query("product_share_of_max")
def product_share_of_max(t: BoundTables) -> DataFrame:
    return kpis.share_of_max(top_products(t), "total_revenue")


@_query("month_share_of_max")
def month_share_of_max(t: BoundTables) -> DataFrame:
    return kpis.fraction_of_max(sales_monthly(t), "total_revenue")


@_query("churn_share_of_max")
def churn_share_of_max(t: BoundTables) -> DataFrame:
    return kpis.share_of_max(churn.churn_summary(_churn(t)), "churn_rate_pct")


@_query("top_products_ranked")
def top_products_ranked(t: BoundTables) -> DataFrame:
    return kpis.ranked(top_products(t))


@_query("roster_at_risk")
def roster_at_risk(t: BoundTables) -> DataFrame:
    return kpis.customer_roster(_churn(t), segment="At Risk")


# Sinks and audits


@_query("export_csv")
def exported_churn(t: BoundTables) -> DataFrame:
    """The churn mart written as CSV and read back."""
    mart = _churn(t)
    path = scratch_path(t.spark, "churn")
    export_csv(mart, path)
    return read_csv(t.spark, path, mart.schema)


@_query("export_json")
def exported_feed(t: BoundTables) -> DataFrame:
    """The six marts written as a feed and read back: every column of every mart, as JSON text."""
    marts = _marts(t)
    path = scratch_path(t.spark, "feed")
    export_json({name: ordered(name, mart) for name, mart in marts.items()}, path)
    read_back = []
    for name, mart in marts.items():
        back = published(read_json_records(t.spark, f"{path}/{name}", mart.schema, multi_line=False))
        read_back.append(_fields(name, back))
    return reduce(DataFrame.unionByName, read_back)


def _fields(name: str, mart: DataFrame) -> DataFrame:
    """Every field of a mart as a row: mart, row_key, field, value; fractions in hundredths."""
    fields = [
        F.struct(
            F.lit(column).alias("field"),
            (F.round(F.col(column) * 100).cast("decimal(30,0)") if kind == "double" else F.col(column))
            .cast("string").alias("value"),
        )
        for column, kind in mart.dtypes
    ]
    key = F.col(_KEYS[name]).cast("string").alias("row_key")
    return mart.select(F.lit(name).alias("mart"), key, F.inline(F.array(*fields)))


_KEYS = {
    "sales_monthly": "year_month",
    "sales_by_category": "category_name",
    "sales_by_region": "region",
    "top_products": "product_id",
    "customer_churn": "customer_id",
    "churn_summary": "region",
}


@_query("layer_row_counts")
def layer_row_counts(t: BoundTables) -> DataFrame:
    """Rows of the ten raw, six conformed and seven mart tables of a stored run, from file footers.

    The run is stored once per application and input; tables that are whole are not written again.
    """
    files = sorted(map(str, listed_files(t.spark, f"{t.sf_dir}/*.parquet").collect()))
    name = hashlib.sha256("".join(files).encode()).hexdigest()[:16]
    cfg = _run_config(t, scratch_path(t.spark, "").rpartition("/")[0] + f"/run-{name}", name, run_id=name)
    run_pipeline(t.spark, cfg, _database(t), _object_store(t))
    return audit.stored_row_counts(t.spark, stored_tables(t.spark, cfg))


# Stored tables and the run


@contextmanager
def _schema(t: BoundTables) -> Iterator[str]:
    """A schema of its own, its tables in the scratch folder, that is dropped afterwards."""
    path = scratch_path(t.spark, "tables")
    name = f"q_{path.rpartition('-')[2]}"
    ensure_schema(t.spark, name, path)
    try:
        yield name
    finally:
        drop_schema(t.spark, name)


def _rows_of(t: BoundTables, table: str) -> DataFrame:
    """The rows of a table's present version, which stay when its name is dropped."""
    return t.spark.read.schema(t.spark.table(table).schema).parquet(table_location(t.spark, table))


@_query("gzip_scan")
def gzip_scan(t: BoundTables) -> DataFrame:
    """Suppliers from compressed CSV files."""
    path = scratch_path(t.spark, "suppliers")
    rows = t.suppliers().select("SupplierID", "CompanyName", "Country")
    rows.write.option("header", True).option("compression", "gzip").csv(path)
    return read_csv(t.spark, path, "SupplierID BIGINT, CompanyName STRING, Country STRING")


@_query("replaced_table")
def replaced_table(t: BoundTables) -> DataFrame:
    """A table written twice under one name, with the number of rows counted while writing."""
    with _schema(t) as schema:
        table = f"{schema}.people"
        replace_table(t.silver_employees(), table)
        written = replace_table(t.silver_customers(), table)
        return _rows_of(t, table).withColumn("rows_written", F.lit(written).cast("bigint"))


_SUPPLIER_NAMES = {"SupplierID": "supplier_id", "CompanyName": "supplier_name", "Country": "supplier_country"}


@_query("appended_load")
def appended_load(t: BoundTables) -> DataFrame:
    """Suppliers loaded in two parts, renamed and with lineage; the time of landing left out."""
    even = F.col("SupplierID") % 2 == 0
    with _schema(t) as schema:
        table = f"{schema}.suppliers"
        load_table(t.suppliers().where(even), table, _SUPPLIER_NAMES, source_system="first")
        load_table(t.suppliers().where(~even), table, _SUPPLIER_NAMES, mode="append", source_system="second")
        return _rows_of(t, table).drop("_ingest_ts")


@_query("ledger_load")
def ledger_load(t: BoundTables) -> DataFrame:
    """Suppliers loaded from a folder three times: at first, again, and when files were added.

    Rows carry the number of rows that the second and the third load added.
    """
    path = scratch_path(t.spark, "landing")
    even = F.col("SupplierID") % 2 == 0
    columns = "SupplierID BIGINT, CompanyName STRING, Country STRING"

    def read(files: list[str]) -> DataFrame:
        return read_csv(t.spark, files, columns)

    def land(rows: DataFrame) -> None:
        rows.write.mode("append").option("header", True).csv(path)

    with _schema(t) as schema:
        table = f"{schema}.suppliers"

        def load() -> int:
            return load_new_files(t.spark, f"{path}/*.csv", table, read, "object_store", _SUPPLIER_NAMES)

        land(t.suppliers().where(even))
        load()
        again = load()
        land(t.suppliers().where(~even))
        added = load()
        names = list(_SUPPLIER_NAMES.values())
        folder = version_folder(t.spark, table)
        rows = t.spark.read.schema(t.spark.table(table).select(*names, "_source_system").schema).parquet(folder).drop("_load_id")
    return rows.withColumns({"rows_again": F.lit(again).cast("bigint"), "rows_added": F.lit(added).cast("bigint")})


@_query("rejected_records")
def rejected_records(t: BoundTables) -> DataFrame:
    """Customers from CSV lines some of which do not parse: what is loaded, and what is rejected."""
    key = F.col("c_custkey")
    line = (
        F.when(key % 7 == 0, F.concat(F.lit("no."), key, F.lit(","), F.col("c_name")))
        .when(key % 11 == 0, F.concat(key, F.lit(","), F.col("c_name"), F.lit(",too,many")))
        .otherwise(F.concat(key, F.lit(","), F.col("c_name")))
    )
    path = scratch_path(t.spark, "lines")
    t.read("customer").select(line.alias("value")).write.text(path)
    with _schema(t) as schema:
        load_checked(
            t.spark, path, f"{schema}.customers", "customer_id BIGINT, company_name STRING", f"{schema}.rejects",
            limit=1 << 62, header=False,
        )
        good = _rows_of(t, f"{schema}.customers").withColumn("record", F.lit(None).cast("string"))
        bad = _rows_of(t, f"{schema}.rejects")
        nothing = {"customer_id": F.lit(None).cast("bigint"), "company_name": F.lit(None).cast("string")}
        return good.unionByName(bad.withColumns(nothing).select("customer_id", "company_name", "record"))


def _raw_products(t: BoundTables) -> DataFrame:
    """Products as variants, from JSON files of an array of records per line."""
    path = scratch_path(t.spark, "raw")
    record = F.struct("ProductID", "ProductName", "CategoryID", "SupplierID", "UnitPrice")
    t.products().select(F.to_json(F.array(record)).alias("value")).write.text(path)
    return read_raw_json(t.spark, path, whole_files=False)


@_query("raw_json_view")
def raw_json_view(t: BoundTables) -> DataFrame:
    """Raw records stored as variants with lineage, read through a view of the catalogue that
    types their fields; the time of landing left out."""
    with _schema(t) as schema:
        table, view = f"{schema}.products_raw", f"{schema}.products"
        load_table(_raw_products(t), table, source_system="object_store")
        publish_json_view(t.spark, view, table, "raw_json", JSON_FIELDS["products"], ["_ingest_ts", "_source_system"])
        return t.spark.table(view).drop("_ingest_ts")


def _run_config(t: BoundTables, path: str, tag: str, **more) -> PipelineConfig:
    return PipelineConfig(
        bronze_schema=f"bronze_{tag}", silver_schema=f"silver_{tag}", gold_schema=f"gold_{tag}",
        location=path, ref_date=t.reference_date(), **more,
    )


def _database(t: BoundTables) -> dict[str, Source]:
    return {
        "customers": t.customers, "employees": t.employees, "shippers": t.shippers, "orders": t.orders,
        "orderdetails": t.order_details,
    }


def _object_store(t: BoundTables) -> dict[str, Source]:
    return {
        "categories": t.categories, "suppliers": t.suppliers, "products": lambda: _raw_products(t),
        "region_lookup": t.region_lookup, "customer_activity_export": t.activity_export,
    }


def _extremes(df: DataFrame) -> DataFrame:
    """Per column of ``df``: rows, nulls, least and greatest value, as text.

    Decimals become hundredths after they are compared: rounding keeps their order, and is then
    done once instead of twice a row.
    """
    figures = []
    for f in df.schema.fields:
        exact = lambda c, kind=f.dataType: F.round(c * 100).cast("decimal(30,0)") if isinstance(kind, T.DecimalType) else c
        column, rows = F.col(f.name), F.count(F.lit(1))
        values = {
            "rows": rows, "nulls": rows - F.count(column), "least": exact(F.min(column)), "greatest": exact(F.max(column)),
        }
        figures += [(f.name, field, c.cast("string").alias(f"{f.name}.{field}")) for field, c in values.items()]
    sums = df.agg(*[c for *_, c in figures])
    rows = [
        F.struct(F.lit(key).alias("row_key"), F.lit(field).alias("field"), F.col(f"`{key}.{field}`").alias("value"))
        for key, field, _ in figures
    ]
    return sums.select(F.inline(F.array(*rows)))


@_query("gold_run")
def gold_run(t: BoundTables) -> DataFrame:
    """The whole run with its exports over the bound tables. All seven marts are read back: six
    field by field, of the fact every column's extremes, read from its export."""
    path = scratch_path(t.spark, "run")
    cfg = _run_config(t, path, path.rpartition("-")[2], export_path=f"{path}/exports")
    run_pipeline(t.spark, cfg, _database(t), _object_store(t))
    marts = {name: _rows_of(t, cfg.table("gold", name)) for name in EXPORTED}
    for layer in ("bronze", "silver", "gold"):
        drop_schema(t.spark, cfg.schema(layer))
    lines = read_csv(t.spark, f"{cfg.export_path}/csv/gold_sales_fact", marts.pop("sales_fact").schema)
    feed = reduce(DataFrame.unionByName, [_fields(name, published(mart)) for name, mart in marts.items()])
    return feed.unionByName(_extremes(lines).withColumn("mart", F.lit("sales_fact")))
