"""The run: land raw tables, conform them, build the fact and the marts, export.

Every step reads tables the step before has stored, so no plan is run twice: the marts
scan the stored fact, the summary the stored churn table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmarts.functions.dates import month_start, year_month
from salesmarts.operators import churn, conform, fact, sales
from salesmarts.operators.ordering import ordered
from salesmarts.plans.config import PipelineConfig
from salesmarts.session import path_exists, scratch
from salesmarts.sinks.exports import export_csv, export_json, export_json_document
from salesmarts.sinks.tables import (
    described,
    ensure_schema,
    noted,
    publish_json_view,
    replace_table,
    rows_if_made_from,
    table_location,
    version_of,
)
from salesmarts.sources.database import read_database_table
from salesmarts.sources.files import read_csv, read_json_object, read_json_records, read_raw_json
from salesmarts.sources.lineage import with_lineage
from salesmarts.sources.loads import listed_files
from salesmarts.sources.schemas import CSV_FILES, DATABASE_TABLES, JSON_FIELDS, JSON_RECORDS

# Table names of the feed and the export; fixed by the readers of those files.
EXPORTED = (
    "sales_fact", "sales_monthly", "sales_by_category", "sales_by_region", "top_products",
    "customer_churn", "churn_summary",
)
FEED = EXPORTED[1:]

# Rules by which values of the conformed tables are converted.
RULES = {
    "customers": conform.CUSTOMERS,
    "employees": conform.EMPLOYEES,
    "orders": conform.ORDERS,
    "products": conform.PRODUCTS,
    "order_details": conform.ORDER_DETAILS,
    "customer_activity": conform.ACTIVITY,
}


def read_database(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    return {
        name: read_database_table(
            spark, cfg.database_url, name, cfg.split(name), cfg.database_properties, schema,
        )
        for name, schema in DATABASE_TABLES.items()
    }


def _files(cfg: PipelineConfig) -> dict[str, str]:
    """Path of each table's file in the object store."""
    usual = {name: f"{name}.csv" for name in CSV_FILES} | {name: f"{name}.json" for name in JSON_RECORDS}
    usual["region_lookup"] = "order_region_lookup.json"
    return {n: f"{cfg.object_store_path}/{cfg.file_names.get(n, file)}" for n, file in usual.items()}


def read_object_store(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    """The files' tables with their declared columns."""
    path = _files(cfg)
    tables = {name: read_csv(spark, path[name], schema) for name, schema in CSV_FILES.items()}
    for name, schema in JSON_RECORDS.items():
        tables[name] = read_json_records(spark, path[name], schema, multi_line=not cfg.json_lines)
    tables["region_lookup"] = read_json_object(spark, path["region_lookup"], "Country", "Region")
    return tables


def read_raw_object_store(spark: SparkSession, cfg: PipelineConfig) -> dict[str, DataFrame]:
    """The same, but JSON records as one variant each: they are kept whole, whatever they hold."""
    path = _files(cfg)
    raw = {name: read_raw_json(spark, path[name], whole_files=not cfg.json_lines) for name in JSON_FIELDS}
    return read_object_store(spark, cfg) | raw


class Store:
    """Writes a run's tables, and passes over those that a run of the same name has written whole.

    A table is made from what its step is told, and from the versions of the tables it reads. A
    database or frames handed in are known by the run's name only.
    """

    def __init__(self, spark: SparkSession, cfg: PipelineConfig):
        self.spark, self.cfg = spark, cfg
        self.counts: dict[str, int] = {}
        self.tables: dict[str, dict[str, str]] = {}
        self.written: set[str] = set()

    def described(self, table: str) -> dict[str, str]:
        if table not in self.tables:
            self.tables[table] = described(self.spark, table)
        return self.tables[table]

    def inputs(self, target: str, reads: Sequence[str], told: Sequence[object]) -> str | None:
        if self.cfg.run_id is None:
            return None
        made_from = [self.cfg.run_id, target, [version_of(self.described(t)) for t in reads], *told]
        return hashlib.sha256(json.dumps(made_from, default=str).encode()).hexdigest()

    def whole(self, target: str, inputs: str | None) -> bool:
        rows = None if inputs is None else rows_if_made_from(self.spark, self.described(target), inputs)
        if rows is not None:
            self.counts[target] = rows
        return rows is not None

    def put(
        self, target: str, build: Callable[[], DataFrame], reads: Sequence[str] = (), told: Sequence[object] = (),
        partition_by: tuple[str, ...] = (), notes: Observation | None = None,
    ) -> None:
        inputs = self.inputs(target, reads, [*told, partition_by])
        if not self.whole(target, inputs):
            self.counts[target] = replace_table(build(), target, self.cfg.table_format, partition_by, inputs, notes)
            self.tables.pop(target, None)
            self.written.add(target)


#: A raw table, or what opens it when it has to be written.
Source = DataFrame | Callable[[], DataFrame]


def _raw_table(cfg: PipelineConfig, name: str) -> str:
    return cfg.table("bronze", f"{name}_raw")


def land_bronze(store: Store, tables: dict[str, Source], source_system: str, from_files: bool = False) -> None:
    """Raw tables with their lineage. Variants are stored as they are, behind a view of their fields."""
    spark, cfg = store.spark, store.cfg
    ensure_schema(spark, cfg.schema("bronze"), cfg.schema_location("bronze"))
    paths = _files(cfg) if from_files else {}
    for name, source in tables.items():
        told = [source_system]
        if cfg.run_id is not None and name in paths:
            told += sorted(map(str, listed_files(spark, paths[name]).collect()))
        plain, raw = cfg.table("bronze", name), _raw_table(cfg, name)
        if any(store.whole(t, store.inputs(t, (), [*told, ()])) for t in ((raw, plain) if name in JSON_FIELDS else (plain,))):
            continue
        df = with_lineage(source() if callable(source) else source, source_system)
        variants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.VariantType)]
        store.put(raw if variants else plain, lambda df=df: df, told=told)
        if variants:
            keep = [c for c in df.columns if c != variants[0]]
            publish_json_view(spark, plain, raw, variants[0], JSON_FIELDS[name], keep)


def _stored_raw(store: Store, name: str) -> str:
    """The table that holds the raw rows of ``name``, behind its view or itself."""
    raw = _raw_table(store.cfg, name)
    return raw if name in JSON_FIELDS and store.described(raw) else store.cfg.table("bronze", name)


def build_silver(store: Store, rejected: dict[str, int] | None = None) -> None:
    """``rejected`` receives, per table and column, the values that could not be converted,
    where there are any."""
    spark, cfg = store.spark, store.cfg
    ensure_schema(spark, cfg.schema("silver"), cfg.schema_location("silver"))

    def raw(name: str, seen: Observation | None = None, table: str | None = None) -> DataFrame:
        df = spark.table(cfg.table("bronze", name))
        if seen is None:
            return df
        lost = conform.rejected(df, RULES[table])
        if table == "order_details":
            lost.append(conform.lost_revenue(df).alias("line_revenue"))
        return df.observe(seen, *lost)

    # Table: its main raw table, others it reads, and how it is made of them.
    steps = {
        "customers": ("customers", (), conform.silver_customers),
        "employees": ("employees", (), conform.silver_employees),
        "orders": ("orders", ("region_lookup",), conform.silver_orders),
        "products": ("products", ("categories", "suppliers"), conform.silver_products),
        "order_details": ("orderdetails", (), conform.silver_order_details),
        "customer_activity": ("customer_activity_export", (), conform.silver_customer_activity),
    }
    for name, (main, others, build) in steps.items():
        target, seen = cfg.table("silver", name), Observation()
        store.put(
            target, lambda: build(raw(main, seen, name), *map(raw, others)),
            reads=[_stored_raw(store, t) for t in (main, *others)], notes=seen,
        )
        if rejected is not None:
            kept = seen.get if target in store.written else noted(store.described(target))
            rejected.update({f"{name}.{column}": n for column, n in kept.items() if n})


def build_gold(store: Store) -> None:
    spark, cfg = store.spark, store.cfg
    ensure_schema(spark, cfg.schema("gold"), cfg.schema_location("gold"))

    def silver(name: str) -> DataFrame:
        return spark.table(cfg.table("silver", name))

    def put(name: str, build: Callable[[], DataFrame], reads: Sequence[str], *told: object, **options) -> None:
        store.put(cfg.table("gold", name), build, [cfg.table(*t.split(".")) for t in reads], told, **options)

    def gold(name: str) -> DataFrame:
        return spark.table(cfg.table("gold", name))

    def lines() -> DataFrame:
        found = fact.sales_fact(
            silver("order_details"), silver("orders"), silver("products"), silver("customers"),
            silver("employees"), cfg.fact_join,
        )
        if "year_month" in cfg.fact_partition_by:
            found = found.withColumn("year_month", year_month(month_start(F.col("order_date"))))
        # Rebalancing gathers each partition value for the writers and splits a hot one.
        return found.hint("rebalance", *cfg.fact_partition_by) if cfg.fact_partition_by else found

    sources = [f"silver.{n}" for n in ("order_details", "orders", "products", "customers", "employees")]
    put("sales_fact", lines, sources, cfg.fact_join, partition_by=cfg.fact_partition_by)

    # Three marts need the order sums and two the product sums: each is written once, if at all.
    with scratch(spark, "order-sums") as by_order, scratch(spark, "product-sums") as by_product:
        def orders() -> DataFrame:
            if not path_exists(spark, by_order):
                fact.order_sales_of(gold("sales_fact")).write.parquet(by_order)
            return spark.read.parquet(by_order)

        def products() -> DataFrame:
            if not path_exists(spark, by_product):
                fact.product_sales_of(gold("sales_fact")).write.parquet(by_product)
            return spark.read.parquet(by_product)

        def customers() -> DataFrame:
            rfm = churn.customer_rfm(orders(), silver("customers"))
            return churn.customer_churn(rfm, silver("customer_activity"), cfg.ref_date, cfg.churn_days, cfg.active_days)

        source = ["gold.sales_fact"]
        put("sales_monthly", lambda: sales.sales_monthly(orders()), source)
        put("sales_by_category", lambda: sales.sales_by_category(products()), source)
        put("sales_by_region", lambda: sales.sales_by_region(orders()), source)
        put("top_products", lambda: sales.top_products(products(), cfg.top_n), source, cfg.top_n)
        put(
            "customer_churn", customers, [*source, "silver.customers", "silver.customer_activity"],
            cfg.ref_date, cfg.churn_days, cfg.active_days,
        )
    put("churn_summary", lambda: churn.churn_summary(gold("customer_churn")), ["gold.customer_churn"])


def stored_tables(spark: SparkSession, cfg: PipelineConfig) -> dict[str, str]:
    """Folder of every stored table of the run by its name; a view's is that of the rows behind it."""
    names = [("bronze", n) for n in (*DATABASE_TABLES, *CSV_FILES, *JSON_RECORDS, "region_lookup")]
    names += [("silver", n) for n in RULES] + [("gold", n) for n in EXPORTED]
    found = {}
    for layer, name in names:
        place = table_location(spark, cfg.table(layer, name))
        found[f"{layer}_{name}"] = place or table_location(spark, _raw_table(cfg, name))
    return found


def export_gold(spark: SparkSession, cfg: PipelineConfig) -> None:
    gold = {name: ordered(name, spark.table(cfg.table("gold", name))) for name in EXPORTED}
    for name, df in gold.items():
        export_csv(df, f"{cfg.export_path}/csv/gold_{name}")
    feed = {f"gold_{n}": gold[n] for n in FEED}
    export_json(feed, f"{cfg.export_path}/feed")
    if cfg.feed_document:
        export_json_document(feed, f"{cfg.export_path}/feed_document")


def run_pipeline(
    spark: SparkSession,
    cfg: PipelineConfig,
    database: dict[str, Source] | None = None,
    object_store: dict[str, Source] | None = None,
    rejected: dict[str, int] | None = None,
) -> dict[str, int]:
    """Run all layers; returns the rows of each table.

    Raw frames, or functions that open them, may be passed in; otherwise they are read from the sources ``cfg`` names.
    ``rejected`` receives the numbers of raw values that could not be converted and are null
    in the conformed tables, by table and column. With ``cfg.run_id`` a run that failed, or is
    run again, goes on where something is missing or has changed.
    """
    from_files = not object_store
    store = Store(spark, cfg)
    land_bronze(store, database or read_database(spark, cfg), "db_source")
    land_bronze(store, object_store or read_raw_object_store(spark, cfg), "object_store", from_files)
    build_silver(store, rejected)
    build_gold(store)
    if cfg.export_path:
        export_gold(spark, cfg)
    return store.counts
