"""The raw tables of the pipeline, taken from a TPC-H-like star schema.

How the columns correspond:

- customers: ``customer`` with its nation's name as country;
- orders: ``orders``; the ship country is the customer's; the order's employee is the
  lowest supplier number among its lines and it has shipped when its last line has;
- order lines: ``lineitem``; a line's unit price is its extended price over its quantity,
  to the cent;
- products: ``part``; its category is the brand, its supplier the lowest supplier number
  among its lines; employees and suppliers: ``supplier``;
- region lookup: ``nation`` and ``region``; shippers: the order priorities;
- activity export: the purchases in ``events``.

The table's keys (c_custkey, o_orderkey ...) are still deduplicated by the silver step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmarts.functions.numeric import to_cents
from salesmarts.operators import conform
from salesmarts.session import scratch_path

# The columns of the given tables, declared so that opening one runs no job.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}

BASIC_ORDER = ("order_id", "order_date", "customer_id")
PLACED_ORDER = (*BASIC_ORDER, "ship_country")


class BoundTables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._days: dict[tuple[str, str], dt.date | None] = {}

    def read(self, name: str) -> DataFrame:
        """A table's frame, opened once."""
        if name not in self._frames:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._frames[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    # Raw tables

    def _with_nation(self, table: str, key: str) -> DataFrame:
        nation = self.read("nation").select("n_nationkey", "n_name")
        return self.read(table).join(nation, F.col(key) == F.col("n_nationkey"), "left")

    def customers(self) -> DataFrame:
        return self._with_nation("customer", "c_nationkey").select(
            F.col("c_custkey").cast("string").alias("CustomerID"),
            F.col("c_name").alias("CompanyName"),
            F.col("c_mktsegment").alias("ContactName"),
            F.col("n_name").alias("Country"),
        )

    def employees(self) -> DataFrame:
        return self._with_nation("supplier", "s_nationkey").select(
            F.col("s_suppkey").alias("EmployeeID"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("FirstName"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("LastName"),
            F.col("n_name").alias("Title"),
        )

    def suppliers(self) -> DataFrame:
        return self._with_nation("supplier", "s_nationkey").select(
            F.col("s_suppkey").alias("SupplierID"),
            F.col("s_name").alias("CompanyName"),
            F.col("n_name").alias("Country"),
        )

    def shippers(self) -> DataFrame:
        """The order priorities, by which the orders are shipped."""
        priority = self.read("orders").select("o_orderpriority").distinct()
        return priority.select(
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("ShipperID"),
            F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("CompanyName"),
        )

    def orders(self, columns: tuple[str, ...] | None = None) -> DataFrame:
        """Raw orders. Without ``columns`` all; otherwise what the named ones need."""
        orders = self.read("orders")
        out = {
            "OrderID": F.col("o_orderkey"),
            "CustomerID": F.col("o_custkey").cast("string"),
            "OrderDate": F.col("o_orderdate").cast("date"),
        }
        if columns is None or "ship_country" in columns:
            customer = self.read("customer").select("c_custkey", "c_nationkey")
            nation = self.read("nation").select("n_nationkey", "n_name")
            orders = orders.join(
                customer, F.col("o_custkey") == F.col("c_custkey"), "left"
            ).join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            out["ShipCountry"] = F.col("n_name")
        if columns is None:
            shipment = (
                self.read("lineitem")
                .groupBy("l_orderkey")
                .agg(F.min("l_suppkey").alias("employee"), F.max("l_shipdate").alias("shipped"))
            )
            orders = orders.join(shipment, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            out["EmployeeID"] = F.col("employee")
            out["ShippedDate"] = F.col("shipped").cast("date")
            out["ShipVia"] = F.substring("o_orderpriority", 1, 1)
        return orders.select(*[c.alias(name) for name, c in out.items()])

    def order_details(self) -> DataFrame:
        quantity = F.col("l_quantity").cast("bigint")
        unit_cents = F.call_function(
            "div",
            to_cents(F.col("l_extendedprice")) * 2 + quantity,
            F.nullif(quantity * 2, F.lit(0)),
        )
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("OrderID"),
            F.col("l_partkey").alias("ProductID"),
            (unit_cents / 100).alias("UnitPrice"),
            quantity.alias("Quantity"),
            F.col("l_discount").alias("Discount"),
        )

    def products(self, supplier: bool = True) -> DataFrame:
        part = self.read("part")
        out = {
            "ProductID": F.col("p_partkey"),
            "ProductName": F.col("p_name"),
            "CategoryID": F.split_part("p_brand", F.lit("#"), F.lit(2)),
            "UnitPrice": F.col("p_retailprice"),
        }
        if supplier:
            source = (
                self.read("lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("source"))
            )
            part = part.join(source, F.col("p_partkey") == F.col("l_partkey"), "left")
            out["SupplierID"] = F.col("source")
        return part.select(*[c.alias(name) for name, c in out.items()])

    def categories(self) -> DataFrame:
        """The distinct brands, stored once.

        Catalyst would take their size to be that of ``part`` and, once that is large, shuffle
        the products by a key of a few values. Of the stored table it knows the size.
        """
        if "categories" not in self._frames:
            brands = self.read("part").select("p_brand").distinct().select(
                F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("CategoryID"),
                F.col("p_brand").alias("CategoryName"),
            )
            path = scratch_path(self.spark, "categories")
            brands.coalesce(1).write.parquet(path)
            self._frames["categories"] = self.spark.read.schema(brands.schema).parquet(path)
        return self._frames["categories"]

    def region_lookup(self) -> DataFrame:
        return (
            self.read("nation")
            .join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("Country"), F.col("r_name").alias("Region"))
        )

    def activity_export(self) -> DataFrame:
        purchases = self.read("events").where(F.col("event_type") == "purchase")
        day = F.col("ts").cast("date")
        return (
            purchases.groupBy("user_id")
            .agg(
                F.count("*").alias("TotalOrders"),
                F.min(day).alias("FirstOrderDate"),
                F.max(day).alias("LastOrderDate"),
            )
            .select(
                F.col("user_id").cast("string").alias("CustomerID"),
                "TotalOrders", "FirstOrderDate", "LastOrderDate",
                F.datediff(self._day_after("events", "ts"), F.col("LastOrderDate")).alias(
                    "DaysSinceLastOrder"
                ),
            )
        )

    def _day_after(self, table: str, column: str) -> Column:
        """That day as a literal: read once, however often a plan uses it."""
        if (table, column) not in self._days:
            last = self.read(table).select(F.date_add(F.max(F.col(column).cast("date")), 1))
            self._days[table, column] = last.first()[0]
        return F.lit(self._days[table, column]).cast("date")

    def reference_day(self) -> Column:
        """The day after the last order."""
        return self._day_after("orders", "o_orderdate")

    def reference_date(self) -> dt.date | None:
        self.reference_day()
        return self._days["orders", "o_orderdate"]

    # Silver tables

    def silver_customers(self) -> DataFrame:
        return conform.silver_customers(self.customers())

    def silver_employees(self) -> DataFrame:
        return conform.silver_employees(self.employees())

    def silver_orders(self) -> DataFrame:
        return conform.silver_orders(self.orders(), self.region_lookup())

    def dated_orders(self) -> DataFrame:
        """Orders with date and customer only."""
        return conform.silver_orders(self.orders(BASIC_ORDER), columns=BASIC_ORDER)

    def placed_orders(self) -> DataFrame:
        """Orders with date, customer, country and region."""
        return conform.silver_orders(
            self.orders(PLACED_ORDER), self.region_lookup(), columns=PLACED_ORDER
        )

    def silver_products(self) -> DataFrame:
        return conform.silver_products(self.products(), self.categories(), self.suppliers())

    def sold_products(self) -> DataFrame:
        """Products with name, price and category, without supplier."""
        columns = ("product_id", "product_name", "category_id", "unit_price")
        return conform.silver_products(
            self.products(supplier=False), self.categories(), columns=columns
        )

    def silver_order_details(self) -> DataFrame:
        return conform.silver_order_details(self.order_details())

    def order_lines(self) -> DataFrame:
        return conform.order_lines(self.order_details())

    def silver_customer_activity(self) -> DataFrame:
        return conform.silver_customer_activity(self.activity_export())
