"""Run parameters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from salesmarts.sources.database import TableSplit


@dataclass(frozen=True)
class PipelineConfig:
    database_url: str | None = None
    database_properties: dict[str, str] = field(default_factory=dict)
    database_splits: dict[str, TableSplit] = field(default_factory=dict)
    # How the order tables are read in parallel, by order id, where database_splits says nothing:
    # by ranges of so many rows, or, if it is given, by so many ranges of equal width.
    database_rows: int = 1_000_000
    database_partitions: int | None = None
    object_store_path: str | None = None
    # Names of input files other than <table>.csv and <table>.json, such as compressed ones.
    file_names: dict[str, str] = field(default_factory=dict)
    # JSON files that hold a record, or an array of records, per line can be split among tasks.
    json_lines: bool = False
    catalog: str | None = None
    bronze_schema: str = "retail_bronze"
    silver_schema: str = "retail_silver"
    gold_schema: str = "retail_gold"
    table_format: str = "parquet"
    # Where the schemas' tables are kept, if not in the warehouse.
    location: str | None = None
    # Columns of the fact, or year_month, which is added to it then.
    fact_partition_by: tuple[str, ...] = ()
    churn_days: int = 180
    active_days: int = 60
    ref_date: dt.date = dt.date(2025, 1, 1)
    top_n: int = 10
    fact_join: str = "left"
    export_path: str | None = None
    # Also export the feed as one JSON document of arrays.
    feed_document: bool = False
    # Names the run. A run of the same name writes only the tables that are not whole yet, or
    # made from something else. Without a name every table is written.
    run_id: str | None = None

    def schema(self, layer: str) -> str:
        name = getattr(self, f"{layer}_schema")
        return f"{self.catalog}.{name}" if self.catalog else name

    def split(self, table: str) -> TableSplit:
        """How a database table is read: as told, else by order id, else (lookups) at once."""
        if table in self.database_splits:
            return self.database_splits[table]
        if table in ("orders", "orderdetails"):
            if self.database_partitions is not None:
                return TableSplit("OrderID", self.database_partitions)
            return TableSplit("OrderID", rows=self.database_rows)
        return TableSplit()

    def schema_location(self, layer: str) -> str | None:
        return f"{self.location}/{layer}" if self.location else None

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.{layer}_{name}"
