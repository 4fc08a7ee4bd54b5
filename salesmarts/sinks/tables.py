"""Named tables and views.

A Parquet table of the session's own catalogue is a name for a folder that holds one version
of its rows. A new version is written beside the old one and becomes the table only when it is
whole; a write that fails leaves the old version as it was. What a version was made from is
kept with the table, so that a run can tell which tables it need not write again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmarts.session import delete, path_exists
from salesmarts.sources.lineage import with_lineage

#: Properties of a table: its version, the version's rows and what it was made from.
VERSION, ROWS, INPUTS, NOTES = (f"salesmarts.{k}" for k in ("version", "rows", "inputs", "notes"))


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create a schema that is not there yet, its tables under ``location`` if given."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")


def use_schema(spark: SparkSession, schema: str) -> None:
    ensure_schema(spark, schema)
    spark.sql(f"USE {schema}")


def drop_schema(spark: SparkSession, schema: str) -> None:
    """Drop a schema with its tables and views. Versions of tables stay where their folder is."""
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """Location, type, provider and own properties of a table or view; nothing if it is not there."""
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    found = {r["col_name"]: r["data_type"] for r in rows if r["col_name"] in ("Location", "Type", "Provider", "Table Properties")}
    return found | dict(re.findall(r"(salesmarts\.\w+)=([^,\]]*)", found.get("Table Properties", "")))


def table_location(spark: SparkSession, table: str) -> str | None:
    """The folder of a table's rows, null for a view."""
    return described(spark, table).get("Location")


def version_of(table: dict[str, str]) -> str:
    """Names the present rows of a table ``described``: another version, another name."""
    return table.get("Location", "").rstrip("/").rpartition("/")[2]


def rows_if_made_from(spark: SparkSession, table: dict[str, str], inputs: str) -> int | None:
    """The rows of a table ``described`` if its present version is whole and made from ``inputs``."""
    if table.get(INPUTS) != inputs or table.get(VERSION) != version_of(table):
        return None
    return int(table[ROWS]) if path_exists(spark, f"{table['Location']}/_SUCCESS") else None


def _versioned(spark: SparkSession, table: str, fmt: str) -> bool:
    return fmt == "parquet" and (table.count(".") < 2 or table.startswith("spark_catalog."))


def version_folder(spark: SparkSession, table: str) -> str:
    """Where the versions of a table are kept: beside, not within, its schema's own folder, which
    goes when the schema is dropped."""
    schema, _, name = table.rpartition(".")
    place = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}-versions/{name}"


def _counted(df: DataFrame, seen: Observation) -> DataFrame:
    return df.observe(seen, F.count(F.lit(1)).alias("rows"))


def column_list(df: DataFrame) -> str:
    """The columns of ``df`` as a table declares them."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _drop(spark: SparkSession, table: str) -> None:
    there = described(spark, table)
    if there:
        spark.sql(f"DROP {'VIEW' if there['Type'] == 'VIEW' else 'TABLE'} {table}")


def _show(spark: SparkSession, df: DataFrame, table: str, path: str, partition_by: Sequence[str]) -> None:
    """Let ``table`` name the rows below ``path``.

    In one step where the table has the same columns. Other columns need another table: it is
    made under another name, whole, and then takes the old one's place.
    """
    there = described(spark, table)
    if not partition_by and there.get("Type") != "VIEW" and there.get("Provider") == "parquet":
        if spark.table(table).dtypes == df.dtypes and not _partitions(spark, table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
    made = f"{table}__next"
    _drop(spark, made)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {made} ({column_list(df)}) USING parquet{parts} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(made)
    _drop(spark, table)
    spark.sql(f"ALTER TABLE {made} RENAME TO {table}")


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def noted(table: dict[str, str]) -> dict[str, int]:
    """The numbers observed while a table ``described`` was written."""
    pairs = (note.split(": ") for note in table.get(NOTES, "").split("; ") if note)
    return {name: int(n) for name, n in pairs}


def replace_table(
    df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = (), inputs: str | None = None,
    notes: Observation | None = None,
) -> int:
    """Create or replace ``table`` with the rows of ``df``; returns their number.

    The rows are counted while they are written, not by running the plan again. Until the new
    rows are whole the old ones stay, and ``df`` may read them. They are deleted afterwards;
    a table has one writer at a time. ``inputs`` names what the rows were made from and is kept
    with the table, as are the numbers that ``notes`` observe. Formats with transactions replace a table by
    themselves.
    """
    spark, seen = df.sparkSession, Observation()
    if not _versioned(spark, table, fmt):
        writer = _counted(df, seen).write.mode("overwrite").format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
        return seen.get["rows"]
    folder, version = version_folder(spark, table), uuid.uuid4().hex
    path = f"{folder}/{version}"
    try:
        writer = _counted(df, seen).write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        old = table_location(spark, table)
        _show(spark, df, table, path, partition_by)
    except BaseException:
        delete(spark, path)
        raise
    kept = {VERSION: version, ROWS: str(seen.get["rows"]), INPUTS: inputs or ""}
    kept[NOTES] = "; ".join(f"{name}: {n}" for name, n in notes.get.items()) if notes else ""
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in kept.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
    if old and old.rstrip("/") != path and "-versions/" in old:
        delete(spark, old)
    return seen.get["rows"]


def load_table(
    df: DataFrame,
    table: str,
    renames: dict[str, str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    source_system: str | None = None,
) -> int:
    """Load renamed rows into ``table``, with their lineage if ``source_system`` is given. ``mode="append"`` adds to what is there, so a
    repeated load would add its rows twice (``sources.loads`` keeps account of files); the default replaces them."""
    df = df.withColumnsRenamed(renames or {})
    if source_system is not None:
        df = with_lineage(df, source_system)
    spark = df.sparkSession
    if mode == "overwrite" or not spark.catalog.tableExists(table):
        return replace_table(df, table, fmt)
    seen = Observation()
    _counted(df, seen).write.mode(mode).format(fmt).saveAsTable(table)
    if _versioned(spark, table, fmt):
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{ROWS}', '{INPUTS}')")
    return seen.get["rows"]


def publish_view(df: DataFrame, name: str) -> None:
    """A view of this session over ``df``."""
    df.createOrReplaceTempView(name)


def publish_json_view(
    spark: SparkSession, view: str, table: str, column: str, fields: dict[str, tuple[str, str]], keep: Sequence[str] = ()
) -> None:
    """A permanent view of the catalogue with typed columns taken from a table's variant column.

    ``fields``: name to (path, type). ``keep`` names columns of the table that are passed on.
    """
    quote = lambda name: f"`{name.replace('`', '``')}`"
    columns = [f"variant_get({quote(column)}, '{path}', '{kind}') AS {quote(name)}" for name, (path, kind) in fields.items()]
    columns += [quote(c) for c in keep]
    if described(spark, view).get("Type", "VIEW") != "VIEW":
        _drop(spark, view)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(columns)} FROM {table}")
