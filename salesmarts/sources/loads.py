"""Loads of files that know what they have loaded, and of records that may not parse."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmarts.session import delete, scratch
from salesmarts.sinks.tables import column_list, load_table, version_folder
from salesmarts.sources.lineage import with_lineage

LOAD, FILE = "_load_id", "_source_file"
_LEDGER = f"{LOAD} STRING, path STRING, size BIGINT, changed TIMESTAMP, loaded_at TIMESTAMP"


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """path, size, changed of the files at ``path``, none of which is opened."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def ledger_of(table: str) -> str:
    return f"{table}_loads"


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """The ledger's rows of loads that are part of the table. Those of a load that failed are not."""
    parts = [r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    whole = spark.createDataFrame([(p,) for p in parts], f"{LOAD} string")
    return spark.table(ledger_of(table)).join(whole, LOAD, "left_semi")


def load_new_files(
    spark: SparkSession, path: str, table: str, read: Callable[[list[str]], DataFrame], source_system: str,
    renames: dict[str, str] | None = None,
) -> int:
    """Add the rows of those files at ``path`` that ``table`` does not hold yet; returns their number.

    ``read`` opens a list of files. A file is known by its path, size and time of change; one
    that changed is another file, and its rows are added to those of the former. Every load is
    a partition of the table. Its rows and its entries in the ledger (``ledger_of``) are written
    before the partition is added, and entries count only with their partition: a load that
    fails anywhere leaves the table as it was, and the next one takes the same files again.
    """
    found = listed_files(spark, path)
    known = spark.catalog.tableExists(table)
    if known:
        found = found.join(loaded_files(spark, table).select("path", "size", "changed"), ["path", "size", "changed"], "left_anti")
    # Spark lists the files that it is to read in the driver, too.
    new = found.collect()
    if not new:
        return 0
    rows = read([r["path"] for r in new]).select("*", F.col("_metadata.file_path").alias(FILE))
    rows = with_lineage(rows.withColumnsRenamed(renames or {}), source_system)
    load, seen = uuid.uuid4().hex, Observation()
    place = f"{version_folder(spark, table)}/{LOAD}={load}"
    try:
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(place)
        entries = spark.createDataFrame([(load, r["path"], r["size"], r["changed"]) for r in new], _LEDGER.rsplit(",", 1)[0])
        load_table(entries.withColumn("loaded_at", F.current_timestamp()), ledger_of(table), mode="append")
        if not known:
            spark.sql(
                f"CREATE TABLE {table} ({column_list(rows)}, {LOAD} STRING) USING parquet PARTITIONED BY ({LOAD})"
                f" LOCATION '{version_folder(spark, table)}'"
            )
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({LOAD} = '{load}') LOCATION '{place}'")
    except BaseException:
        delete(spark, place)
        raise
    return seen.get["rows"]


class TooManyRejects(ValueError):
    """More records than allowed do not parse. They are in the table of rejects."""


def load_checked(
    spark: SparkSession, path: str, table: str, schema: str, rejects: str, fmt: str = "csv", limit: int = 0,
    mode: str = "overwrite", **options: object,
) -> tuple[int, int]:
    """Load the records at ``path`` that parse by ``schema`` into ``table``; returns the numbers of
    rows loaded and of records rejected.

    Records that do not parse go to the table ``rejects`` as they are, with their file and where
    the part of it that a task read began. With more than ``limit`` of them the load fails and
    ``table`` stays as it was. Files are parsed once; both kinds are taken from what that wrote.
    """
    bad = "_record"
    reader = spark.read.format(fmt).options(**({"header": True, "escape": '"', "nullValue": "NULL"} if fmt == "csv" else {}))
    reader = reader.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
    declared = T.StructType.fromDDL(schema)
    rows = reader.schema(T.StructType([*declared.fields, T.StructField(bad, T.StringType())])).load(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("_file_start"))
    with scratch(spark, "checked") as place:
        seen = Observation()
        rows.observe(seen, F.count_if(F.col(bad).isNotNull()).alias("bad")).write.parquet(place)
        parsed = spark.read.schema(rows.schema).parquet(place)
        refused = seen.get["bad"]
        if refused:
            faults = parsed.where(F.col(bad).isNotNull())
            faults = faults.select(F.lit(table).alias("table_name"), FILE, "_file_start", F.col(bad).alias("record"), F.current_timestamp().alias("rejected_at"))
            load_table(faults, rejects, mode="append")
        if refused > limit:
            raise TooManyRejects(f"{refused} records for {table} do not parse, {limit} are allowed; they are in {rejects}")
        good = parsed.where(F.col(bad).isNull()).select(*[f"`{n}`" for n in declared.names])
        return load_table(good, table, mode=mode), refused

