"""Row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Parquet read by the scan that answers a count from the files' footers.
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def layer_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, counted in one job."""
    # Summed up, because the pushed-down count of a folder without rows is null, not 0.
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count")
    counts = [
        df.agg(F.count("*").alias("n")).agg(total).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def stored_row_counts(spark: SparkSession, locations: dict[str, str]) -> DataFrame:
    """The same of Parquet folders, from their footers: no row group is read.

    The counts belong to a session of their own, whose settings choose the scan. No column is
    read, so it does not matter which one is declared.
    """
    counting = spark.newSession()
    for key, value in FOOTERS.items():
        counting.conf.set(key, value)
    return layer_row_counts({name: counting.read.schema("any INT").parquet(path) for name, path in locations.items()})
