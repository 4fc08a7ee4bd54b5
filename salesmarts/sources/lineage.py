"""Ingest lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_lineage(df: DataFrame, source_system: str) -> DataFrame:
    return df.withColumns(
        {"_ingest_ts": F.current_timestamp(), "_source_system": F.lit(source_system)}
    )
