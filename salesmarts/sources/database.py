"""Relational tables over JDBC, read in parallel by the executors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableSplit:
    """How one table is cut into parallel reads.

    By a numeric column, into ranges of about ``rows`` rows each, or into ``partitions`` ranges
    of equal width; or by disjoint conditions that together cover the table (for text keys, or
    where single values of the column are hot). Rows of one value are always read together.
    """

    column: str | None = None
    partitions: int = 1
    bounds: tuple[int, int] | None = None
    predicates: Sequence[str] = ()
    rows: int | None = None


def _bounds(spark: SparkSession, url: str, table: str, column: str, properties: dict) -> tuple[int, int]:
    query = f"SELECT min({column}) AS lo, max({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **properties).load().first()
    return (row[0] or 0, row[1] or 0)


def _even_ranges(spark: SparkSession, url: str, table: str, column: str, rows: int, properties: dict) -> list[str]:
    """Conditions for ranges of about ``rows`` rows, however the values are spread.

    One grouped query of the source: its rows are numbered by the column, and every ``rows``-th
    value is a bound. There is one row of it per range.
    """
    numbered = f"SELECT {column}, row_number() OVER (ORDER BY {column}) - 1 AS k FROM {table} WHERE {column} IS NOT NULL"
    query = f"SELECT max({column}) AS bound FROM ({numbered}) numbered GROUP BY k - k % {rows} ORDER BY 1"
    found = spark.read.format("jdbc").options(url=url, query=query, **properties).load().collect()
    bounds = sorted({r[0] for r in found})[:-1]
    if not bounds:
        return []
    first, last = f"{column} <= {bounds[0]} OR {column} IS NULL", f"{column} > {bounds[-1]}"
    return [first, *(f"{column} > {a} AND {column} <= {b}" for a, b in zip(bounds, bounds[1:])), last]


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    split: TableSplit = TableSplit(),
    properties: dict[str, str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """A whole table. Column pruning and filters reach the database.

    ``schema`` declares the types of the columns where the driver's own guess is not wanted.
    """
    properties = {"fetchsize": "10000", **(properties or {})}
    if schema:
        properties["customSchema"] = schema
    login = {k: v for k, v in properties.items() if k != "customSchema"}
    predicates = list(split.predicates)
    if split.column and split.rows:
        predicates = _even_ranges(spark, url, table, split.column, split.rows, login)
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    options = {"url": url, "dbtable": table, **properties}
    if split.column and split.partitions > 1:
        low, high = split.bounds or _bounds(spark, url, table, split.column, login)
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(low),
            "upperBound": str(high + 1),
            "numPartitions": str(split.partitions),
        }
    return spark.read.format("jdbc").options(**options).load()
