"""CSV and JSON files from an object store. Compressed files are read by their suffix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmarts.functions.text import blank_to_null


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    delimiter: str = ",",
    header: bool = True,
    fail_fast: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Rows of CSV files.

    Empty, quoted-empty and ``NULL`` fields are null. A header must name the columns of
    ``schema``; without a schema the types are inferred, which reads the files twice.
    ``multi_line`` allows line breaks inside quotes but keeps a file in one task.
    """
    reader = (
        spark.read.option("header", header)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "NULL")
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
    )
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("enforceSchema", not header)
    df = reader.csv(path)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: blank_to_null(F.col(c)) for c in text})


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    multi_line: bool = True,
    fail_fast: bool = True,
) -> DataFrame:
    """Rows of JSON files that hold arrays of records.

    ``multi_line=False`` is for files with one record, or one array of records, per line:
    only those can be split among tasks.
    """
    reader = spark.read.option("multiLine", multi_line).option(
        "mode", "FAILFAST" if fail_fast else "PERMISSIVE"
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def json_object_rows(
    df: DataFrame, column: str, keep: Sequence[str] = (), key: str = "key", value: str = "value"
) -> DataFrame:
    """One row per field of the JSON object in ``column``, beside the ``keep`` columns."""
    fields = F.from_json(F.col(column), "map<string,string>", {"mode": "FAILFAST"})
    return df.select(*keep, F.explode(fields).alias(key, value))


def read_json_object(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """One row per field of a file that is a single JSON object, such as a lookup."""
    return json_object_rows(spark.read.text(path, wholetext=True), "value", key=key, value=value)


def json_fields(
    df: DataFrame, column: str, fields: dict[str, tuple[str, str]], keep: Sequence[str] = ()
) -> DataFrame:
    """Typed columns from paths into the JSON text or variant of ``column``: name to (path, type)."""
    if isinstance(df.schema[column].dataType, T.StringType):
        df = df.withColumn(column, F.parse_json(F.col(column)))
    return df.select(
        *keep,
        *[F.variant_get(column, path, kind).alias(name) for name, (path, kind) in fields.items()],
    )


def read_raw_json(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """JSON records, alone or in arrays, as one variant per record, for ``json_fields``.

    An array takes a file, which then should be no larger than one task can hold, or with
    ``whole_files=False`` a line, so that files are split among tasks.
    """
    value = F.col("value")
    records = F.when(
        F.ltrim(value).startswith("["), F.from_json(value, "array<variant>", {"mode": "FAILFAST"})
    ).otherwise(F.array(F.parse_json(value)))
    lines = spark.read.text(path, wholetext=whole_files).where(F.trim(value) != "")
    return lines.select(F.explode(records).alias("raw_json"))
