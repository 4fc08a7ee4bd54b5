"""File exports, written by the executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """A folder of CSV files with header. ``files`` merges the parts of a small mart.

    Spaces around a text, quotes and line breaks are kept; texts with line breaks need
    ``read_csv(multi_line=True)``. A text ``NULL`` or of blanks only is null when read again,
    by the dialect that ``read_csv`` follows. Part files follow the order of a sorted ``df``.
    """
    if files is not None:
        df = df.coalesce(files)
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.csv(path)


def export_json(marts: dict[str, DataFrame], path: str) -> None:
    """A feed folder with one JSON dataset per mart. Null fields are written out."""
    for name, mart in marts.items():
        mart.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")


def export_json_document(marts: dict[str, DataFrame], path: str) -> None:
    """All marts as one JSON document, an object with an array of records per mart.

    The executors write its lines as the part files of a text folder; put together in the order
    of their names they are the document. A sorted mart keeps its order. Rows of a mart differ
    from one another, as each has a key of its own.
    """
    spark = next(iter(marts.values())).sparkSession

    def line(text: str) -> DataFrame:
        return spark.range(0, 1, 1, 1).select(F.lit(text).alias("value"))

    parts, opening = [], "{"
    for name, mart in marts.items():
        parts.append(line(f'{opening}"{name}": ['))
        first = mart.first()
        if first is not None:
            record = F.struct(*[F.col(f"`{c}`") for c in mart.columns])
            same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.lit(v)) for c, v in first.asDict().items()])
            text = F.to_json(record, {"ignoreNullFields": "false"})
            parts.append(mart.select(F.concat(F.when(same, "").otherwise(","), text).alias("value")))
        opening = "], "
    parts.append(line("]}"))
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").text(path)
