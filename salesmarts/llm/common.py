"""What several operators share: written tables, text blocks for Arrow functions, memos, samples."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmarts.session import scratch_path

#: Bytes of text that an Arrow function takes at a time, so that its lists of words stay small.
BLOCK_BYTES = 2 << 20
#: Entries of a memo of words; beyond, it starts afresh after the block.
MEMO_WORDS = 400_000


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later jobs read it again if an executor is lost, instead of computing it again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(df: DataFrame, name: str) -> Column:
    """A column by its plain name, also where that holds dots."""
    return df["`" + name.replace("`", "``") + "`"]


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def texts_of(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only id and text, under fixed names, so that other columns can have any name."""
    return docs.select(
        column(docs, id_col).cast("bigint").alias("doc_id"),
        column(docs, text_col).cast("string").alias("text"),
        *more,
    )


def blocks(
    batches: Iterator[pa.RecordBatch], text_at: int = 1, size: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``size`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def strings(column: pa.Array) -> list[str]:
    """Texts of a column; null counts as empty."""
    return pc.fill_null(column, "").to_pylist()


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of a column as UTF-8; null counts as empty."""
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def importable(df: DataFrame) -> DataFrame:
    """``df``, whose session's Python workers can from now on import this package.

    They look where the driver has it, whatever folder the job was started in. Where executors
    do not see that folder, the package is installed or sent along (``--py-files``) as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df


def per_text(docs: DataFrame, scored: Callable[[pa.RecordBatch], list], schema: str) -> DataFrame:
    """``docs`` (doc_id, text, ...) with, per row, what ``scored`` gives for a block of rows.

    ``scored`` returns the output columns in the order of ``schema``.
    """
    types = docs.sparkSession.createDataFrame([], schema).schema
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in types])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            columns = [
                x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                for f, x in zip(arrow, scored(block), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return importable(docs).mapInArrow(run, schema)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
}


class Memo(dict):
    """Word to value, computed when first asked for."""

    def __init__(self, compute: Callable):
        super().__init__()
        self.compute = compute

    def __missing__(self, word):
        value = self[word] = self.compute(word)
        return value

    def trim(self) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(parts)) == part


def sampled(rows: DataFrame, label: str, rows_per_label: int) -> DataFrame:
    """About ``rows_per_label`` rows of each value of ``label``, chosen by a hash of doc_id.

    The fraction of each label follows from its count, so the sample neither depends on the
    partitioning nor grows with the input. Rows without a label are passed over.
    """
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).collect()
    at = F.pmod(F.xxhash64("doc_id", F.lit(77)), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.lit(False)
    for r in counts:
        wanted = wanted | ((F.col(label) == F.lit(r[label])) & (at < min(1.0, rows_per_label / r["n"])))
    return rows.where(wanted)


#: Rows of one id in a sample at most: ids are drawn, and one of them may hold many rows.
ROWS_PER_ID = 4


def collected(sample: DataFrame, label: str) -> list[tuple[bytes, object]]:
    """Text and label of a bounded sample, equal rows once, in an order of their own.

    Of an id that many rows share, ``ROWS_PER_ID`` are taken, by a hash of their texts.
    """
    rows = sample.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col(label).alias("label"))
    own = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "label")
    rows = rows.dropDuplicates().withColumn("place", F.row_number().over(own))
    taken = rows.where(F.col("place") <= ROWS_PER_ID).drop("place").collect()
    unique = {(r["doc_id"] is None, r["doc_id"] or 0, r["text"], r["label"]) for r in taken}
    return [(text.encode(), value) for _, _, text, value in sorted(unique)]


def marked_sample(
    docs: DataFrame, labels: DataFrame, mark: str, held: Column, rows_per_label: int
) -> list[tuple[bytes, int]]:
    """A bounded sample of ``docs`` whose ``mark`` (0 or 1) in ``labels`` may be learnt from."""
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(mark).cast("int").alias("mark"))
    marks = marks.where("mark IN (0, 1)").where(~held).groupBy("doc_id").agg(F.max("mark").alias("mark"))
    few = sampled(marks, "mark", rows_per_label)
    return collected(docs.join(F.broadcast(few), "doc_id"), "mark")
