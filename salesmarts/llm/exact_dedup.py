"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition writes one run: its rows' digests in order, with their ids. Runs are
then merged in rounds, ``fan_in`` at a time; each round keeps, per digest, the smallest row
and the number of rows, so a group of copies never sends more than one row per run onwards.
A digest is the SHA-256 of the normalised text together with its length and a second hash;
all three are compared at every level, so rows meet only if they agree in each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmarts.llm import common

DIGEST = ["digest", "length", "check"]
#: White space of which any stretch counts as one space.
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def _runs(docs: DataFrame, id_col: str, text_col: str, keep_rows: bool) -> DataFrame:
    """The written runs: digest, doc_id, row number and run, and with ``keep_rows`` the row."""
    text = F.coalesce(common.column(docs, text_col).cast("string"), F.lit(""))
    row = [F.struct(*[common.column(docs, c) for c in docs.columns]).alias("row")] if keep_rows else []
    rows = docs.select(
        common.column(docs, id_col).cast("bigint").alias("doc_id"),
        F.regexp_replace(text, WHITE_SPACE, " ").alias("normal"),
        F.monotonically_increasing_id().alias("row_no"),
        F.spark_partition_id().alias("run"),
        *row,
    )
    runs = rows.select(
        F.unhex(F.sha2("normal", 256)).alias("digest"),
        F.length("normal").alias("length"),
        F.xxhash64("normal").alias("check"),
        "doc_id", "row_no", "run", *(["row"] if keep_rows else []),
    )
    return common.written(runs if keep_rows else runs.sortWithinPartitions("digest"), "digest-runs")


def _merged(runs: DataFrame, fan_in: int) -> DataFrame:
    """Per digest the smallest row (doc_id, then row number; null ids last) and the row count."""
    last = runs.agg(F.max("run")).first()[0] or 0
    level = runs.select(
        *DIGEST, "run",
        F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no").alias("smallest"),
        F.lit(1).cast("bigint").alias("n"),
    )
    while True:
        # The first round also merges within each run, before anything is exchanged.
        last //= fan_in
        group = F.call_function("div", F.col("run"), F.lit(fan_in)).cast("int").alias("run")
        keys = [*DIGEST, group] if last else DIGEST
        level = level.groupBy(*keys).agg(F.min("smallest").alias("smallest"), F.sum("n").alias("n"))
        if not last:
            return level


def _decided(runs: DataFrame, fan_in: int, *more: str) -> DataFrame:
    """Runs with keep_id, group_size and kept. Rows without a copy need no partner."""
    # Written, so that the join deals out both sides itself and can split a hot digest's rows.
    copies = _merged(runs.select(*DIGEST, "run", "doc_id", "row_no"), fan_in).where(F.col("n") > 1)
    copies = common.written(copies, "copies")
    rows = runs.select(*DIGEST, "doc_id", "row_no", *more)
    single = F.col("n").isNull()
    return rows.join(copies, DIGEST, "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("smallest.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
        (single | (F.col("row_no") == F.col("smallest.row_no"))).alias("kept"),
        "digest", "row_no", *more,
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 16
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each stretch of white space is one space; null counts
    as empty. Of equal texts the row with the smallest id stays (null ids last); among equal
    rows with the same id exactly one is kept. An empty table gives no rows; other columns
    are not read.
    """
    runs = _runs(docs, id_col, text_col, keep_rows=False)
    return _decided(runs, fan_in).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def without_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 16
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns unchanged.

    Which row stays is as in ``exact_duplicates``. Only the numbers of dropped rows are joined.
    """
    runs = _runs(docs, id_col, text_col, keep_rows=True)
    dropped = _decided(runs.drop("row"), fan_in).where(~F.col("kept")).select("row_no")
    return runs.join(dropped, "row_no", "left_anti").select("row.*")
