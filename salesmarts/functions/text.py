"""Text conforming. Trimming removes spaces only, as SQL ``trim`` does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(c: Column) -> Column:
    return F.trim(c)


def conform_key(c: Column) -> Column:
    return F.upper(F.trim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
