"""Documents with every awkward case, shared by the operators' tests."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names clash with those of results and of intermediate tables.
CLASHING = (
    "fingerprint", "kept", "score", "digest", "row", "row_no", "size", "bucket", "label", "mark", "held_out", "taken", "a.b", "_dropped", "dropped", "component_id",
)


def sentence(rnd: random.Random, words: int) -> str:
    return " ".join("".join(rnd.choices("abcdeilnorst", k=rnd.randint(2, 9))) for _ in range(words))


def odd_rows() -> list[tuple]:
    rnd = random.Random(5)
    rows = [(i, sentence(rnd, rnd.randint(1, 60)), "en" if i % 2 else "de", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100, rows[3][1] + "\t\n", "en", None, 2), (90, rows[3][1], None, "s1", 3)]  # copies
    rows += [(101, None, "en", "s0", None), (102, "", None, "s1", 0), (103, " \n ", "en", "s2", 3)]
    rows += [(None, "no id here", "en", "s0", 10), (None, None, None, None, None)]
    rows += [(104, "one", "en", "s0", 3), (104, "one", "en", "s0", 3)]  # a repeated row
    rows += [(105, sentence(rnd, 30000), "en", "s2", 1), (106, "x" * 50000, "en", "s2", 1)]
    rows += [(107, "straße été 日本 🙂 !!", "de", "é", 1), (108, "a" * 3 + "\x00b", "en", "s0", 5)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def clashing(odd):
    return odd.select("*", *[F.lit(k).alias(name) for k, name in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def table(df, *columns):
    """Rows as sorted tuples, nulls last."""
    out = [tuple(r[c] for c in columns) if columns else tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])
