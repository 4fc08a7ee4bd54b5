from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from odd_documents import clashing, nothing, odd, odd_rows, table  # noqa: F401

from salesmarts.llm import exact_dedup


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[normal(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), digest) for i in ids]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("fan_in", [2, 16])
def test_groups_as_by_brute_force(odd, fan_in):
    found = exact_dedup.exact_duplicates(odd, fan_in=fan_in)
    assert table(found, "doc_id", "keep_id", "group_size", "text_sha256") == expected(odd_rows())


def test_one_row_of_each_group_is_kept(odd):
    rows = exact_dedup.exact_duplicates(odd).collect()
    kept = defaultdict(list)
    for r in rows:
        if r.kept:
            kept[r.text_sha256].append(r.doc_id)
    assert all(len(ids) == 1 for ids in kept.values()) and len(kept) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_clashing_columns_and_rows_without_copies(clashing):
    kept = exact_dedup.without_exact_duplicates(clashing)
    assert kept.columns == clashing.columns and kept.dtypes == clashing.dtypes
    assert kept.count() == len({normal(t) for _, t, *_ in odd_rows()})
    assert exact_dedup.exact_duplicates(clashing).count() == len(odd_rows())


def test_empty_table(nothing):
    assert exact_dedup.exact_duplicates(nothing).collect() == []
    assert exact_dedup.without_exact_duplicates(nothing).collect() == []


def test_a_group_of_a_third_of_all_rows(spark):
    n = 3000
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(40)
    found = exact_dedup.exact_duplicates(df, fan_in=4)
    assert found.where("kept").count() == 2 * n // 3 + 1
    assert {r.keep_id for r in found.where(f"group_size = {n // 3}").collect()} == {0}


def test_no_python_in_the_plan(odd):
    plan = exact_dedup.exact_duplicates(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
