"""The pipeline against a brute-force version of what its stages decide."""

from __future__ import annotations

import os
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_mixing import targets
from test_near_dedup import expected

import corpus_pipeline
from salesmarts.llm import common, quality
from salesmarts.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, and before the first."""
    docs = common.table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(common.written(stage(spark, out[-1], SF), "stage"))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.dtypes == stages[0].dtypes for df in stages[1:-1])
    assert stages[-1].columns == ["doc_id", "pieces", "n_pieces", "round_trip"]


def test_quality(spark, stages):
    scores = quality.quality_scores(stages[0], common.table(spark, SF, "labels")).where("predicted = 1")
    assert sorted(r.doc_id for r in scores.collect()) == sorted(r[0] for r in rows_of(stages[1]))


def test_exact_copies(stages):
    first = {}
    for row in sorted(rows_of(stages[1])):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", row[1]), row)
    assert sorted(first.values()) == sorted(rows_of(stages[2]))


def test_near_copies(stages):
    before = rows_of(stages[2])
    kept = {r[2] for r in expected(before)}
    assert sorted(rows_of(stages[3])) == sorted(r for r in before if r[0] in kept)


def test_mixture(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    assert set(after) <= set(before) and max(Counter(after).values()) <= 2
    words = {r[0]: len(re.findall("[^\x20\x09-\x0d]+", r[1])) for r in before}
    _, target = targets([(r[0], r[3], words[r[0]]) for r in before])
    got = Counter()
    for r in after:
        got[r[3]] += words[r[0]]
    largest = max(words.values())
    assert all(abs(got[s] - target[s]) <= 3 * largest for s in target)
    assert abs(sum(got.values()) / sum(target.values()) - 1) < 0.1


def test_pieces(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r[0], library.encode(r[1])) for r in rows_of(stages[4]))
    assert sorted((r.doc_id, r.pieces) for r in stages[5].collect()) == want
    assert stages[5].where("NOT round_trip").count() == 0


def test_run_is_its_stages(spark, stages):
    run = corpus_pipeline.run(spark, SF)
    digest = F.xxhash64("doc_id", "pieces")
    assert sorted(r[0] for r in run.select(digest).collect()) == sorted(r[0] for r in stages[5].select(digest).collect())


def test_one_query_per_operator_and_no_local_checkpoint():
    names = list(llm_queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(llm_oracles()) <= set(names)
    folder = os.path.dirname(os.path.abspath(common.__file__))
    code = "".join(open(os.path.join(folder, f)).read() for f in os.listdir(folder) if f.endswith(".py"))
    assert "localCheckpoint" not in code and "tempfile" not in code and "crossJoin" not in code


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_against_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = con.execute(llm_oracles()[name])
    names = [d[0] for d in result.description]
    found = llm_queries()[name](spark, SF).select(*names).collect()
    key = lambda r: [(v is None, v) for v in r]
    assert sorted(map(tuple, found), key=key) == sorted(result.fetchall(), key=key)


def test_python_workers_find_the_package_from_any_folder(spark):
    common.importable(spark.range(1))
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    assert root in spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep)
