"""Language, quality and toxicity: held-out accuracy, and the awkward cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from odd_documents import clashing, nothing, odd, odd_rows  # noqa: F401

from salesmarts.llm import common, language, quality, toxicity
from salesmarts.llm.queries import llm_queries

SF = "/root/testdata/sf0.01"


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(40)] + [(3, None, None), (999, 1, 1)], "doc_id bigint, quality int, toxic int")


def test_languages_held_out(spark):
    truth = {r.doc_id: r.lang for r in common.table(spark, SF, "documents").select("doc_id", "lang").collect()}
    rows = llm_queries()["op7_language"](spark, SF).collect()
    assert len(rows) == len(truth) and all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out and truth[r.doc_id]]
    assert np.mean(held) > 0.98


def separation(rows, truth):
    """Part of pairs of held-out rows of either label that are in the right order."""
    one = [r.score for r in rows if r.held_out and truth.get(r.doc_id) == 1]
    zero = [r.score for r in rows if r.held_out and truth.get(r.doc_id) == 0]
    return float(np.mean([(a > b) + (a == b) / 2 for a in one for b in zero]))


@pytest.mark.parametrize("name, mark, threshold, least", [("op8_quality", "quality", 0.5, 0.97), ("op3_toxicity", "toxic", 0.7, 0.8)])
def test_scores_held_out(spark, name, mark, threshold, least):
    truth = {r.doc_id: r[mark] for r in common.table(spark, SF, "labels").collect()}
    rows = llm_queries()[name](spark, SF).collect()
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= threshold) for r in rows)
    assert separation(rows, truth) > least


def test_held_out_rows_and_other_columns_teach_nothing(spark, labels, odd):
    """Scores stay the same whatever the held-out labels, languages and sources say."""
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality",
        "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic",
    )
    other = odd.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source")
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        a = sorted(map(tuple, scores(odd, labels).collect()), key=str)
        assert a == sorted(map(tuple, scores(other, turned).collect()), key=str)


def test_awkward_rows(clashing, nothing, labels):
    n = len(odd_rows())
    assert quality.quality_scores(clashing, labels).count() == n
    assert toxicity.toxicity_scores(clashing, labels).count() == n
    found = language.languages_of(clashing).collect()
    assert len(found) == n
    assert {r.lang_pred for r in found if r.doc_id in (101, 102, 103)} == {"und"}
    for frame in (quality.quality_scores(nothing, labels), toxicity.toxicity_scores(nothing, labels), language.languages_of(nothing)):
        assert frame.collect() == []


def test_without_labels(odd, labels):
    none = labels.where("doc_id < 0")
    assert {r.score for r in quality.quality_scores(odd, none).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity_scores(odd, none).collect()} == {0.5}
    assert {r.lang_pred for r in language.languages_of(odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}
    one = labels.where("quality = 1")
    assert {round(r.score, 2) for r in quality.quality_scores(odd, one).collect()} == {0.98}


def test_quality_stage_keeps_columns_and_accepted_rows(clashing, odd, labels):
    scores = {r.doc_id: r.score for r in quality.quality_scores(odd, labels).collect() if r.doc_id is not None}
    kept = quality.of_quality(clashing, labels)
    assert kept.columns == clashing.columns
    ids = {r.doc_id for r in kept.collect() if r.doc_id is not None}
    assert ids == {i for i, s in scores.items() if s >= 0.5}


def test_false_positives_of_the_filters_are_taken_off():
    sample = [(("abcd " * 50).encode(), "x"), (("wxyz " * 50).encode(), "y")]
    filters = language.fit(sample)
    assert filters.languages == ["x", "y"]
    shares = filters.shares(["abcd abcd", "wxyz", "qqqq rrrr", ""])
    assert shares.argmax(axis=1)[:2].tolist() == [0, 1] and shares[2].max() == 0 and shares[3].max() == 0
    filters.false_rate[:] = 0.5
    assert filters.shares(["qqqq"]).max() == 0


def test_label_model_follows_good_voters_and_not_their_copies():
    rng = np.random.default_rng(0)
    y = rng.random(1500) < 0.3
    good = [np.where(y, rng.random(1500) < 0.8, rng.random(1500) < 0.05) for _ in range(4)]
    bad = np.where(y, rng.random(1500) < 0.4, rng.random(1500) < 0.3)
    votes = np.column_stack([*good, *[bad] * 8]).astype(bool)
    noisy = np.where(rng.random(1500) < 0.05, ~y, y).astype(float)
    posterior = toxicity.label_model(votes, noisy)
    assert ((posterior > 0.5) == y).mean() > 0.95
    parent = toxicity._tree(votes, noisy)
    assert all(p >= 4 for p in parent[5:])  # copies depend on one another


def test_shapes_and_words():
    assert quality.shape(b"HELLO!!") == b"XX!!" and quality.shape(b"abc12%%%") == b"xx99%%"
    assert quality.plain(b"Hello,") == b"hello"


def test_any_number_of_languages(spark):
    rnd = random.Random(6)
    names = [f"l{k:02d}" for k in range(70)]
    words = {n: ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)] for n in names}
    rows = [(i, " ".join(rnd.choices(words[names[i % 70]], k=20)), names[i % 70]) for i in range(70 * 12)]
    found = language.languages_of(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {i: lang for i, _, lang in rows}


def test_a_repeated_id_brings_few_rows_to_a_sample(spark):
    rows = [(7, f"text {k % 50}", "en") for k in range(3000)] + [(None, f"none {k}", "en") for k in range(100)] + [(k, "x", "de") for k in range(20, 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    taken = common.collected(df, "lang")
    assert len(taken) == 2 * common.ROWS_PER_ID + 40 and len(common.collected(df.where("doc_id = 7").limit(50), "lang")) <= 4
