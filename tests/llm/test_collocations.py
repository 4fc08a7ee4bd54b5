from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from odd_documents import clashing, nothing, odd, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from salesmarts.llm import collocations


def counts_of(rows):
    """Per language the occurrences of every sequence of one to five words."""
    found = defaultdict(Counter)
    for lang, text in rows:
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    found["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    return found


def expected(rows, least, percent, top):
    out = []
    for lang, f in counts_of(rows).items():
        n = sum(c for w, c in f.items() if len(w) == 1)
        phrases = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        covered = {
            w[i:j] for w, a in phrases.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1)
            if j - i < len(w) and 100 * a >= percent * f[w[i:j]]
        }
        scored = []
        for w, a in phrases.items():
            if w not in covered:
                score, k = min((1000 * a * n // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w)))
                scored.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def rows():
    """Few words, a hot one, repeated passages, a run of one word, signs below the space."""
    rnd = random.Random(8)
    words = ["the"] * 12 + ["of"] * 6 + [f"w{k}" for k in range(12)] + ["Étre", "A\x01", "a", "a\x00", "字"]
    passage = "one two three four five six seven, one two three four"
    out = []
    for k in range(120):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", ". ", "\n", "  "]) for _ in range(rnd.randint(0, 60)))
        out.append((rnd.choice(["en", "en", "de", None, "und", ""]), text + (passage if k % 3 == 0 else "")))
    return out + [("en", "x " * 400), ("en", None), ("de", "...."), ("xx", "rare words only")]


@pytest.mark.parametrize("parts, grams, ranked", [(1 << 20, 200_000, 100_000), (150, 20, 30)])
@pytest.mark.parametrize("least, percent, top", [(2, 100, 40), (4, 60, 2000)])
def test_by_brute_force(spark, monkeypatch, rows, parts, grams, ranked, least, percent, top):
    monkeypatch.setattr(collocations, "PART_WORDS", parts)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = found(collocations.collocations(docs, least, percent, top, part_grams=grams, ranked=ranked))
    assert got == expected(rows, least, percent, top) and len(got) > 60


def test_sequence_counts_are_whole_whatever_the_ranges(spark, monkeypatch, rows):
    monkeypatch.setattr(collocations, "PART_WORDS", 40)
    monkeypatch.setattr(collocations, "GATHERED", 300)
    monkeypatch.setattr(collocations, "HELD", 200)
    monkeypatch.setattr(collocations, "SENT", 7)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    grams, sizes = collocations.sequence_counts(texts, 3)
    want = counts_of(rows)
    assert sorted((r.lang, tuple(r.words), r.f) for r in grams.collect()) == sorted(
        (lang, w, n) for lang, f in want.items() for w, n in f.items() if n >= 3
    )
    assert {r.lang: r.n for r in sizes.collect()} == {
        lang: sum(n for w, n in f.items() if len(w) == 1) for lang, f in want.items() if f
    } | {lang: 0 for lang, f in want.items() if not f}


def test_exact_beyond_64_bits(spark):
    big = 3 * 10**12
    rows = [("en", ["a", "b"], big, big * 9, [big + 1], [big + 2])]
    df = spark.createDataFrame(rows, "lang string, words array<string>, a bigint, n bigint, left array<bigint>, right array<bigint>")
    assert collocations._scored(df).first().score == 1000 * big * big * 9 // ((big + 1) * (big + 2))


def test_long_texts_are_cut_at_stops_only(spark, monkeypatch):
    monkeypatch.setattr(collocations, "GATHERED", 64)
    rows = [("en", "alpha beta gamma delta epsilon, " * 40), ("en", "no stop in here " * 40)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert found(collocations.collocations(docs, 20)) == expected(rows, 20, 100, 2000)


def test_odd_documents(odd, clashing, nothing):
    want = expected([(r[2], r[1]) for r in odd_rows()], 2, 100, 50)
    assert found(collocations.collocations(odd, 2, top=50)) == want and want
    assert found(collocations.collocations(clashing, 2, top=50)) == want
    assert collocations.collocations(nothing).collect() == []


def test_windows_are_sent_of_long_sequences_only(spark, monkeypatch):
    """Pairs are frequent everywhere here; if each task sent them again, rows would be tasks times pairs."""
    sent, windows = [], collocations._sum_windows
    monkeypatch.setattr(collocations, "_sum_windows", lambda *a: sent.append(windows(*a)) or sent[-1])
    rnd = random.Random(3)
    rows = [("en", " ".join(f"w{rnd.randrange(20)}" for _ in range(200))) for _ in range(20)]
    rows += [("en", "one two three four five six")] * 10
    texts = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    grams, _ = collocations.sequence_counts(texts, 8)
    want = counts_of(rows)["en"]
    assert {tuple(r.words): r.f for r in grams.collect()} == {w: n for w, n in want.items() if n >= 8}
    assert sum(n >= 8 for w, n in want.items() if len(w) == 2) > 200
    made = [tuple(w for w in (r.w0, r.w1, r.w2, r.w3, r.w4) if w) for r in sent[-1].collect()]
    passage = ("one", "two", "three", "four", "five", "six")
    assert set(made) == {passage[:5], passage[1:], passage[2:]} and len(made) <= 3 * 4
