from __future__ import annotations

import random
import re

import pytest
from odd_documents import clashing, nothing, odd, odd_rows  # noqa: F401

from salesmarts.llm import licenses
from salesmarts.llm.licenses import PHRASES, TEMPLATES, Scanner, SuffixAutomaton, license_scan

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = sorted(
        (i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
    )
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places}))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(8)
    words = "the GNU general public license, mit License apache CC by-nc by/ é1 of software".split()
    return [" ".join(rnd.choices(words, k=rnd.randint(0, 60))) for _ in range(300)] + [t for _, t, *_ in odd_rows()]


def test_base_places_by_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: tuple(r[1:5]) + (r.base_labels,) for r in license_scan(df).collect()}
    assert found == {i: base(t) for i, t in enumerate(texts)}


def test_matching_statistics_by_brute_force():
    rnd = random.Random(3)
    for _ in range(200):
        known = [[rnd.randint(1, 3) for _ in range(rnd.randint(1, 9))] for _ in range(3)]
        machine = SuffixAutomaton()
        for k, words in enumerate(known):
            machine.add(k, words)
        text = [rnd.randint(1, 4) for _ in range(12)]
        runs = {tuple(w[i:j]) for w in known for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        want = [max((n for n in range(1, i + 2) if tuple(text[i - n + 1 : i + 1]) in runs), default=0) for i in range(12)]
        assert machine.statistics(text)[0] == want


@pytest.mark.parametrize("name", list(TEMPLATES))
def test_each_template_is_found_within_other_words(name):
    scanner = Scanner()
    n = len(licenses.words_of(TEMPLATES[name].encode()))
    found = scanner.scan(f"foo bar baz {TEMPLATES[name].upper()} qux".encode())
    assert (3, 3 + n - 1, name, 1.0) in found.spans


def test_an_altered_template_is_chained_and_other_text_is_not():
    text = TEMPLATES["mit-text"].replace("hereby", "hereby now").replace("merge", "fuse")
    spans = Scanner().scan(("start here " + text).encode()).spans
    assert [s[2] for s in spans] == ["mit-text"] and 0.9 < spans[0][3] < 1
    assert Scanner().scan(b"permission is hereby given to the software and the license of any person").spans == []


def test_rows(odd, clashing, nothing):
    for docs in (odd, clashing):
        rows = license_scan(docs).collect()
        assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
        assert all(r.labels == "" and r.first_word is None for r in rows)
    assert license_scan(nothing).collect() == []


def test_a_whole_statement_is_kept_where_another_template_goes_on():
    scanner = Scanner()
    found = scanner.scan(b"Licensed under the Apache License, Version 2.0. The project is here").spans
    assert found == [(0, 7, "apache-statement", 1.0)]
    notice = scanner.scan(TEMPLATES["apache-notice"].encode()).spans
    assert {s[2] for s in notice} == {"apache-statement", "apache-notice"}


def test_every_templates_maximal_matches_by_brute_force(monkeypatch):
    monkeypatch.setattr(licenses, "LEAST_RUN", 2)
    monkeypatch.setattr(Scanner, "_chained", lambda self, matches: sorted(matches))
    rnd = random.Random(4)
    for _ in range(100):
        known = {str(k): " ".join(rnd.choices("abc", k=rnd.randint(2, 9))) for k in range(3)}
        text = rnd.choices("abcd", k=14)
        want = []
        for k, t in enumerate(known.values()):
            t = t.split()
            for i in range(len(text)):
                for j in range(len(t)):
                    n = 0
                    while i + n < len(text) and j + n < len(t) and text[i + n] == t[j + n]:
                        n += 1
                    if n >= 2 and (i == 0 or j == 0 or text[i - 1] != t[j - 1]):
                        want.append((k, i, j, n))
        assert Scanner(known, {}).scan(" ".join(text).encode()).spans == sorted(want)
