from __future__ import annotations

import random

import public_tokenizers
import pytest
from odd_documents import clashing, nothing, odd, odd_rows, table  # noqa: F401
from tokenizers import Tokenizer

from salesmarts.llm import token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(file, texts):
    return [len(e.ids) for e in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("file", [BYTES, WORDS])
def test_counts_are_the_librarys(odd, file):
    texts = [t or "" for _, t, *_ in odd_rows()]
    want = [(i, len(t.encode()), n, n > 512) for (i, *_), t, n in zip(odd_rows(), texts, library(file, texts))]
    found = token_counts.token_counts(odd, file)
    assert table(found) == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])


def test_any_mixture_of_spaces_signs_and_special_strings():
    rnd = random.Random(1)
    parts = [" ", "  ", "\n", "\t", " ", "a", "é", "the", "<|endoftext|>", "'s", ".", "1", "字", "\x1c", "🙂", " x", "don't"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(3000)]
    with open(BYTES, encoding="utf-8") as f:
        counter = token_counts.Counter(f.read())
    assert counter.cuttable and counter.counts(texts) == library(BYTES, texts)


def test_memo_may_start_afresh(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_CHUNKS", 2)
    with open(BYTES, encoding="utf-8") as f:
        counter = token_counts.Counter(f.read())
    for texts in (["a b c d", "e f g"], ["a b c d"]):
        assert counter.counts(texts) == library(BYTES, texts)
    assert len(counter.known) == 0 or len(counter.known) <= 3


def test_clashing_columns_and_empty_table(clashing, nothing):
    assert token_counts.token_counts(clashing, BYTES).count() == len(odd_rows())
    assert token_counts.token_counts(nothing, BYTES).collect() == []
