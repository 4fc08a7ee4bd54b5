from __future__ import annotations

import glob
import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from odd_documents import clashing, nothing, odd, odd_rows  # noqa: F401
from tokenizers import Tokenizer

from salesmarts.llm import token_files
from salesmarts.session import scratch_path

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(file, texts):
    return [e.ids for e in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]


def ordered(rows, file=WORDS, end=1):
    """doc_id, start, ids in file order but for the order of equal ids."""
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, r[0] or 0))
    return [(i, [*x, end]) for (i, _), x in zip(rows, library(file, [t for _, t in rows]))]


def digest(ids):
    return crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module", params=[7, 8192])
def files(request, spark, odd):
    path = scratch_path(spark, "odd-tokens")
    token_files.write_token_files(odd, path, WORDS, 1, part_rows=request.param)
    return path


def test_rows_read_back(spark, files):
    got = token_files.checked(spark, files).orderBy("start").collect()
    want = ordered(odd_rows())
    assert [r.doc_id for r in got] == [i for i, _ in want]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(((i, len(x), digest(x)) for i, x in want), key=key)


def test_any_range_of_tokens(spark, files):
    rows = token_files.documents(spark, files).collect()
    base = {r.part: r.base for r in token_files.index(spark, files).collect()}
    rows.sort(key=lambda r: base[r.part] + r.start)
    whole = [x for r in rows for x in r.ids]
    rnd = random.Random(2)
    for low in [0, len(whole) - 1, len(whole), *(rnd.randrange(len(whole)) for _ in range(4))]:
        high = low + rnd.choice([1, 50, 40000])
        got = sorted(token_files.tokens_between(spark, files, low, high).collect(), key=lambda r: r.start)
        assert [x for r in got for x in r.ids] == whole[low:high]
        assert all(r.start >= low for r in got)


def test_selective_reads(spark, files):
    got = token_files.tokens_of(spark, files, [5, 104, 999]).collect()
    want = [(i, x) for i, x in ordered(odd_rows()) if i in (5, 104)]
    assert sorted((r.doc_id, r.ids) for r in got) == sorted(want)
    plan = token_files.metadata(spark, files)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1]
    plan = token_files.tokens_between(spark, files, 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(part" in plan.split("PushedFilters")[1]


def test_encodings_row_groups_and_pages(spark, odd):
    path = scratch_path(spark, "small-pages")
    rows = odd.where("doc_id IS NOT NULL")
    for _ in range(5):
        rows = rows.unionAll(rows)
    token_files.write_token_files(rows, path, WORDS, 1, group_bytes=1 << 12, page_rows=50)
    (file,) = glob.glob(f"{path}/rows/*.parquet")
    meta = pq.read_metadata(file)
    assert meta.num_row_groups > 2
    columns = [meta.row_group(0).column(k) for k in range(meta.num_columns)]
    by_name = {c.path_in_schema: c for c in columns}
    assert all(c.has_offset_index for c in columns) and by_name["start"].has_column_index
    assert "RLE_DICTIONARY" in by_name["ids.list.element"].encodings
    for name in ("part", "start", "n_tokens", "doc_id"):
        assert by_name[name].encodings == ("DELTA_BINARY_PACKED",)


def test_encoder_is_the_library():
    rnd = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "É", "é", "é", "the", "The", "ing", "'s", "'", ".", ",", "!", "?.", "12", "字", "🙂", "́", "\x85",
             "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "ǅ", "Σ", "İ", " ", "ſ", "_",
             "H", "h", "\u0331", "T", "J", "\u030c", "I", "\u0307", "K", "Ω"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(6000)]
    with open(WORDS, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read())
    assert encoder.cuttable
    assert encoder.ids(pa.array(texts)).to_pylist() == library(WORDS, texts)


def test_encoder_starts_its_memos_afresh(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_WORDS", 3)
    with open(WORDS, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read())
    for texts in (["one two three four five."], ["six seven"], ["one. two"]):
        assert encoder.ids(pa.array(texts)).to_pylist() == library(WORDS, texts)


def test_other_tokenizers_encode_whole_texts(spark, odd):
    path = scratch_path(spark, "byte-tokens")
    token_files.write_token_files(odd, path, BYTES)
    got = sorted(((r.doc_id, r.ids) for r in token_files.documents(spark, path).collect()), key=str)
    assert got == sorted(((i, x[:-1]) for i, x in ordered(odd_rows(), BYTES)), key=str)


def test_clashing_columns_and_empty_table(spark, clashing, nothing):
    path = scratch_path(spark, "clashing-tokens")
    token_files.write_token_files(clashing, path, WORDS, 1)
    assert token_files.checked(spark, path).count() == len(odd_rows())
    path = scratch_path(spark, "no-tokens")
    token_files.write_token_files(nothing, path, WORDS, 1)
    assert token_files.checked(spark, path).collect() == [] and token_files.tokens_between(spark, path, 0, 9).collect() == []
