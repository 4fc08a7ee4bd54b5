"""Spelling variants: words one edit apart, found by asymmetric chunks, and the form each belongs to.

A word of L code points has two disjoint chunks of L // 2: its beginning and its end. One edit
leaves one of them whole. Of two words one edit apart the longer one gives its chunks and the
other its positional grams; a kept chunk stands in the other word at the same place, or at one
place less where a code point before it is gone. Grams further than that shift from a chunk's
place can meet none and are left out before anything is exchanged. What is left of both words
beside a kept chunk is one edit apart again and has two chunks of its own, so a key holds a
chunk and one of the rest. What meets is verified.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmarts.llm import common

#: Runs of letters in UTF-8 whose A-Z are lower-cased; U+00C0 to U+00FF are C3 80 to C3 BF.
_RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
SLIP = 97
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 5, 3, 2
#: Distinct words counted before their counts are sent on.
COUNTED = 300_000
#: Grams of one key that meet its chunks in one group; more are dealt out in slices.
SLICE = 4096


# Words


def _slipped(word: bytes, h: int) -> bytes:
    text = word.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sent() -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

    held: Counter[bytes] = Counter()
    for block in common.blocks(batches):
        for doc_id, text in zip(block.column(0).to_pylist(), common.utf8(block.column(1)), strict=True):
            runs = _RUN.findall(text.lower())
            held.update(runs)
            start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
            slips = [w for w in runs if not crc32(w, start) % SLIP]
            held.subtract(slips)
            held.update([_slipped(w, crc32(w, start)) for w in slips])
        if len(held) > COUNTED:
            yield sent()
            held.clear()
    yield sent()


def words_of(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n: the documents' words of so many code points and occurrences, written once."""
    counted = common.importable(docs).mapInArrow(_counted, "word string, n bigint")
    words = counted.where(F.char_length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    return common.written(words.where(F.col("n") >= least_count), "words")


# Pairs


def _part(word: Column, at: Column, size: Column) -> Column:
    return F.substr(word, at + 1, size)


def _half(length: Column) -> Column:
    return F.call_function("div", length, F.lit(2)).cast("int")


def _keys(longer: int) -> Column:
    """The keys of ``word`` as part of a pair whose longer word has ``longer`` code points more.

    A key is the longer word's length, which of its chunks are kept, and their texts: a chunk
    of the whole word and one of what is left beside it.
    """
    length = F.char_length("word") + longer
    size = _half(length)
    rest = length - size
    inner = _half(rest)
    keys = []
    for k, kept, left in ((0, F.lit(0), size), (1, rest - longer, F.lit(0))):
        for j, at in ((0, left), (1, left + rest - inner - longer)):
            keys.append(F.struct(
                length.alias("length"), F.lit(2 * k + j).alias("kept"),
                _part(F.col("word"), kept, size).alias("chunk"), _part(F.col("word"), at, inner).alias("inner"),
            ))
    return F.array(*keys)


def chunks(words: DataFrame) -> DataFrame:
    """key (length, kept, chunk, inner) and word: every word with its own chunks."""
    return words.select(F.explode(_keys(0)).alias("key"), "word").select("key.*", "word")


def grams(words: DataFrame) -> DataFrame:
    """The same key and word: a word's grams where the chunks can stand that it shares with a
    word of its own length, or of one code point more."""
    both = F.concat(_keys(0), _keys(1))
    return words.select(F.explode(both).alias("key"), "word").select("key.*", "word")


def near_pairs(words: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """a, b: every two of the distinct ``word`` values that differ by exactly one code point
    inserted, deleted or replaced, once. Keys with many grams are dealt out in slices."""
    key = ["length", "kept", "chunk", "inner"]
    there = grams(words)
    large = there.groupBy(*key).count().where(F.col("count") > slice_rows)
    large = common.written(
        large.select(*key, F.ceil(F.col("count") / slice_rows).cast("int").alias("slices")), "large-grams"
    )
    slices = F.coalesce("slices", F.lit(1))
    there = there.join(large, key, "left").select(
        *key, F.pmod(F.xxhash64("word"), slices).cast("int").alias("slice"), F.col("word").alias("b")
    )
    own = chunks(words).join(large, key, "left").select(
        *key, F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), F.col("word").alias("a")
    )
    # Words of one length meet in both directions, and by each of the chunks they share: a pair
    # is taken in one direction, by the first of them.
    size = _half(F.col("length"))
    rest = F.col("length") - size
    longer = F.col("length") - F.char_length("b")
    at = F.when(F.col("kept") < 2, size).otherwise(0)
    first_chunk = _part(F.col("a"), F.lit(0), size) == _part(F.col("b"), F.lit(0), size)
    first_inner = _part(F.col("a"), at, _half(rest)) == _part(F.col("b"), at, _half(rest))
    met = own.join(there.hint("merge"), [*key, "slice"])
    met = met.where((longer > 0) | (F.col("a") < F.col("b")))
    met = met.where(F.levenshtein("a", "b", 1) == 1)
    return met.where(((F.col("kept") < 2) | ~first_chunk) & ((F.col("kept") % 2 == 0) | ~first_inner)).select("a", "b")


# Forms


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: where the pointers word to form end, by doubling their reach in each round."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        step = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = reached.join(step, "root", "left")
        further = common.written(
            further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"
        )
        reached = further.select("word", "root")
        if further.where("moved").isEmpty():
            return reached


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO, slice_rows: int = SLICE,
) -> DataFrame:
    """One row per word of ``docs``: word, form, root, n, n_near, form_n.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with only A-Z lower-cased. Where 97
    divides the CRC-32 of ``<id>:<run>`` the code point that it points at is deleted. Counted are
    words of ``least_length`` code points and ``least_count`` occurrences or more. Two are near
    if one code point inserted, deleted or replaced turns one into the other. A word's form is
    its near word of most occurrences (of equals the first in code-point order) where it has
    ``ratio`` times the word's or more, else null; its root is where the forms end, or itself.

    A null text has no words; a null id counts as an empty text; repeated rows count again; other
    columns are not read; an empty table gives no rows.
    """
    words = words_of(common.texts_of(docs, id_col, text_col), least_length, least_count)
    pairs = common.written(near_pairs(words, slice_rows), "near-words")
    met = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"))
    met = met.union(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    met = met.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    found = met.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    rows = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    rows = common.written(rows, "forms")
    roots = _roots(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
