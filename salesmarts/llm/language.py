"""Language identification by n-gram filters that hold all languages at once.

Each language has a Bloom filter of the byte n-grams typical of it. The filters are bit-sliced:
one table whose entry at a hash holds one bit per language, so the AND of an n-gram's entries is
the mask of all languages containing it. More than 64 languages take a table for every 64. A document's bits are counted per language and corrected
for the filter's own rate of false positives; the largest share decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmarts.llm import common

#: Documents taken per language to fit on, at most about as many.
SAMPLE_PER_LANGUAGE = 1500
N = 4  # bytes of an n-gram
TABLE_BITS = 20
HASHES = 2
#: An n-gram is typical of a language if seen as often, and if its rate there is at least this
#: share of its highest rate in any language.
LEAST_COUNT = 3
LEAST_SHARE = 0.35
UNKNOWN = "und"

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_NO_LETTERS = re.compile(r"[\W\d_]+")
_LETTER = regex.compile(r"\p{L}")
_MASKS = {8: np.uint8, 16: np.uint16, 32: np.uint32, 64: np.uint64}
_WIDEST = 64


def _letters(text: str) -> bytes:
    """Lower-case words with one space around each."""
    return (" " + _NO_LETTERS.sub(" ", text.lower()).strip() + " ").encode("utf-8", "replace")


def ngrams(flow: bytes) -> np.ndarray:
    """The n-gram of ``N`` = 4 bytes that begins at each place, as an unsigned number."""
    b = np.frombuffer(flow, np.uint8).astype(np.uint32)
    if len(b) < N:
        return np.zeros(0, np.uint32)
    return b[:-3] | (b[1:-2] << 8) | (b[2:-1] << 16) | (b[3:] << 24)


def _places(grams: np.ndarray) -> list[np.ndarray]:
    mixed = grams ^ (grams >> np.uint32(15))
    return [(mixed * f) >> np.uint32(32 - TABLE_BITS) for f in _FACTORS[:HASHES]]


@dataclass
class Filters:
    languages: list[str]
    tables: list[np.ndarray]  # one bit per language
    false_rate: np.ndarray  # of each language's filter

    def masks(self, grams: np.ndarray) -> list[np.ndarray]:
        first, *others = _places(grams)
        out = []
        for table in self.tables:
            found = table[first]
            for at in others:
                found &= table[at]
            out.append(found)
        return out

    def shares(self, texts: list[str]) -> np.ndarray:
        """Per text and language the share of n-grams it contains, less the false positives."""
        flows = [_letters(t) for t in texts]
        sizes = np.fromiter((len(f) for f in flows), np.int64, len(flows))
        # A gap keeps n-grams from spanning texts; those that touch it are not counted.
        masks = self.masks(ngrams(b"".join(flows) + b"   "))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        n = np.maximum(sizes - N + 1, 0)
        out = np.zeros((len(texts), len(self.languages)))
        some = n > 0
        if some.any():
            edges = np.stack((starts[some], starts[some] + n[some]), axis=1).ravel()
            for k in range(len(self.languages)):
                mask = masks[k // _WIDEST]
                bit = ((mask >> mask.dtype.type(k % _WIDEST)) & mask.dtype.type(1)).astype(np.int64)
                counts = np.add.reduceat(np.append(bit, 0), edges)[::2]
                rate = self.false_rate[k]
                out[some, k] = (counts / n[some] - rate) / (1 - rate)
        return np.clip(out, 0, 1)


def fit(sample: list[tuple[bytes, str]]) -> Filters:
    """Filters of (text, language); the first languages in order win ties."""
    languages = sorted({v for _, v in sample})
    counts = {}
    for language in languages:
        flow = [ngrams(_letters(t.decode())) for t, v in sample if v == language]
        counts[language] = np.unique(np.concatenate(flow), return_counts=True)
    grams = np.unique(np.concatenate([g for g, _ in counts.values()])) if counts else np.zeros(0, np.uint32)
    rates, seen = np.zeros((len(languages), len(grams))), np.zeros((len(languages), len(grams)), bool)
    for k, language in enumerate(languages):
        own, n = counts[language]
        at = np.searchsorted(grams, own)
        rates[k, at] = n / max(1, n.sum())
        seen[k, at] = n >= LEAST_COUNT if n.max(initial=0) >= LEAST_COUNT else True
    top = rates.max(axis=0, initial=0)
    tables, fill = [], []
    for first in range(0, len(languages), _WIDEST) or [0]:
        own = range(first, min(first + _WIDEST, len(languages)))
        mask = next(t for bits, t in _MASKS.items() if bits >= len(own))
        table = np.zeros(1 << TABLE_BITS, mask)
        for k in own:
            for at in _places(grams[seen[k] & (rates[k] >= LEAST_SHARE * top)]):
                table[at] |= mask(1 << (k - first))
        tables.append(table)
        fill += [((table >> mask(k - first)) & mask(1)).mean() for k in own]
    return Filters(languages, tables, np.minimum(np.array(fill) ** HASHES, 0.9))


def languages_of(
    docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    Learns from text and language of a bounded sample of rows that are not held out and whose
    language is not null; predicts from the text alone. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if no row has a language. The score is the
    language's part of all languages' shares. Repeated rows get equal results; a null id stays
    null; other columns are not read.
    """
    rows = common.texts_of(docs, id_col, text_col, common.column(docs, lang_col).cast("string").alias("lang"))
    held = common.held_out(F.col("doc_id"), 4, 2)
    few = common.sampled(rows.where(~held & F.col("text").isNotNull()), "lang", sample_per_language)
    filters = docs.sparkSession.sparkContext.broadcast(fit(common.collected(few, "lang")))

    def scored(block: pa.RecordBatch) -> list:
        f, texts = filters.value, common.strings(block.column(1))
        if not f.languages:
            return [block.column(0), block.column(2), [UNKNOWN] * len(texts), [0.0] * len(texts)]
        shares = f.shares(texts)
        best = shares.argmax(axis=1)
        total = shares.sum(axis=1)
        score = np.where(total > 0, shares.max(axis=1) / np.where(total > 0, total, 1), 1 / len(f.languages))
        known = np.array([bool(_LETTER.search(t)) for t in texts], bool)
        names = [f.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
        return [block.column(0), block.column(2), names, np.where(known, score, 0.0)]

    return common.per_text(
        rows.select("doc_id", "text", held.alias("held_out")), scored,
        "doc_id bigint, held_out boolean, lang_pred string, score double",
    )
