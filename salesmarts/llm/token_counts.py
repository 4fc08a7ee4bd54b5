"""Token counts by batch encoding, returning lengths only.

A document is cut at boundaries that no token can span, equal chunks are encoded once, and
the chunks still unknown go to the tokenizer library in batches of equal bytes.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
from pyspark.sql import DataFrame

from salesmarts.llm import common

#: Bytes of text in one entry of an encoding batch.
SEGMENT_BYTES = 32 << 10
#: Chunks whose counts are kept for later texts; beyond, the memo starts afresh.
MEMO_CHUNKS = 1_200_000

# A single space between two characters that are no white space always begins a new word of
# the byte-level splitting pattern, whatever stands around it.
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
_UNSAFE_SPACE = re.compile(r"\s | \s|^ | $")


class Counter:
    """Counts tokens of texts as the tokenizers library does for the given JSON."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        config = json.loads(tokenizer_json)
        split = config.get("pre_tokenizer") or {}
        self.cuttable = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space", True)
            and not config.get("normalizer")
        )
        added = config.get("added_tokens") or []
        self.added = [t["content"] for t in added]
        plain = [t for t in added if not (t["lstrip"] or t["rstrip"] or t["single_word"])]
        self.cuttable = self.cuttable and len(plain) == len(added) > 0
        self.cuttable = self.cuttable and not any(" " in t for t in self.added)
        self.mark, self.mark_id = (added[0]["content"], added[0]["id"]) if added else ("", -1)
        self.known: dict[str, int] = {}  # chunk after a space
        self.first: dict[str, int] = {}  # chunk at the start of a text

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str], prefix: str, into: dict[str, int]) -> None:
        """Counts of chunks: joined by a mark that ends every word, cut apart again by its id."""
        held = [c for c in chunks if any(t in c for t in self.added)]
        into.update(zip(held, self._encode([prefix + c for c in held]), strict=True))
        plain = [c for c in chunks if c not in into]
        segments, size = [[]], 0
        for chunk in plain:
            if size > SEGMENT_BYTES:
                segments.append([])
                size = 0
            segments[-1].append(chunk)
            size += len(chunk) + 1
        joined = [self.mark.join([prefix + c for c in part]) for part in segments if part]
        for part, encoded in zip(
            segments, self.tokenizer.encode_batch(joined, add_special_tokens=False), strict=False
        ):
            ids = np.asarray(encoded.ids)
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
            counts = np.diff(ends, prepend=-1) - 1
            into.update(zip(part, counts.tolist(), strict=True))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.cuttable:
            return self._encode(texts)
        cut = []
        for text in texts:
            if _UNSAFE_SPACE.search(text):
                parts = _SAFE_CUT.split(text)
                cut.append([parts[0], *(p[1:] for p in parts[1:])])
            else:
                cut.append(text.split(" "))
        known, first = self.known, self.first
        self._learn(list({c[0] for c in cut} - first.keys()), "", first)
        self._learn(list(set().union(*(c[1:] for c in cut)) - known.keys()), " ", known)
        out = [first[c[0]] + sum(map(known.__getitem__, c[1:])) for c in cut]
        for memo in (known, first):
            if len(memo) > MEMO_CHUNKS:
                memo.clear()
        return out


_COUNTERS: dict[int, Counter] = {}  # one per tokenizer and Python worker


def token_counts(
    docs: DataFrame, tokenizer_file: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``tokenizer_file`` is a JSON of the tokenizers library, read by the driver and sent to the
    tasks. Tokens are those of the whole text without added begin or end; strings of special
    tokens inside a text are special tokens, the library's default. A null or empty text has
    0 bytes and 0 tokens; a null id stays null; repeated rows give repeated results; other
    columns are not read; an empty table gives no rows.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    key = hash(tokenizer_file)

    def scored(block):
        if key not in _COUNTERS:
            _COUNTERS[key] = Counter(model.value)
        texts = common.strings(block.column(1))
        n = _COUNTERS[key].counts(texts)
        sizes = [len(t.encode()) for t in texts]
        return [block.column(0), sizes, n, [x > limit for x in n]]

    return common.per_text(
        common.texts_of(docs, id_col, text_col), scored,
        "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    )
