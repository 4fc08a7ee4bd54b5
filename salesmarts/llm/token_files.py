"""Token ids as Parquet files in order of document ids, for selective reads of ids and metadata.

A row is a document: its part, the place of its first id within the part, the number of its
ids, and the ids as a list. Ids are dictionary-encoded, the other columns hold small steps and
are delta-encoded (pages of version 2). Row groups and pages are bounded in bytes and rows, and
every page has its entry in the page index, so a filter on part or place reads few pages and a
read of metadata no ids. The index, a table beside, holds every part's place in the whole: the
rows are written once, by tasks that need not know of one another.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import filterfalse
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmarts.llm import common

#: Bytes of a row group and of a page, and rows of a page, unless told otherwise.
GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 128 << 10, 2000
#: Text that a part is to hold, estimated from rows; beyond ``MOST_PARTS`` parts get larger.
PART_ROWS, MOST_PARTS = 8192, 50_000
#: Words whose ids are kept for later texts; beyond, the memo starts afresh.
MEMO_WORDS = 500_000
#: Bytes of text whose chunks are told apart at a time.
BLOCK_BYTES = 6 << 20
#: Words in one entry of an encoding batch.
SEGMENT = 256

# The settings of word tokenizers whose tokens never reach over a space.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = re.compile("[ \n]")
# One word of the splitting pattern, whatever stands beside it after a space.
_LETTERS = r"^[a-z\x{00e0}-\x{00f6}\x{00f8}-\x{00ff}]+$"
# A letter or digit and a stop after it are never in one token. U+0130 becomes a letter and a
# mark when lower-cased, and a mark goes with the stop.
_STOP = r"[A-Za-z0-9\x{00c0}-\x{00d6}\x{00d8}-\x{00f6}\x{00f8}-\x{012f}\x{0131}-\x{024f}][.,;:!?]$"
# Signs beyond Latin letters, among them marks.
_OTHER = r"[^\x{0000}-\x{024f}]"


def _taken(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Stretches ``which`` of ``flat``, which holds stretches of ``sizes`` one after another."""
    starts = np.cumsum(sizes) - sizes
    n = sizes[which]
    before = np.cumsum(n) - n
    return flat[np.repeat(starts[which] - before, n) + np.arange(int(n.sum()))]


class Encoder:
    """Ids of whole texts as the tokenizers library gives them for the given JSON.

    Where the settings show that no token reaches over a space or a line break, texts are cut
    there, and each distinct chunk is encoded once.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        config = json.loads(tokenizer_json)
        steps = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split = steps[0]
        pattern = (split.get("pattern") or {}).get("Regex", "")
        # Every branch of the pattern is made of signs that are no white space; the rest goes.
        branches = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "[\\p{L}]+", "[\\p{N}]", "[^\\s\\p{L}\\p{N}]+"]
        added = config.get("added_tokens") or []
        self.cuttable = (
            (config.get("normalizer") or {}).get("normalizers") == _NORMAL
            and (split.get("type"), split.get("behavior"), split.get("invert")) == ("Split", "Removed", True)
            and pattern.split("|") == branches
            and all(x.get("type") == "ByteLevel" and not x.get("add_prefix_space") and not x.get("use_regex") for x in steps[1:])
            and not config.get("post_processor") and not config.get("truncation") and not config.get("padding")
            and len(added) > 0
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or _CUT.search(x["content"]) for x in added)
        )
        self.added = [x["content"] for x in added]
        self.mark, self.mark_id = (added[0]["content"], added[0]["id"]) if added else ("", -1)
        self.cuttable = self.cuttable and all("<" in a for a in self.added)
        suffix = config["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool) if suffix else None
        if suffix:
            # Words of letters are normal and whole already: only their bytes and pairs are left to do.
            config |= {"normalizer": None, "added_tokens": []}
            config["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *steps[1:]]}
            self.plain = Tokenizer.from_str(json.dumps(config))
            self.ends[[k for t, k in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Ids of words, encoded joined and cut apart again: words of letters only by the ids that
        end a word, others by those of a mark between them."""
        plain = pc.match_substring_regex(pa.array(words, pa.string()), _LETTERS).to_pylist() if self.ends is not None else [False] * len(words)
        lettered = [w for w, p in zip(words, plain, strict=True) if p]
        others = [w for w, p in zip(words, plain, strict=True) if not p]
        held = [w for w in others if any(a in w for a in self.added)]
        self.known.update(zip(held, (x.tobytes() for x in self._encode(held)), strict=True))
        others = [w for w in others if w not in self.known]
        if lettered:
            ids = self._joined(lettered, " ", self.plain)
            self._cut(lettered, ids, np.flatnonzero(self.ends[ids]) + 1, 0)
        if others:
            # A mark at the end of every segment, too, so that all are cut alike.
            ids = self._joined(others, self.mark, self.tokenizer, self.mark)
            self._cut(others, ids, np.flatnonzero(ids == self.mark_id), 1)

    def _joined(self, words: list[str], by: str, tokenizer, last: str = "") -> np.ndarray:
        """The ids of all words, encoded joined in segments."""
        segments = [by.join(words[k : k + SEGMENT]) + last for k in range(0, len(words), SEGMENT)]
        found = tokenizer.encode_batch_fast(segments, add_special_tokens=False)
        return np.concatenate([np.array(e.ids, "<u4") for e in found])

    def _cut(self, words: list[str], ids: np.ndarray, ends: np.ndarray, skipped: int) -> None:
        raw = ids.tobytes()
        ends = 4 * ends
        starts = [0, *(ends[:-1] + 4 * skipped).tolist()]
        self.known.update(zip(words, [raw[s:e] for s, e in zip(starts, ends.tolist(), strict=True)], strict=True))

    def _of(self, words: list[str]) -> list[bytes]:
        """The ids of words, none of which comes twice."""
        if len(self.known) > MEMO_WORDS:
            self.known = {"": b""}
        found = list(map(self.known.get, words))
        new = [k for k, ids in enumerate(found) if ids is None]
        if new:
            self._learn([words[k] for k in new])
            for k in new:
                found[k] = self.known[words[k]]
        return found

    def ids(self, texts: pa.Array, end: bytes = b"") -> pa.ListArray:
        """The ids of each text, and the bytes of ``end`` after them."""
        texts = pc.fill_null(texts, "")
        if not self.cuttable:
            found = [x.tobytes() + end for x in self._encode(texts.to_pylist())]
            return _listed(b"".join(found), np.array([len(x) // 4 for x in found], np.int64))
        # ASCII letters are lower-cased here as the tokenizer does, so that fewer chunks differ;
        # not beside marks, which would join them otherwise, nor in special strings.
        other = pc.or_(pc.match_substring(texts, "<"), pc.match_substring_regex(texts, _OTHER))
        texts = pc.replace_substring(pc.if_else(other, texts, pc.ascii_lower(texts)), "\n", " ")
        cut = pc.split_pattern(texts, " ")
        chunks = cut.flatten().dictionary_encode()
        # A chunk is a word and a stop, or a word alone.
        stopped = pc.match_substring_regex(chunks.dictionary, _STOP)
        short = pc.utf8_slice_codeunits(chunks.dictionary, 0, -1)
        words = pc.if_else(stopped, short, chunks.dictionary).dictionary_encode()
        stops = pc.if_else(stopped, pc.utf8_slice_codeunits(chunks.dictionary, -1), "").dictionary_encode()
        parts = [*self._of(words.dictionary.to_pylist()), *self._of(stops.dictionary.to_pylist())]
        pair = np.stack((words.indices.to_numpy(), stops.indices.to_numpy() + len(words.dictionary)), axis=1).ravel()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        pool = _taken(np.frombuffer(b"".join(parts), "<u4"), sizes, pair)
        sizes = np.append(sizes[pair].reshape(-1, 2).sum(axis=1), len(end) // 4)
        # Every text's chunks, then the end as another one.
        lasts = cut.offsets.to_numpy()[1:].astype(np.int64) - cut.offsets.to_numpy()[0]
        which = np.insert(chunks.indices.to_numpy(), lasts, len(sizes) - 1)
        values = _taken(np.append(pool, np.frombuffer(end, "<u4")), sizes, which)
        until = np.cumsum(sizes[which])[lasts + np.arange(len(lasts))]
        return _listed(values.tobytes(), np.diff(until, prepend=0))


_ENCODERS: dict[int, Encoder] = {}  # by the tokenizer's content, one per Python worker


def _listed(raw: bytes, sizes: np.ndarray) -> pa.ListArray:
    """Lists of so many ids each."""
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(raw)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _in_order(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` dealt out by ascending doc_id (null last), then by text, equal rows among parts too."""
    tie = F.struct(F.xxhash64("text").alias("h"), "row_no")
    order = [F.col("doc_id").isNull(), F.col("doc_id"), tie]
    dealt = rows.select("doc_id", "text", F.monotonically_increasing_id().alias("row_no"))
    return dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row_no")


def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int | None = None, id_col: str = "doc_id",
    text_col: str = "text", group_bytes: int = GROUP_BYTES, page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS,
    part_rows: int = PART_ROWS,
) -> None:
    """Write the ids of every whole text of ``docs`` below ``path``, in order of ids.

    ``path/rows``: part, start (ids of the part before it), n_tokens, doc_id, ids. ``path/index``:
    part, base (ids of all parts before), n_rows, n_tokens, least and greatest doc_id.
    ``tokenizer_file`` is a JSON of the tokenizers library; no special tokens are added, but
    ``end_id`` ends every document if given. Null texts count as empty; rows without an id come
    last; of repeated ids the order is by text; other columns are not read; an empty table gives
    files without rows.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        model = f.read()
    key, sent = hash(model), spark.sparkContext.broadcast(model)
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(sent.value)
        before = 0
        for block in common.blocks(batches, size=BLOCK_BYTES):
            lists = _ENCODERS[key].ids(block.column(1), end)
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            starts = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(starts), pa.array(n), lists], ["doc_id", "start", "n_tokens", "ids"]
            )

    rows = common.texts_of(docs, id_col, text_col)
    parts = min(MOST_PARTS, max(1, -(-rows.count() // part_rows)))
    ids = common.importable(_in_order(rows, parts)).mapInArrow(
        encoded, "doc_id bigint, start bigint, n_tokens bigint, ids array<int>"
    )
    whole = ids.select(F.spark_partition_id().alias("part"), "start", "n_tokens", "doc_id", "ids")
    writer = whole.write.option("parquet.block.size", group_bytes).option("parquet.page.size", page_bytes)
    writer = writer.option("parquet.page.row.count.limit", page_rows).option("parquet.writer.version", "v2")
    writer.option("parquet.enable.dictionary", False).option("parquet.enable.dictionary#ids.list.element", True).option(
        "parquet.dictionary.page.size", 1 << 20
    ).parquet(f"{path}/rows")
    sums = metadata(spark, path).groupBy("part").agg(
        F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"),
        F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest"),
    )
    # One row per part, and parts are bounded in number.
    base, index = 0, []
    for r in sums.orderBy("part").collect():
        index.append((r["part"], base, r["n_rows"], r["n_tokens"], r["least"], r["greatest"]))
        base += r["n_tokens"]
    spark.createDataFrame(index, _INDEX).coalesce(1).write.parquet(f"{path}/index")


_ROWS = "part int, start bigint, n_tokens bigint, doc_id bigint, ids array<int>"
_INDEX = "part int, base bigint, n_rows bigint, n_tokens bigint, least bigint, greatest bigint"


def index(spark: SparkSession, path: str) -> DataFrame:
    """One row per part: its place in the whole, its rows and ids, least and greatest doc_id."""
    return spark.read.schema(_INDEX).parquet(f"{path}/index")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """All rows as they are in the files, with start within the part."""
    return spark.read.schema(_ROWS).parquet(f"{path}/rows")


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """part, start, n_tokens, doc_id: no ids are read."""
    return documents(spark, path).drop("ids")


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with start in the whole; ``parts`` are rows of the index, bounded in number."""
    return rows.join(F.broadcast(parts.select("part", "base")), "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), *[c for c in rows.columns if c in ("n_tokens", "ids")]
    )


def tokens_between(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """doc_id, start (in the whole) and ids that stand from ``low`` to before ``high``.

    The parts concerned are found in the index, and the filter on part and place reaches the
    files' row groups and pages.
    """
    parts = index(spark, path).where((F.col("base") < high) & (F.col("base") + F.col("n_tokens") > low))
    wanted: Column = F.lit(False)
    found = parts.orderBy("part").collect()
    if found:
        first, last = found[0], found[-1]
        wanted = F.col("part").between(first["part"], last["part"])
        # A document that reaches into the range may begin before it, so ends are compared.
        wanted &= (F.col("part") > first["part"]) | (F.col("start") + F.col("n_tokens") > low - first["base"])
        wanted &= (F.col("part") < last["part"]) | (F.col("start") < high - last["base"])
    rows = _placed(documents(spark, path).where(wanted), parts)
    skip = F.greatest(F.lit(low) - F.col("start"), F.lit(0)).cast("int")
    take = F.least(F.col("n_tokens"), F.lit(high) - F.col("start")).cast("int") - skip
    cut = rows.where((F.col("start") < high) & (F.col("start") + F.col("n_tokens") > low))
    return cut.select("doc_id", (F.col("start") + skip).alias("start"), F.slice("ids", skip + 1, take).alias("ids"))


def tokens_of(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id, start, n_tokens and ids of the documents named; pages of other ids are passed over."""
    rows = documents(spark, path).where(F.col("doc_id").isin(doc_ids))
    return _placed(rows, index(spark, path)).select("doc_id", "start", "n_tokens", "ids")


def checked(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the files.

    ids_crc32 is the CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4")).cast("B")
            found = [crc32(raw[4 * s : 4 * e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    rows = _placed(documents(spark, path), index(spark, path)).select("doc_id", "start", "n_tokens", "ids")
    return common.importable(rows).mapInArrow(digests, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
