"""Document fingerprints: SimHash of weighted terms, and all fingerprints within a radius.

Terms are words and pairs of adjacent words. Each votes with its weight for the set bits of its
hash and against the others. Fingerprints within a radius are found through permuted block
tables: of ``radius + 1`` blocks of bits at least one is equal in two such fingerprints, so each
table brings together those that agree in its block. A large bucket is dealt out as tiles, pairs
of its slices, so that no task holds or compares a whole one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmarts.llm import common

BITS = 128
RADIUS = 3
#: Fingerprints of a bucket that are compared with one another in one tile.
SLICE = 2048
#: Rows of a bucket of ascending ids, and buckets at most; beyond, buckets get larger.
BUCKET_ROWS, MOST_BUCKETS = 2000, 8192
PAIR_WEIGHT = 4.0
#: A word weighs its bytes beyond so many, within bounds: long words are seldom common ones.
SHORT_WORD, HEAVIEST = 2, 8.0

_MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _word(word: bytes) -> tuple[int, float]:
    return xxhash.xxh64_intdigest(word, 7), min(HEAVIEST, max(1.0, len(word) - SHORT_WORD))


class Fingerprinter:
    def __init__(self):
        self.memo = common.Memo(_word)

    def _votes(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(BITS, np.float64)
        for start in range(0, len(hashes), 1 << 13):
            part = hashes[start : start + (1 << 13)]
            both = np.stack((part, _mixed(part + np.uint64(0x9E3779B97F4A7C15))), axis=1)
            bits = np.unpackbits(both.view(np.uint8), axis=1, bitorder="little")
            total += weights[start : start + len(part)] @ bits.astype(np.float32)
        return total

    def of(self, text: bytes) -> bytes:
        """The fingerprint's 16 bytes; all zero for a text without words."""
        words = text.lower().split()
        if not words:
            return bytes(BITS // 8)
        terms = np.array(list(map(self.memo.__getitem__, words)), dtype=[("h", "<u8"), ("w", "<f4")])
        hashes, weights = _mixed(terms["h"]), terms["w"]
        pairs = _mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
        votes = self._votes(hashes, weights) + self._votes(pairs, np.full(len(pairs), PAIR_WEIGHT, np.float32))
        against = float(weights.sum()) + PAIR_WEIGHT * len(pairs)
        return np.packbits(2 * votes > against, bitorder="little").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The cosine of the terms' weights as estimated from the differing bits, at least 0."""
    differ = (int.from_bytes(a, "little") ^ int.from_bytes(b, "little")).bit_count()
    return max(0.0, float(np.cos(np.pi * differ / BITS)))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many of the next."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_FINGERPRINTERS: list[Fingerprinter] = []


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows (bucket, mark, doc_id, text) in buckets of ascending doc_id, null ids last.

    Each bucket also holds, marked, the first rows of the next bucket, the last one those of
    the first. Only ids are read to find the buckets.
    """
    parts = min(MOST_BUCKETS, max(1, docs.count() // BUCKET_ROWS))
    at = [i / parts for i in range(1, parts)] or [0.5]
    cuts = docs.agg(F.percentile_approx("doc_id", at, 20 * parts)).first()[0] or []
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    above = F.size(F.filter(cuts, lambda c: c <= F.col("doc_id")))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(MOST_BUCKETS + 1)).otherwise(above)
    firsts = docs.select(bucket.alias("bucket"), "doc_id").groupBy("bucket").agg(F.min("doc_id").alias("id"))
    found = [(r["bucket"], r["id"]) for r in firsts.orderBy("bucket").collect()]
    after = [(found[i - 1][0], first) for i, (_, first) in enumerate(found)]
    copies = docs.sparkSession.createDataFrame(after, "to int, first bigint")
    rows = docs.join(F.broadcast(copies), F.col("doc_id").eqNullSafe(F.col("first")), "left")
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("mark"))
    copy = F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("bucket"), F.lit(True).alias("mark")))
    places = F.explode(F.array_compact(F.array(own, copy)))
    return (
        rows.select("doc_id", "text", places.alias("place"))
        .select("place.bucket", "place.mark", "doc_id", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "mark", F.asc_nulls_last("doc_id"), "text")
    )


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each unmarked row with the row after it in its bucket."""
    if not _FINGERPRINTERS:
        _FINGERPRINTERS.append(Fingerprinter())
    of = _FINGERPRINTERS[0].of
    held = None  # bucket, doc_id, text, fingerprint of the row before
    for block in common.blocks(batches, text_at=3):
        out: list[list] = [[] for _ in _OUT]
        buckets, marks, ids = (block.column(k).to_pylist() for k in range(3))
        for bucket, mark, doc_id, text in zip(buckets, marks, ids, common.strings(block.column(3)), strict=True):
            if held is None and mark:
                continue  # a further row with the first id of the next bucket
            own = of(text.encode())
            if held is not None:
                _, before_id, before, print_ = held
                changed = edited(before, text).encode()
                print_changed = of(changed)
                row = (
                    before_id, len(before), hashlib.sha256(changed).hexdigest(), print_, print_changed,
                    likeness(print_, print_changed), likeness(print_, own),
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            held = None if mark else (bucket, doc_id, text, own)
        _FINGERPRINTERS[0].memo.trim()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _OUT, strict=True)], schema=_OUT)


# All fingerprints within the radius


def _blocked(fps: DataFrame, radius: int) -> DataFrame:
    """Fingerprints (fp, n) in each table's bucket that holds another one too."""
    width = BITS // (radius + 1)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unpackbits(_words(batch.column(0)).view(np.uint8), axis=1, bitorder="little")
            for t in range(radius + 1):
                stop = BITS if t == radius else (t + 1) * width
                block = np.packbits(bits[:, t * width : stop], axis=1, bitorder="little")
                keys = np.zeros((len(bits), 8 * -(-block.shape[1] // 8)), np.uint8)
                keys[:, : block.shape[1]] = block
                keys = keys.view(np.int64)
                key = keys[:, 0] if keys.shape[1] == 1 else _mixed(keys.view(np.uint64)).sum(axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bits), t, np.int32)), pa.array(key), batch.column(0), batch.column(1)],
                    ["t", "key", "fp", "n"],
                )

    dealt = common.importable(fps).mapInArrow(tables, "t int, key bigint, fp binary, n bigint")
    counts = dealt.groupBy("t", "key").agg(F.count("*").alias("size")).where("size > 1")
    return dealt.join(counts, ["t", "key"])


def _words(column: pa.Array) -> np.ndarray:
    """Fingerprints as rows of two 64-bit words."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint64).reshape(-1, BITS // 64)


def _same_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one tile (first four columns) at a time, from batches in order of them."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        if kept and [kept[-1].column(k)[-1].as_py() for k in range(4)] != keys[0].tolist():
            yield pa.Table.from_batches(kept)
            kept = []
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, stop in zip(edges[:-1], edges[1:], strict=True):
            if start:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(start, stop - start))
    if kept:
        yield pa.Table.from_batches(kept)


def near_counts(fps: DataFrame, radius: int = RADIUS, slice_rows: int = SLICE) -> DataFrame:
    """For each distinct ``fp`` (with its number of rows ``n``) that has another within the
    radius: fp and near, the number of rows with one of those. Exact for every bucket size."""
    width = BITS // (radius + 1)
    slices = F.call_function("div", F.col("size") + (slice_rows - 1), F.lit(slice_rows))
    own = F.pmod(F.xxhash64("fp", F.lit(3)), slices)
    tiled = _blocked(fps, radius).select(
        "t", "key", "fp", "n", own.cast("int").alias("own"), F.explode(F.sequence(F.lit(0), (slices - 1).cast("int"))).alias("other")
    )
    tiled = tiled.select(
        "t", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "fp", "n"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _same_tile(batches):
            t, low, high = (tile.column(k)[0].as_py() for k in (0, 2, 3))
            own = tile.column(4).to_numpy()
            raw = tile.column(5).combine_chunks()
            fp, n = _words(raw), tile.column(6).to_numpy()
            mask = np.zeros((radius + 1, BITS), np.uint8)
            for k in range(radius + 1):
                mask[k, k * width : BITS if k == radius else (k + 1) * width] = 1
            mask = np.packbits(mask, axis=1, bitorder="little").view(np.uint64)
            left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
            near = np.zeros(len(fp), np.int64)
            for start in range(0, len(left), 256):
                rows = left[start : start + 256]
                differ = fp[rows][:, None, :] ^ fp[right][None, :, :]
                close = np.bitwise_count(differ).sum(axis=2, dtype=np.int64) <= radius
                close &= ((differ & mask[t]) == 0).all(axis=2)
                for earlier in range(t):  # such a pair was counted in an earlier table
                    close &= ((differ & mask[earlier]) != 0).any(axis=2)
                if low == high:
                    close &= rows[:, None] != right[None, :]
                near[rows] += close @ n[right]
                if low != high:
                    near[right] += n[rows] @ close
            some = np.flatnonzero(near)
            yield pa.RecordBatch.from_arrays([raw.take(pa.array(some)), pa.array(near[some])], ["fp", "near"])

    found = (
        tiled.repartition("t", "key", "low", "high")
        .sortWithinPartitions("t", "key", "low", "high")
        .mapInArrow(compare, "fp binary, near bigint")
    )
    return found.groupBy("fp").agg(F.sum("near").alias("near"))


def document_fingerprints(
    docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (hex), near_edited, near_next (0 to 1), n_near.

    The edited text is ``edited`` with the next row by doc_id, after the last the first; null ids
    come last and rows with the same id are in order of their texts. The likenesses are of a
    fingerprint to the edited text's and to the next row's. n_near is the number of other rows
    whose fingerprint is within ``radius`` bits. Null counts as an empty text, whose fingerprint
    is zero; equal texts have equal fingerprints; a single row is its own next; other columns
    are not read; an empty table gives no rows.
    """
    rows = common.texts_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    prints = common.importable(_in_order(rows)).mapInArrow(
        _paired,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double",
    )
    prints = common.written(prints, "fingerprints")
    distinct = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.count("*").alias("n"))
    distinct = common.written(distinct, "distinct-fingerprints")
    around = distinct.join(near_counts(distinct, radius), "fp", "left").select(
        F.col("fp").alias("fingerprint"), (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_near")
    )
    # Written, so that the join deals out both sides itself and can split a hot fingerprint's rows.
    around = common.written(around.where("n_near > 0"), "near-fingerprints")
    shown = prints.join(around, "fingerprint", "left")
    as_hex = lambda c: F.lower(F.hex(c)).alias(c)
    return shown.select(
        "doc_id", "n_chars", "edited_sha256", as_hex("fingerprint"), as_hex("edited_fingerprint"),
        "near_edited", "near_next", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
    )
