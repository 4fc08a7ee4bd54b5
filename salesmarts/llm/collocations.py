"""Phrases whose words belong together, from sorted streams of counts of word sequences.

Counting: a phrase that counts has no rarer part, so words, pairs and triples are counted one
length after the other, each only where its two parts of a word less are frequent as far as a bit
table of fixed size tells. Longer sequences are fewer and are counted together: every word that
begins four that may be frequent begins a window of up to five words, cut off where a triple is
rare. Windows are summed in the tasks, dealt out by ranges of their order and sorted; one pass
over a range then yields the counts of all their beginnings, as each is one of adjacent windows.
Only the few sequences at a range's ends need sums of several ranges. What the tables mistake for
frequent costs work, not counts; of any length there is at most one row per word of text.

Scoring: the counts are kept in two orders. Read by their words from the first on, each sequence
comes after its own beginnings and before its extensions to the right; read from the last word
on, after its own ends and before its extensions to the left. One pass over each stream gives
left parts, right parts and extensions, and a merge join of both streams the scores. A range of
a stream begins with copies of the beginnings that its first sequences have before it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmarts.llm import common

LONGEST, LEAST_COUNT, COVERED_PERCENT, TOP = 5, 100, 100, 2000
#: Bytes of text whose windows are summed at a time, and distinct words whose counts are.
GATHERED, COUNTED = 6 << 20, 200_000
#: Windows that a task holds before their sums are sent on, and rows it sends at a time.
HELD, SENT = 3_000_000, 100_000
#: Bits of the table of one length's sequences that are frequent enough (8 MB each).
TABLE_BITS = 1 << 26
#: Words of the longest sequences that are counted length by length; longer ones are by windows.
BY_LENGTH = 3
#: Words of text, or sequences, that a part is to hold; beyond ``MOST_PARTS`` parts get larger.
#: A part is sorted, and spilled, by Spark and read in one pass, so it never is held whole.
PART_WORDS, PART_GRAMS, MOST_PARTS = 1 << 21, 200_000, 8192
#: Ranges per part, so that parts are about equal, and sampled rows per range.
RANGES, SAMPLED = 2, 16
#: Candidates of a language that are ranked in one group; more are ranked in several first.
RANKED = 100_000

_W = [f"w{k}" for k in range(LONGEST)]
_LOWER = bytes.maketrans(b"\t.,;:!?\x0b\x0c\r", b" \n\n\n\n\n\n\n\n\n")
_STOPS = re.compile(rb"[.,;:!?\x0a-\x0d]")


# Words


def _words(texts: list[bytes]) -> list[bytes]:
    """The texts' words, A-Z lower-cased; a line break stands at every stop and text's end."""
    joined = b"\n".join(texts).lower().translate(_LOWER).replace(b"\n", b" \n ")
    return [w for w in joined.split(b" ") if w]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """Texts by language, about ``GATHERED`` bytes at a time; longer texts are cut at stops."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for block in common.blocks(batches):
        for lang, text in zip(block.column(0).to_pylist(), common.utf8(block.column(1)), strict=True):
            start = 0
            while start < len(text):
                stop = _STOPS.search(text, start + GATHERED) if len(text) - start > GATHERED else None
                end = stop.end() if stop else len(text)
                held.setdefault(lang, []).append(text[start:end])
                size += end - start
                start = end
                if size > GATHERED:
                    yield held
                    held, size = {}, 0
    if held:
        yield held


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sent() -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            columns = [
                pa.array([lang] * len(words), pa.string()),
                pa.array(list(words), pa.binary()).cast(pa.string()),
                pa.array(words.values(), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "f"])

    held: dict[str, Counter] = {}
    for texts in _gathered(batches):
        for lang, part in texts.items():
            found = Counter(_words(part))
            found.pop(b"\n", None)
            found[None] = sum(found.values())
            held.setdefault(lang, Counter()).update(found)
        if sum(map(len, held.values())) > COUNTED:
            yield from sent()
            held = {}
    yield from sent()


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """lang, word, f of words of ``least`` occurrences or more; word null: all of the language's."""
    counted = common.importable(texts).mapInArrow(_word_counts, "lang string, word string, f bigint")
    sums = counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))
    return common.written(sums.where(F.col("word").isNull() | (F.col("f") >= least)), "word-counts")


def _bits(places: DataFrame) -> np.ndarray:
    """Bit table of the hashes ``place``, of fixed size whatever their number."""
    place = (F.pmod(F.col("place"), F.lit(TABLE_BITS)) + 1).alias("place")
    slots = places.select(place).groupBy(F.expr("bitmap_bucket_number(place)").alias("slot"))
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    for r in slots.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits")).collect():
        at = (r["slot"] - 1) * 4096
        table[at : at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return table


def _has(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64(TABLE_BITS - 1)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


# Windows

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(1 << 63))


def _hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _places(words: list[bytes], lang: str, table: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct frequent words in order; per word of the text its place among them from 1, or 0,
    with some more 0 at the end; the hashes of the words at these places, or 0."""
    distinct = sorted(set(words) - {b"\n"})
    hashes = _hashes(distinct, lang)
    keep = _has(table, hashes)
    known = [w for w, k in zip(distinct, keep.tolist(), strict=True) if k]
    index = {w: k for k, w in enumerate(known, 1)}
    ids = np.zeros(len(words) + LONGEST, np.int64)
    ids[: len(words)] = np.fromiter((index.get(w, 0) for w in words), np.int64, len(words))
    return known, ids, np.append(np.uint64(0), hashes[keep] | _MIX[2])[ids]


def _adjacent(hashes: np.ndarray) -> np.ndarray:
    """Where two frequent sequences of one length make one of a word more."""
    return np.flatnonzero((hashes[:-1] != 0) & (hashes[1:] != 0))


def _longer(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes, never 0, of the sequences of a word more that begin at ``at``."""
    found = (hashes[at] * _MIX[0]) ^ ((hashes[at + 1] + _MIX[1]) * _MIX[1])
    return found ^ found >> np.uint64(29) | _MIX[2]


def _table(counted: DataFrame, length: int) -> np.ndarray:
    """Bit table of sequences (lang, phrase) of ``length`` words, by the hashes of ``_longer``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[bytes]] = {}
            for lang, phrase in zip(batch.column(0).to_pylist(), common.utf8(batch.column(1)), strict=True):
                found.setdefault(lang, []).extend(phrase.split(b" "))
            for lang, words in found.items():
                hashes = (_hashes(words, lang) | _MIX[2]).reshape(-1, length)
                while hashes.shape[1] > 1:
                    at = np.arange(hashes.size).reshape(hashes.shape)[:, :-1]
                    hashes = _longer(hashes.ravel(), at)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[:, 0].view(np.int64))], ["place"])

    return _bits(common.importable(counted.select("lang", "phrase")).mapInArrow(run, "place bigint"))


def _windows(
    words: list[bytes], lang: str, tables: list[np.ndarray], longest: int
) -> tuple[list[bytes], np.ndarray]:
    """Distinct words, and windows of places among them from 1, with 0 for none.

    A window begins with one word more than the tables know, of which both parts are frequent,
    and goes on, up to ``longest`` words, with words that end a frequent part of that length.
    """
    known, ids, hashes = _places(words, lang, tables[0])
    for table in tables[1:]:
        at = _adjacent(hashes)
        found = _longer(hashes, at)
        kept = _has(table, found)
        hashes = np.zeros(len(hashes) - 1, np.uint64)
        hashes[at[kept]] = found[kept]
    first = _adjacent(hashes)
    columns = [ids[first + k] for k in range(len(tables) + 1)]
    more = np.ones(len(first), bool)
    for k in range(len(tables) + 1, longest):
        more = more & (hashes[first + k + 1 - len(tables)] != 0)
        columns.append(np.where(more, ids[first + k], 0))
    return known, np.stack(columns, axis=1).astype(np.int32)


def _summed(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order with the sums of their ``n``."""
    wide = rows.astype(np.int64)
    if wide.shape[1] % 2:
        wide = np.pad(wide, ((0, 0), (0, 1)))
    keys = [wide[:, k] << 32 | wide[:, k + 1] for k in range(0, wide.shape[1], 2)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(new)
    return rows[order[at]], np.add.reduceat(n[order], at) if len(at) else n[:0]


class _Held:
    """The windows of one language that a task has met so far, in places among its own words."""

    def __init__(self):
        self.index: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.size = 0

    def add(self, known: list[bytes], rows: np.ndarray) -> None:
        rows, n = _summed(rows, np.ones(len(rows), np.int64))
        index = self.index
        own = np.fromiter((index.setdefault(w, len(index) + 1) for w in known), np.int32, len(known))
        self.rows.append(np.append(np.int32(0), own)[rows])
        self.n.append(n)
        self.size += len(rows)

    def summed(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words in order, distinct windows in their order, and how often each begins."""
        known = sorted(self.index)
        rank = np.zeros(len(known) + 1, np.int32)
        rank[np.fromiter(map(self.index.__getitem__, known), np.int64, len(known))] = np.arange(1, len(known) + 1)
        return known, *_summed(rank[np.concatenate(self.rows)], np.concatenate(self.n))


def _task_windows(
    batches: Iterator[pa.RecordBatch], tables: list[np.ndarray], longest: int
) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """Per language the words, distinct windows and their numbers in a task, or in a part of it."""
    held: dict[str, _Held] = {}
    for texts in _gathered(batches):
        for lang, part in texts.items():
            held.setdefault(lang, _Held()).add(*_windows(_words(part), lang, tables, longest))
        if sum(h.size for h in held.values()) > HELD:
            for lang, of in held.items():
                yield lang, *of.summed()
            held.clear()
    for lang, of in held.items():
        yield lang, *of.summed()


def _counted(texts: DataFrame, tables: list[np.ndarray], least: int) -> DataFrame:
    """lang, phrase, f of the sequences of one word more than the tables know, space-joined,
    with ``least`` occurrences or more."""
    sent = texts.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, known, rows, n in _task_windows(batches, sent.value, len(sent.value) + 1):
            words = pa.array(known, pa.binary()).cast(pa.string())
            for start in range(0, len(rows), SENT):
                part = rows[start : start + SENT] - 1
                phrases = pc.binary_join_element_wise(*(words.take(pa.array(w)) for w in part.T), " ")
                langs = pa.array([lang] * len(part), pa.string())
                yield pa.RecordBatch.from_arrays([langs, phrases, pa.array(n[start : start + SENT])], ["lang", "phrase", "n"])

    counted = common.importable(texts).mapInArrow(run, "lang string, phrase string, n bigint")
    # A task sends each sequence about once and in order, so it is dealt out as it is.
    sums = counted.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    return common.written(sums.where(F.col("f") >= least), f"sequences-{len(tables) + 1}")


def _sum_windows(texts: DataFrame, tables: list[np.ndarray], cuts: list[tuple]):
    """range, lang, w0 to w4, n of windows summed within a task; the range of each is by ``cuts``."""
    sent = texts.sparkSession.sparkContext.broadcast((tables, cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, cuts = sent.value
        for lang, known, rows, n in _task_windows(batches, tables, LONGEST):
            names = [None, *known]
            low = bisect_left(cuts, (lang,))
            # A cut begins its range: where it would stand among the windows.
            own = [c[1:] for c in cuts[low : bisect_left(cuts, (lang + "\0",))]]
            tuples = lambda i: tuple(names[k] for k in rows[i].tolist() if k)  # noqa: B023, E731
            at = [bisect_left(range(len(rows)), c, key=tuples) for c in own]
            ranges = low + np.searchsorted(np.array(at, np.int64), np.arange(len(rows)), "right")
            words = pa.array(known, pa.binary()).cast(pa.string())
            for start in range(0, len(rows), SENT):
                part = slice(start, start + SENT)
                size = len(rows[part])
                columns = [pa.array(ranges[part].astype(np.int32)), pa.array([lang] * size, pa.string())]
                columns += [words.take(pa.array(rows[part, k] - 1, mask=rows[part, k] == 0)) for k in range(LONGEST)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n[part])], ["range", "lang", *_W, "n"])

    named = ", ".join(f"{w} string" for w in _W)
    return common.importable(texts).mapInArrow(run, f"range int, lang string, {named}, n bigint")


def _cuts(rows: DataFrame, columns: list[str], ranges: int) -> list[tuple]:
    """Bounds of about equal ranges of ``rows`` in the order of ``columns``, from a bounded sample.

    They decide who works on what, not what comes out.
    """
    if ranges < 2:
        return []
    drawn = rows.orderBy(F.xxhash64(*columns, F.lit(3))).limit(ranges * SAMPLED).select(*columns).collect()
    flat = sorted(_flat(r) for r in drawn)
    step = len(flat) / ranges
    return sorted({flat[int(k * step)] for k in range(1, ranges)}) if flat else []


def _flat(row) -> tuple:
    """(lang, words as bytes ...) of a row (lang, word ...) or (lang, list of words)."""
    lang, *words = row
    words = words[0] if words and isinstance(words[0], list) else words
    return (lang, *(w.encode() for w in words if w is not None))


def _prefix_sums(least: int, shortest: int):
    """Sums of all beginnings of ``shortest`` words or more of sorted windows (range, lang, w0 to
    w4, n) with ``least`` or more.

    Those that touch an end of a range or batch are sent whatever their sum, as there may be
    more of them elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            ranges, n = batch.column(0).to_numpy(), batch.column(7).to_numpy()
            moved = ranges[1:] != ranges[:-1]
            edge = np.zeros(rows, bool)
            edge[0] = edge[-1] = True
            edge[1:] |= moved
            edge[:-1] |= moved
            same = np.ones(rows, bool)
            same[0] = False
            for k in range(-1, LONGEST):
                column = batch.column(2 + k)
                equal = pc.fill_null(pc.equal(column.slice(1), column.slice(0, rows - 1)), False)
                same[1:] &= equal.to_numpy(zero_copy_only=False)
                if k < shortest - 1:
                    continue
                valid = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
                begin = np.flatnonzero(~same[valid])
                if not len(begin):
                    continue
                sums = np.add.reduceat(n[valid], begin)
                keep = (sums >= least) | (np.add.reduceat(edge[valid].astype(np.int64), begin) > 0)
                at = pa.array(valid[begin][keep])
                words = [batch.column(2 + j).take(at) if j <= k else pa.nulls(len(at), pa.string()) for j in range(LONGEST)]
                yield pa.RecordBatch.from_arrays([batch.column(1).take(at), *words, pa.array(sums[keep])], ["lang", *_W, "f"])

    return run


def sequence_counts(texts: DataFrame, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """lang, words, f of all sequences of one to five words with ``least`` occurrences or more
    in ``texts`` (lang, text), and lang, n: all words of each language."""
    counts = word_counts(texts, least)
    sizes = counts.where("word IS NULL").select("lang", F.col("f").alias("n"))
    single = counts.where("word IS NOT NULL")
    tables = [_bits(single.select(F.xxhash64("lang", "word").alias("place")))]
    grams = single.select("lang", F.array("word").alias("words"), "f")
    while len(tables) < BY_LENGTH:
        counted = _counted(texts, tables, least)
        grams = grams.union(counted.select("lang", F.split("phrase", " ").alias("words"), "f"))
        tables.append(_table(counted, len(tables) + 1))
    words = sizes.agg(F.sum("n")).first()[0] or 0
    parts = min(MOST_PARTS, max(1, -(-words // PART_WORDS)))
    drawn = min(1.0, parts * RANGES * SAMPLED * 4 / max(1, texts.count()))
    cuts = _cuts(_sum_windows(texts.sample(drawn, 5), tables, []), ["lang", *_W], parts * RANGES)
    dealt = _sum_windows(texts, tables, cuts).repartition(parts, "range")
    ordered = dealt.sortWithinPartitions("range", "lang", *_W)
    named = ", ".join(f"{w} string" for w in _W)
    sums = ordered.mapInArrow(_prefix_sums(least, len(tables) + 1), f"lang string, {named}, f bigint")
    sums = sums.groupBy("lang", *_W).agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return common.written(grams.union(sums.select("lang", F.array_compact(F.array(*_W)), "f")), "sequences"), sizes


# Streams of counts

_WALKED = "lang string, words array<string>, f bigint, parts array<bigint>, covered boolean"


def _walked(grams: DataFrame, backwards: bool, percent: int, part_rows: int) -> DataFrame:
    """lang, words, f, parts, covered of each sequence, read in the order of its words, or of its
    words from the last one on.

    ``parts`` holds the counts of its shorter beginnings (ends), ``covered`` says whether an
    extension by one word has ``percent`` of its count. Copies in later ranges have no parts.
    """
    words = F.reverse("words") if backwards else F.col("words")
    stream = grams.select("lang", words.alias("words"), "f")
    parts = min(MOST_PARTS, max(1, -(-grams.count() // part_rows)))
    cuts = _cuts(stream, ["lang", "words"], parts * RANGES if parts > 1 else 1)
    sent = grams.sparkSession.sparkContext.broadcast(cuts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = sent.value
        for batch in batches:
            out = [[], [], []]  # range, row, copy
            for row, (lang, words) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                own = (lang, *(w.encode() for w in words))
                at = bisect_right(cuts, own)
                places = [(at, False)]
                # The ranges that begin with an extension of this sequence.
                while at < len(cuts) and cuts[at][: len(own)] == own:
                    at += 1
                    places.append((at, True))
                for place, copy in places:
                    for held, value in zip(out, (place, row, copy), strict=True):
                        held.append(value)
            at = pa.array(out[1], pa.int64())
            columns = [pa.array(out[0], pa.int32()), *(c.take(at) for c in batch.columns), pa.array(out[2], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["range", "lang", "words", "f", "copy"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent_rows(done: list) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.bool_())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["lang", "words", "f", "parts", "covered"]
            )

        open_: list[list] = []  # words, f, copy, covered of the sequences that the next may extend
        place = None

        def close(depth: int) -> None:
            while len(open_) > depth:
                words, f, copy, covered = open_.pop()
                parts = None if copy else [x[1] for x in open_]
                if covered or not copy:
                    done.append((place[1], words[::-1] if backwards else words, f, parts, covered))

        for batch in batches:
            done: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns]
            for range_, lang, words, f, copy in zip(*columns, strict=True):
                if (range_, lang) != place:
                    close(0)
                    place = (range_, lang)
                close(len(words) - 1)
                while open_ and open_[-1][0] != words[: len(open_)]:
                    close(len(open_) - 1)
                if open_ and 100 * f >= percent * open_[-1][1]:
                    open_[-1][3] = True
                open_.append([words, f, copy, False])
            yield sent_rows(done)
        done = []
        close(0)
        yield sent_rows(done)

    dealt = common.importable(stream).mapInArrow(deal, "range int, lang string, words array<string>, f bigint, copy boolean")
    ordered = dealt.repartition(parts, "range").sortWithinPartitions("range", "lang", "words")
    return common.written(ordered.mapInArrow(walk, _WALKED), "stream")


def _scored(candidates: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each candidate, exactly: a, l, r, n and score."""
    cut = F.explode(F.sequence(F.lit(1), F.size("left"))).alias("k")
    each = candidates.select("lang", "words", "a", "n", "left", "right", cut)
    # The right parts are ordered by length, the longest last: that of the first cut.
    each = each.withColumns({"l": F.col("left")[F.col("k") - 1], "r": F.col("right")[F.size("right") - F.col("k")]})
    wide = lambda c: c.cast("decimal(19,0)")
    score = F.call_function("div", wide(F.col("a") * 1000) * wide(F.col("n")), wide(F.col("l")) * wide(F.col("r")))
    each = each.withColumn("score", score.cast("bigint"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return each.groupBy("lang", "words", "a", "n").agg(lowest).select("lang", "words", "a", "n", "cut.l", "cut.r", "cut.score")


def _ranked(scored: DataFrame, top: int, at_a_time: int) -> DataFrame:
    """The first ``top`` of each language, taken from groups of about ``at_a_time`` candidates."""
    groups = max(1, -(-scored.count() // at_a_time))
    while True:
        group = F.pmod(F.xxhash64("phrase", F.lit(groups)), F.lit(groups))
        best = Window.partitionBy("lang", group).orderBy(F.desc("score"), F.desc("a"), "phrase")
        scored = scored.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)
        if groups == 1:
            return scored
        scored = scored.drop("rank")
        groups = max(1, min(-(-groups * top // at_a_time), groups - 1))


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, percent: int = COVERED_PERCENT, top: int = TOP,
    text_col: str = "text", lang_col: str = "lang", part_grams: int = PART_GRAMS, ranked: int = RANKED,
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts, A-Z lower-cased, are cut into pieces at stops (``.,;:!?`` and \x0A to \x0D) and those
    into words at spaces and tabs. n counts a language's words, a a phrase's occurrences in
    pieces. A phrase of two to five words with ``least`` occurrences or more is cut in two where
    1000 * a * n / (l * r), floored, is lowest (of equals at the first place); l and r are its
    parts' occurrences. Dropped is what stands in a longer such phrase with ``percent`` of its
    occurrences or more. Ranks go by score, then a, both descending, then phrase.

    A null language is ``und``; null and empty texts have no words; repeated rows count again;
    other columns are not read; an empty table gives no rows.
    """
    lang = F.coalesce(common.column(docs, lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), common.column(docs, text_col).cast("string").alias("text"))
    grams, sizes = sequence_counts(texts, least)
    left, right = (_walked(grams, backwards, percent, part_grams) for backwards in (False, True))
    # What is covered by a longer extension is covered by one of one word, which is as frequent.
    covered = left.where("covered").select("lang", "words").union(right.where("covered").select("lang", "words"))
    phrases = left.where("parts IS NOT NULL AND size(words) > 1 AND NOT covered")
    phrases = phrases.select("lang", "words", F.col("f").alias("a"), F.col("parts").alias("left"))
    ends = right.where("parts IS NOT NULL AND size(words) > 1 AND NOT covered")
    ends = ends.select("lang", "words", F.col("parts").alias("right"))
    candidates = phrases.join(ends.hint("merge"), ["lang", "words"])
    candidates = candidates.join(covered.hint("merge"), ["lang", "words"], "left_anti").join(sizes, "lang")
    scored = _scored(candidates).select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "n", "score")
    best = _ranked(common.written(scored, "scored"), top, ranked)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
