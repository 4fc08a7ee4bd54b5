"""Mixing sources to target weights, in DataFrame operations only.

The words of a source, laid end to end, are packed into blocks of fixed length; the last,
shorter block stays at the end. Output shards of equal size draw their slots' sources from a
multinomial; where a source was drawn more often than its target allows, the surplus slots go
to the sources drawn too seldom. The slots of a source, in order, run through its blocks in a
pseudorandom order of its own, again from the start once all are used, and are joined with the
blocks by index. The last slot takes only the words still missing to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salesmarts.llm import common

#: Words of a block.
BLOCK = 256
#: Slots of an output shard.
SHARD = 1024
#: Documents of a source that are put in order together.
CHUNK = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
#: Times its size that a source, and with it a document, is taken at most.
REPEATS = 2

WORD = "[^\\x20\\x09-\\x0D]+"
_LONG = "bigint"


def _div(a, b) -> Column:
    return F.call_function("div", a, b)


def _uniform(*keys) -> Column:
    """A number from 0 up to 1 drawn from the hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / float(1 << 53)


# Sizes and targets


def _sizes(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, keep_rows: bool = False
) -> DataFrame:
    """Written once: row number, doc_id, source, size, the chunk a row is ordered in; and the row."""
    text = F.coalesce(common.column(docs, text_col).cast("string"), F.lit(""))
    rows = docs.select(
        common.column(docs, id_col).cast(_LONG).alias("doc_id"),
        common.column(docs, source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast(_LONG).alias("size"),
        F.monotonically_increasing_id().alias("row_no"),
        *([F.struct(*[common.column(docs, c) for c in docs.columns]).alias("row")] if keep_rows else []),
    )
    written = common.written(rows, "sizes")
    chunks = max(1, written.count() // CHUNK)
    chunk = F.pmod(F.xxhash64(F.coalesce("doc_id", "row_no"), F.lit(seed)), F.lit(chunks))
    return written.withColumn("chunk", chunk)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``sources`` (source, source_size) with its rank, weight and target words.

    By code point, null last, sources weigh ``weights`` in turn. They share ``share`` times the
    sum of all sizes; a target stops at ``REPEATS`` times its source's size and the excess is
    shared again by weight among the others. With caps c and weights w the final share per
    weight is the largest of (total - caps of the k fullest) / (weights of the others) over k,
    taken in order of c/w: each such line lies above what the sources take at that rate.
    """
    everything = Window.partitionBy(F.lit(0))
    in_order = everything.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("rank", F.row_number().over(in_order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(REPEATS))
    fullest = everything.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * share
    rest = total - F.coalesce(F.sum("cap").over(fullest), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fullest), F.lit(0.0))
    line = capped.withColumn("line", F.try_divide(rest, open_weight))
    rate = F.max("line").over(everything)
    return line.withColumn("target", F.least("cap", rate * F.col("weight"))).drop("line", "cap")


# The pseudorandom order of a source's blocks


def _scrambled(x: Column, n: Column, keys: tuple, primes: tuple[int, ...], wide: bool) -> Column:
    """Twice: multiply by a prime beyond n and shift, modulo n; then, within the largest power of
    two up to n, fold the high bits onto the low ones and multiply by an odd number."""

    def times(a: Column, b: Column, added: Column, modulus: Column) -> Column:
        if not wide:
            return F.pmod(a * b + added, modulus)
        exact = a.cast("decimal(19,0)") * b.cast("decimal(19,0)") + added
        return F.pmod(exact, modulus.cast("decimal(19,0)")).cast(_LONG)

    none = F.lit(0).cast(_LONG)
    bits = F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int")
    # Beyond 2^53 the logarithm may be rounded up to the next power.
    bits = bits - (F.call_function("shiftleft", F.lit(1).cast(_LONG), bits) > F.greatest(n, F.lit(1))).cast("int")
    size = F.call_function("shiftleft", F.lit(1).cast(_LONG), bits)
    half = F.call_function("shiftright", bits + 1, F.lit(1))
    for step, prime in enumerate(primes[:2]):
        drawn = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(step)), 33)
        x = times(x, F.lit(prime), drawn, n)
        odd = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(step + 7)), 34) * 2 + 1
        folded = x.bitwiseXOR(F.call_function("shiftright", x, half))
        x = F.when(x < size, times(folded, odd, none, size)).otherwise(x)
    return times(x, F.lit(primes[2]), F.shiftrightunsigned(F.xxhash64(*keys, F.lit(99)), 33), n)


#: Primes beyond every n that the products of bigint, and those of decimals, hold exactly.
_PRIMES, _WIDE_PRIMES = (2147483647, 2147483629, 2147483587), (2**62 - 57, 2**62 - 87, 2**62 - 117)


def _permuted(x: Column, n: Column, *keys) -> Column:
    """A one-to-one map of 0..n-1 onto itself that depends on the keys (n below 2^61)."""
    small = F.least(n, F.lit(_PRIMES[2] - 1).cast(_LONG))
    plain = _scrambled(F.least(x, small - 1), small, keys, _PRIMES, wide=False)
    return F.when(n == small, plain).otherwise(_scrambled(x, n, keys, _WIDE_PRIMES, wide=True))


# Plan and mixture


def _rank_of(ends: list[int], at: str) -> Column:
    """The first rank whose end lies beyond ``at``; ``ends`` has one number per source."""
    return F.size(F.filter(F.lit(ends).cast("array<bigint>"), lambda end: end <= F.col(at)))


def plan(sizes: DataFrame, weights: tuple[int, ...], share: float, block: int, shard: int, seed: int):
    """The sources with their targets and slots, and the slots: shard, rank, ordinal in the source."""
    spark = sizes.sparkSession
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    words = F.round("target").cast(_LONG)
    mix = targets(sources, weights, share).withColumn("words", F.least(words, F.col("source_size") * REPEATS))
    size = F.col("source_size")
    epoch = F.greatest(_div(size + (block - 1), F.lit(block)), F.lit(1).cast(_LONG))
    rest = F.when(size > 0, F.col("words") % size).otherwise(F.lit(0).cast(_LONG))
    wanted = F.when(
        size > 0, _div(F.col("words"), size) * epoch + _div(rest + (block - 1), F.lit(block))
    ).otherwise(F.lit(0).cast(_LONG))
    mix = mix.withColumn("epoch", epoch).withColumn("slots", wanted)
    everything = Window.partitionBy(F.lit(0))
    up_to = everything.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    mix = mix.withColumn("until", F.sum("slots").over(up_to))
    mix = common.written(mix.coalesce(1), "sources")

    ends = [r["until"] for r in mix.select("rank", "until").orderBy("rank").collect()]
    total = ends[-1] if ends else 0
    slots = spark.range(total).select(F.col("id").alias("slot"), _div(F.col("id"), F.lit(shard)).alias("shard"))
    slots = slots.withColumn("at", F.floor(_uniform("slot", F.lit(seed)) * F.lit(float(total))))
    slots = common.written(slots.select("slot", "shard", _rank_of(ends, "at").alias("rank")), "slots")

    # A slot's ordinal in its source: those of earlier shards, then those of its own.
    counts = slots.groupBy("rank", "shard").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("rank", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("rank", "shard").orderBy("slot")
    numbered = slots.withColumn("k", F.row_number().over(within) - 1).join(before, ["rank", "shard"])
    numbered = numbered.select("slot", "shard", "rank", (F.col("before") + F.col("k")).alias("ordinal"))

    # Surplus slots, numbered across sources, fill the gaps of the sources drawn too seldom.
    got = slots.groupBy("rank").agg(F.count("*").alias("got"))
    balance = mix.join(got, "rank", "left").select("rank", "slots", F.coalesce("got", F.lit(0)).alias("got"))
    over = F.greatest(F.col("got") - F.col("slots"), F.lit(0))
    short = F.greatest(F.col("slots") - F.col("got"), F.lit(0))
    balance = balance.withColumn("over_before", F.sum(over).over(up_to) - over)
    balance = balance.withColumn("short_until", F.sum(short).over(up_to)).withColumn("short", short)
    balance = common.written(balance.coalesce(1), "balance")
    gaps = [r["short_until"] for r in balance.select("rank", "short_until").orderBy("rank").collect()]
    surplus = F.when(F.col("ordinal") >= F.col("slots"), F.col("over_before") + F.col("ordinal") - F.col("slots"))
    found = numbered.join(balance.select("rank", "slots", "over_before"), "rank").withColumn("place", surplus)
    found = found.withColumn("to", F.when(F.col("place").isNotNull(), _rank_of(gaps, "place")))
    filled = balance.select(F.col("rank").alias("to"), (F.col("got") - F.col("short_until") + F.col("short")).alias("shift"))
    found = found.join(filled, "to", "left").select(
        "slot", "shard", F.coalesce("to", "rank").alias("rank"),
        F.when(F.col("to").isNull(), F.col("ordinal")).otherwise(F.col("place") + F.col("shift")).alias("ordinal"),
    )
    return mix, found


def drawn_blocks(mix: DataFrame, slots: DataFrame, block: int, seed: int) -> DataFrame:
    """Slots with the block of their source they take: shard, slot, rank, block index, words taken."""
    rows = slots.join(mix.select("rank", "source_size", "words", "epoch"), "rank")
    place = F.col("ordinal") % F.col("epoch")
    turn = _div(F.col("ordinal"), F.col("epoch"))
    # The shorter last block keeps its place, so words and blocks of a turn end together.
    whole = F.col("epoch") - 1
    index = F.when(place == whole, place).otherwise(
        _permuted(place, F.greatest(whole, F.lit(1).cast(_LONG)), F.lit(seed), F.col("rank"), turn)
    )
    start = turn * F.col("source_size") + place * block
    full = F.least(F.lit(block).cast(_LONG), F.col("source_size") - place * block)
    return rows.select(
        "shard", "slot", "rank", index.alias("block"),
        F.greatest(F.least(full, F.col("words") - start), F.lit(0).cast(_LONG)).alias("take"),
    )


def packed(sizes: DataFrame, mix: DataFrame, block: int) -> DataFrame:
    """Where documents lie in their source's blocks: rank, block, doc, from and to (in the block).

    Starts are sums within small chunks of a source, added to sums over its chunks, so that no
    source is put in order as a whole.
    """
    chunk_sums = sizes.groupBy("source", "chunk").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunk_sums.select("source", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "chunk").orderBy("doc_id", "row_no").rowsBetween(Window.unboundedPreceding, -1)
    laid = sizes.where("size > 0").withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    before = before.withColumnRenamed("source", "s").withColumnRenamed("chunk", "c")
    laid = laid.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    ranks = mix.select(F.col("source").alias("mix_source"), "rank")
    laid = laid.join(ranks, F.col("source").eqNullSafe(F.col("mix_source")))
    start = F.col("before") + F.col("inner")
    laid = laid.select("row_no", "rank", start.alias("start"), (start + F.col("size")).alias("stop"))
    first, last = _div(F.col("start"), F.lit(block)), _div(F.col("stop") - 1, F.lit(block))
    pieces = laid.withColumn("block", F.explode(F.sequence(first, last)))
    base = F.col("block") * block
    return pieces.select(
        "rank", "block", "row_no",
        F.greatest(F.col("start") - base, F.lit(0)).alias("from"),
        F.least(F.col("stop") - base, F.lit(block)).alias("to"),
    )


def mixture(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block: int = BLOCK,
    shard: int = SHARD, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    keep_rows: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of the rows, sources with targets, and the pieces of the mixture.

    A piece is ``take`` words of one row from one block in one slot of one output shard.
    """
    sizes = _sizes(docs, id_col, text_col, source_col, seed, keep_rows)
    mix, slots = plan(sizes, weights, share, block, shard, seed)
    drawn = drawn_blocks(mix, slots, block, seed)
    pieces = drawn.join(packed(sizes, mix, block), ["rank", "block"])
    taken = F.least("to", "take") - F.col("from")
    pieces = pieces.withColumn("take", taken).where("take > 0")
    return sizes, mix, pieces.select("shard", "slot", "rank", "block", "row_no", "from", "take")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken (words the mix takes).

    Sizes are numbers of words; a null text has size 0 and is never taken. A null source is a
    source of its own, last in order. Each source's taken words are its target to the word; no
    row exceeds ``REPEATS`` times its size. Repeated rows are rows of their own; other columns
    are not read; an empty table, or one without words, takes nothing. Reruns agree, however the
    rows are partitioned, as long as ids are not repeated or null.
    """
    sizes, mix, pieces = mixture(docs, **options)
    taken = pieces.groupBy("row_no").agg(F.sum("take").alias("taken"))
    figures = mix.select(F.col("source").alias("mix_source"), "source_size", "target")
    rows = sizes.join(figures, F.col("source").eqNullSafe(F.col("mix_source"))).join(taken, "row_no", "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast(_LONG)).alias("taken"))


def mixed_rows(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """``docs`` mixed by whole rows: each is repeated as often as the mix takes its words.

    A row taken x times its size comes floor(x) or floor(x) + 1 times, at random by its id with
    x as the mean, so sources keep their targets on average and no row comes more than
    ``REPEATS`` times. All columns are unchanged.
    """
    sizes, _, pieces = mixture(docs, seed=seed, keep_rows=True, **options)
    taken = pieces.groupBy("row_no").agg(F.sum("take").alias("taken"))
    times = F.floor(F.col("taken") / F.col("size") + _uniform(F.coalesce("doc_id", "row_no"), F.lit(seed + 1))).cast("int")
    copies = sizes.select("row_no", "doc_id", "size").join(taken, "row_no").select("row_no", times.alias("times"))
    rows = sizes.select("row_no", "row").join(copies.where("times > 0"), "row_no")
    return rows.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
