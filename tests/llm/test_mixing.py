from __future__ import annotations

import re
from collections import Counter

import pytest
from odd_documents import clashing, nothing, odd, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from salesmarts.llm import mixing


def sizes_of(rows):
    return [(r[0], r[3], len(re.findall("[^\x20\x09-\x0d]+", r[1] or ""))) for r in rows]


def targets(rows, weights=(3, 1, 2), share=1.5):
    """Shares by weight, the excess over the cap shared again until none is left."""
    size = Counter()
    for _, source, n in rows:
        size[source] += n
    order = sorted(s for s in size if s is not None) + [None] * (None in size)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, out, total = set(order), {}, share * sum(size.values())
    while left:
        rate = (total - sum(out.values())) / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * rate > 2 * size[s]]
        for s in full or list(left):
            out[s] = 2 * size[s] if full else weight[s] * rate
            left.discard(s)
    return size, out


@pytest.mark.parametrize("block, shard", [(1, 16), (7, 5), (256, 1024)])
def test_targets_sizes_and_words_taken(odd, clashing, block, shard):
    rows = sizes_of(odd_rows())
    size, target = targets(rows)
    for docs in (odd, clashing):
        sizes, mix, pieces = mixing.mixture(docs, block=block, shard=shard)
        found = {r.source: r for r in mix.collect()}
        assert {s: r.source_size for s, r in found.items()} == dict(size)
        assert all(abs(found[s].target - target[s]) < 1e-6 for s in target)
        taken = Counter()
        for r in pieces.join(sizes, "row_no").collect():
            taken[r.source] += r.take
        assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-9 for s in target)


def test_rows(odd, clashing, nothing):
    found = [tuple(r) for r in mixing.mixed(odd, block=16, shard=8).collect()]
    assert sorted(((r[0], r[1]) for r in found), key=str) == sorted(((i, n) for i, _, n in sizes_of(odd_rows())), key=str)
    assert all(0 <= r[4] <= 2 * r[1] for r in found)
    assert mixing.mixed(clashing).count() == len(odd_rows())
    assert mixing.mixed(nothing).collect() == [] and mixing.mixed_rows(nothing).collect() == []


def test_reruns_agree_in_any_partitions(spark, odd):
    docs = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    runs = [sorted(map(tuple, mixing.mixed(docs.repartition(n), block=8, shard=16).collect())) for n in (1, 6)]
    assert runs[0] == runs[1]


def test_each_block_comes_once_before_any_comes_again(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 13), "ab"[i % 2]) for i in range(200)], "doc_id bigint, text string, source string")
    _, mix, pieces = mixing.mixture(docs, block=5, shard=32)
    slots = pieces.select("rank", "block", "slot").distinct().groupBy("rank", "block").count().collect()
    for r in mix.collect():
        times = Counter(s["count"] for s in slots if s["rank"] == r["rank"])
        assert len(times) <= 2 and max(times) - min(times) <= 1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 100, 4096, 9999])
def test_permutation(spark, n):
    images = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3)).alias("x"))
    assert sorted(r.x for r in images.collect()) == list(range(n))


@pytest.mark.parametrize("n", [2147483587, 2147483647, 2**33 + 5, 5 * 10**9, 2**53 + 1, 2**60 - 1, 2**61 - 1])
def test_permutation_of_many_blocks(spark, n):
    """By properties on drawn points: within 0 to n - 1, one-to-one, spread over it, and inverted."""
    points = spark.range(4000).select((F.col("id") * F.lit(n // 4000)).alias("x")).union(
        spark.range(1000).select(F.col("id").alias("x"))).union(spark.range(1000).select((F.lit(n - 1) - F.col("id")).alias("x"))).distinct()
    rows = points.select("x", mixing._permuted(F.col("x"), F.lit(n).cast("bigint"), F.lit(3)).alias("y")).collect()
    images = [r.y for r in rows]
    assert all(0 <= y < n for y in images) and len(set(images)) == len(rows) > 5900
    assert all(sum(k * n // 8 <= y < (k + 1) * n // 8 for y in images) > 300 for k in range(8))
    # Every step has an inverse: no prime divides n, and an odd factor has one modulo a power of two.
    assert all(n % p for p in mixing._WIDE_PRIMES)


def test_shards_are_drawn_not_dealt(spark):
    docs = spark.createDataFrame([(i, "w " * 40, "abc"[i % 3]) for i in range(600)], "doc_id bigint, text string, source string")
    _, _, pieces = mixing.mixture(docs, block=4, shard=100)
    counts = pieces.select("shard", "slot", "rank").distinct().groupBy("shard", "rank").count().collect()
    first = [r["count"] for r in counts if r["rank"] == 0]
    mean = sum(first) / len(first)
    variance = sum((x - mean) ** 2 for x in first) / len(first)
    assert 0.5 < variance / (mean * (1 - mean / 100)) < 1.7  # that of a multinomial


def test_rows_are_repeated_whole(odd):
    out = mixing.mixed_rows(odd, block=8)
    assert out.columns == odd.columns
    assert max(Counter(r.doc_id for r in out.where("doc_id < 104").collect()).values()) <= 2


def test_no_python_in_the_plan(odd):
    plan = mixing.mixed(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
