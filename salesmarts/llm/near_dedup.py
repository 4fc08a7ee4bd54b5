"""Near duplicates: SimHash of word shingles, linked exactly by vantage-point trees.

The distinct fingerprints are dealt to shards by a tree of vantage points, fitted on a bounded
sample: inside or outside the median Hamming distance to the node's point. A fingerprint whose
distance is within the radius of a boundary also visits the shard on the other side, so every
pair within the radius meets in the home shard of one of the two. A shard builds a tree of its
own and searches it with the same triangle bounds. It returns only a spanning forest of the
links it finds; the rest follows from connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmarts.llm import common
from salesmarts.llm.components import components

#: Distinct fingerprints on which the shards' tree is fitted.
SAMPLE = 8192
#: Distinct fingerprints that a shard is to have at home; more fingerprints, more shards.
SHARD = 1 << 15
LEAST_DEPTH = 4
#: Fingerprints in a leaf of a shard's own tree, compared with one another directly.
LEAF = 64
_QUERIES = 1 << 14  # compared with a leaf at a time


# Fingerprints


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """Bit majority of the XXH64 of the shingles of ``words`` words, A-Z lower-cased.

    Words are separated by space or \\x09-\\x0D. Fewer words make one shingle, none give 0.
    """
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(found) - words + 1].tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, stops, strict=True)], np.uint64)
    votes = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[part : part + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _signed(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (its 64 bits as bigint) of every row; null text counts as empty."""

    def scored(block: pa.RecordBatch) -> list:
        found = [fingerprint(t, words) for t in common.utf8(block.column(1))]
        return [block.column(0), pa.array(_signed(np.array(found, np.uint64)))]

    return common.per_text(common.texts_of(docs, id_col, text_col), scored, "doc_id bigint, fingerprint bigint")


# Vantage-point trees


def _distance(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int]:
    """The point among a few that spreads the others most, and their median distance from it."""
    tried = points[:: max(1, len(points) // 8)][:8]
    best = max(tried, key=lambda v: float(np.var(_distance(points, v))))
    return best, int(np.median(_distance(points, best)))


def shard_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage point and boundary of each inner node of a full tree, the root at 1."""
    points = np.zeros(1 << depth, np.uint64)
    bounds = np.zeros(1 << depth, np.int64)
    at = {1: sample}
    for node in range(1, 1 << depth):
        here = at.pop(node)
        if len(here):
            points[node], bounds[node] = _vantage(here)
        inside = _distance(here, points[node]) <= bounds[node]
        at[2 * node], at[2 * node + 1] = here[inside], here[~inside]
    return points, bounds


def routed(fps: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: int, radius: int):
    """(row, shard, at home) of each fingerprint: its home shard and the earlier ones it visits.

    Visits to earlier shards are enough: of two fingerprints in different shards the later one
    visits the earlier one's.
    """
    points, bounds = tree
    rows, nodes = np.arange(len(fps)), np.ones(len(fps), np.int64)
    home = np.ones(len(fps), bool)
    for _ in range(depth):
        d = _distance(fps[rows], points[nodes]).astype(np.int64)
        inside = d <= bounds[nodes]
        near = np.where(inside, d + radius > bounds[nodes], d - radius <= bounds[nodes])
        rows, home = np.concatenate((rows, rows[near])), np.concatenate((home, np.zeros(near.sum(), bool)))
        nodes = np.concatenate((nodes * 2 + ~inside, nodes[near] * 2 + inside[near]))
    shard = nodes - (1 << depth)
    own = np.empty(len(fps), np.int64)
    own[rows[home]] = shard[home]
    take = home | (shard < own[rows])
    return rows[take], shard[take], home[take]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of n nodes reaches over the links a-b."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    return root


def _leaf_links(fps: np.ndarray, leaf: np.ndarray, queries: np.ndarray, radius: int):
    """Links that join the leaf's fingerprints and the queries to all they are within reach of.

    A query needs one link to each group that the leaf's own links already join.
    """
    inner = _distance(fps[leaf][:, None], fps[leaf][None, :]) <= radius
    i, j = np.nonzero(np.triu(inner, 1))
    root = _roots(len(leaf), i, j)
    a, b = [leaf[i]], [leaf[j]]
    order = np.argsort(root, kind="stable")
    cuts = np.flatnonzero(np.diff(root[order], prepend=-1))
    for start in range(0, len(queries), _QUERIES):
        part = queries[start : start + _QUERIES]
        hits = _distance(fps[part][:, None], fps[leaf[order]][None, :]) <= radius
        q, group = np.nonzero(np.logical_or.reduceat(hits, cuts, axis=1))
        if len(q):
            first = np.array([int(np.argmax(hits[x, cuts[g] : (cuts[g + 1] if g + 1 < len(cuts) else None)])) for x, g in zip(q, group)])
            a.append(part[q])
            b.append(leaf[order[cuts[group] + first]])
    return np.concatenate(a), np.concatenate(b)


def forest(fps: np.ndarray, at_home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices) that join whatever is within the radius of a fingerprint at home.

    As many links as joined fingerprints at most, found by a vantage-point tree over those at
    home that is searched with all.
    """
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    todo = [(np.flatnonzero(at_home), np.arange(len(fps)))]
    while todo:
        here, queries = todo.pop()
        if not len(here) or not len(queries):
            continue
        bound = inside = None
        if len(here) > LEAF:
            point, bound = _vantage(fps[here])
            inside = _distance(fps[here], point) <= bound
        if inside is None or inside.all() or not inside.any():
            for start in range(0, len(here), LEAF):
                x, y = _leaf_links(fps, here[start : start + LEAF], queries, radius)
                a.append(x)
                b.append(y)
            continue
        d = _distance(fps[queries], point).astype(np.int64)
        todo.append((here[inside], queries[d - radius <= bound]))
        todo.append((here[~inside], queries[d + radius > bound]))
    root = _roots(len(fps), np.concatenate(a), np.concatenate(b))
    joined = np.flatnonzero(root != np.arange(len(fps)))
    return joined, root[joined]


def links(fps: DataFrame, radius: int = 4, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Links a-b between the distinct ``fingerprint`` values of ``fps`` whose components are
    those of all pairs at ``radius`` or fewer differing bits."""
    spark = fps.sparkSession
    n = fps.count()
    depth = max(LEAST_DEPTH, math.ceil(math.log2(max(1, n / shard))))
    chosen = fps.orderBy(F.xxhash64("fingerprint", F.lit(5))).limit(max(sample, 16 << depth)).collect()
    drawn = np.array([r["fingerprint"] for r in chosen], np.int64).view(np.uint64)
    tree = shard_tree(drawn, depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            rows, shards, home = routed(own.view(np.uint64), tree, depth, radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards.astype(np.int32)), pa.array(home), pa.array(own[rows])], ["shard", "home", "fp"]
            )

    def search(group: pa.Table) -> pa.Table:
        own = group.column("fp").to_numpy().view(np.uint64)
        joined, root = forest(own, group.column("home").to_numpy(), radius)
        return pa.table({"a": pa.array(_signed(own[joined])), "b": pa.array(_signed(own[root]))})

    dealt = common.importable(fps).select("fingerprint").mapInArrow(deal, "shard int, home boolean, fp bigint")
    return dealt.groupBy("shard").applyInArrow(search, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, radius: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints at ``radius`` or fewer differing bits are linked; component_id is the smallest
    doc_id among all rows reachable over links, the row itself included. Null and empty texts
    have fingerprint zero and are linked like any other. A null id keeps its row; it never is a
    component's id unless the component has no other. Other columns are not read; an empty
    table gives no rows.
    """
    prints = common.written(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = common.written(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints"
    )
    found = components(links(distinct, radius)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(found, "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"), F.col("root").isNotNull().alias("linked")
    )
    smallest = rooted.where("linked").groupBy("root").agg(F.min("least").alias("smallest"))
    owned = rooted.join(smallest, "root", "left").select(
        "fingerprint", F.coalesce("smallest", "least").alias("component_id")
    )
    return prints.join(owned, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_component(docs: DataFrame, radius: int = 4, words: int = 4) -> DataFrame:
    """``docs`` with the row of the smallest doc_id of each component, all columns unchanged.

    Repeated rows with that id all stay (exact duplicates are another stage's), rows without
    an id too.
    """
    found = near_duplicates(docs, radius, words)
    name = common.unused(docs, "dropped")
    dropped = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(dropped, common.column(docs, "doc_id") == F.col(name), "left_anti")
