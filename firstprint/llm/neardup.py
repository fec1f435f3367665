"""Near-duplicates by HyperMinHash.

A text's set holds the 64-bit hashes of its distinct five-word shingles. Each hash falls into one of BUCKETS buckets; a
bucket keeps its smallest hash as a 16-bit register: the number of leading zeros, and the MANTISSA bits after the first
one. Bands of ROWS registers (empty ones borrow from filled ones) are the keys under which texts meet. A pair
that meets is first measured on its registers, corrected for registers that agree by chance, then confirmed on the full
sets. At a similarity of 0.85 a pair fails to meet in any of the 32 bands four times in
10^6, at 0.9 once in 10^9.

Work never grows with the square of a group of copies:

* Texts with the same set form one class, found by an aggregate; only one text of a class goes further.
* In a band's group every member is compared with one pivot, and the components of those links are found.
* Groups whose members are not all in one component by then are cut into blocks of bounded weight. A task gets two blocks,
  compares members of different components, and joins components as it goes, so that it returns no more links than a
  forest has; comparisons inside what it has joined are left out.
* Components come from rounds of large-star and small-star over the links, each written to the shared folder. Groups are
  reduced by aggregates that add up before the shuffle, and joins on a hot group can be split by Spark.

Hashes of 64 bits stand for shingles, and digests of 128 bits for whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from firstprint.llm.caching import Remembered
from firstprint.llm.frames import frame
from firstprint.session import materialize

SHINGLE = 5
BANDS = 32
ROWS = 7
BUCKETS = BANDS * ROWS
MANTISSA = 10
# Six standard deviations of the register estimate at 0.85 lie within this.
ESTIMATE_SLACK = 0.2
BLOCK_ROWS = 256
BLOCK_WEIGHT = 200_000
# Rows that a task returns at a time.
SMALL = 500

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, a public-domain bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: Remembered, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text.

    Words are runs of characters other than ASCII white space, with A-Z in lower case, as bytes do both. A text of fewer
    words than `size` has one shingle, one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    count = len(codes) - width + 1
    value = np.full(count, width, np.uint64)
    for i in range(width):
        value = value * _MULTIPLIER + codes[i:i + count]
    return np.unique(_mix(value))


def registers(values: np.ndarray, buckets: int = BUCKETS, mantissa: int = MANTISSA) -> np.ndarray:
    """One 16-bit register per bucket; 0 where the bucket is empty."""
    scaled = (values >> np.uint64(32)) * np.uint64(buckets)
    bucket = (scaled >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # values are sorted, so the first of a bucket is its smallest
    rest = (scaled[first] & np.uint64(0xFFFFFFFF)).astype(np.float64)
    exponent = np.floor(np.log2(np.maximum(rest, 0.5)))  # -1 for nothing left
    zeros = 31 - exponent
    fraction = np.where(rest > 0, np.floor((rest / np.exp2(exponent) - 1) * (1 << mantissa)), 0)
    out = np.zeros(buckets, np.uint16)
    out[bucket[first]] = (zeros + 1).astype(np.uint16) * np.uint16(1 << mantissa) + fraction.astype(np.uint16)
    return out


@cache
def _turns(buckets: int) -> np.ndarray:
    """For every bucket, the order in which it would borrow from the others."""
    at = np.arange(buckets, dtype=np.uint64)
    return _mix(at[:, None] * np.uint64(buckets) + at[None, :] + np.uint64(1)).argsort(axis=1).argsort(axis=1)


def band_keys(regs: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band.

    An empty register borrows from the filled one that comes first in its own order. Each has another order, so the
    borrowed ones of two texts agree about as often as filled ones do, however few are filled.
    """
    dense = regs.copy()
    filled, empty = np.flatnonzero(regs), np.flatnonzero(regs == 0)
    if len(empty):
        dense[empty] = regs[filled[_turns(len(regs))[np.ix_(empty, filled)].argmin(axis=1)]]
    key = np.arange(bands, dtype=np.uint64)
    for column in dense.reshape(bands, -1).T:
        key = _mix(key * _MULTIPLIER + column)
    return key.view(np.int64)


@cache
def expected_agreement(log_a: int, log_b: int, buckets: int = BUCKETS, mantissa: int = MANTISSA) -> float:
    """Share of registers in which sets of 2^a and 2^b elements with nothing in common agree by chance.

    For each register value, the chance that the smallest of n elements in a bucket takes it, as in the paper of
    Yu and Weber on HyperMinHash.
    """
    zeros, fraction = np.meshgrid(np.arange(33), np.arange(1 << mantissa), indexing="ij")
    low = np.exp2(-zeros - 1.0) * (1 + fraction / (1 << mantissa)) / buckets
    high = np.exp2(-zeros - 1.0) * (1 + (fraction + 1) / (1 << mantissa)) / buckets
    takes = lambda n: np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-high))
    return float((takes(2.0 ** log_a) * takes(2.0 ** log_b)).sum())


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarities of register rows: agreeing registers over those filled in either, less the chance agreements."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    logs = np.round(np.log2(np.maximum(n_a, 1))).astype(int), np.round(np.log2(np.maximum(n_b, 1))).astype(int)
    chance = np.array([expected_agreement(min(x, y), max(x, y)) for x, y in zip(*logs)])
    return np.clip((same - chance * a.shape[1]) / np.maximum(either - chance * a.shape[1], 1e-9), 0, 1)


def _sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = Remembered(xxhash.xxh64_intdigest, most=50_000)
    for batch in batches:
        for at in range(0, len(batch), SMALL):
            part, rows = batch[at:at + SMALL], []
            for doc_id, text_hash, text in zip(part["doc_id"], part["text_hash"], part["text"]):
                values = shingle_set(text, hashes)
                if len(values):
                    regs = registers(values)
                    rows.append((doc_id, text_hash, len(values), xxhash.xxh3_128_digest(values.tobytes()), regs.tobytes(), band_keys(regs)))
                else:
                    rows.append((doc_id, text_hash, 0, None, None, None))
            yield frame("doc_id text_hash n node regs bands", rows)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = Remembered(xxhash.xxh64_intdigest, most=50_000)
    for batch in batches:
        for at in range(0, len(batch), SMALL):
            sets = [shingle_set(text, hashes) for text in batch["text"][at:at + SMALL]]
            yield frame("node members", ((xxhash.xxh3_128_digest(x.tobytes()), x.view(np.int64)) for x in sets))


@pandas_udf(DoubleType())
def estimated(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="float64")
    rows = lambda s: np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1)
    return pd.Series(estimate(rows(a), rows(b), n_a.to_numpy(), n_b.to_numpy()))


def _block_links(percent: int):
    """Links that join the components of a block of members: rows of (group, part, node, n, top, regs, members), by group."""
    def forest(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        parts, nodes, n, tops, regs, sets = zip(*rows)
        parts, n = np.array(parts), np.array(n)
        across = parts.min() != parts.max()
        _, top = np.unique(np.array(tops, object), return_inverse=True)
        if top.max() == 0:
            return []
        regs = np.frombuffer(b"".join(regs), np.uint16).reshape(len(rows), -1)
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        values, places = np.unique(np.concatenate(sets), return_inverse=True)
        mark, found = np.zeros(len(values), bool), []
        for i in range(len(rows)):
            may = (top != top[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
            others = np.flatnonzero(may & (parts != parts[i]) if across else may)
            if not len(others):
                continue
            likely = estimate(regs[others], regs[i][None, :], n[others], np.broadcast_to(n[i], len(others)))
            others = others[likely >= percent / 100 - ESTIMATE_SLACK]
            if not len(others):
                continue
            own = places[starts[i]:starts[i] + n[i]]
            mark[own] = True
            for j in others:
                shared = int(mark[places[starts[j]:starts[j] + n[j]]].sum())
                if 100 * shared >= percent * (n[i] + n[j] - shared) and top[j] != top[i]:
                    found.append((nodes[i], nodes[j]))
                    top[top == top[j]] = top[i]
            mark[own] = False
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, rows = None, []
        for batch in batches:
            found = []
            for key, *row in zip(*(batch[c] for c in ("group", "part", "node", "n", "top", "regs", "members"))):
                if key != group and rows:
                    found += forest(rows)
                    rows = []
                group = key
                rows.append(tuple(row))
            yield frame("a b", found)
        yield frame("a b", forest(rows) if rows else [])
    return run


def links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose similarity is at least `percent`, confirmed on the full sets."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("regs").alias(f"regs_{c}"))
    likely = pairs.join(side("a"), "a").join(side("b"), "b")
    likely = likely.where(estimated("regs_a", "regs_b", "n_a", "n_b") >= percent / 100 - ESTIMATE_SLACK)
    full = likely.select("a", "b", "n_a", "n_b").join(sets.select(F.col("node").alias("b"), F.col("members").alias("of_b")), "b")
    full = full.join(sets.select(F.col("node").alias("a"), F.col("members").alias("of_a")), "a")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return full.where(100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, top): the smallest node of the component of every node that has an edge.

    Large-star hangs every larger neighbour of a node on the smallest one, small-star every smaller neighbour and the
    node itself; when a round changes nothing, each component is a star around its smallest node. The number of rounds
    grows with the logarithm of the number of nodes, and each is written to the shared folder.
    """
    marks = lambda df: (F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("mark"))
    oriented = lambda df: df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    now, seen = materialize(oriented(edges.toDF("u", "v")), "links", *marks(edges))
    while seen["n"]:
        both = now.union(now.select("v", "u"))
        tops = both.groupBy("u").agg(F.min("v").alias("top")).select("u", F.least("u", "top").alias("top"))
        large = both.join(tops, "u").where("v > u").select(F.col("v").alias("u"), F.col("top").alias("v"))
        large, _ = materialize(oriented(large), "large-star")
        tops = large.groupBy("u").agg(F.min("v").alias("top"))
        small = large.join(tops, "u").where("v != top").select(F.col("v").alias("u"), F.col("top").alias("v"))
        small = small.union(tops.select("u", "top"))
        now, after = materialize(oriented(small), "small-star", *marks(small))
        if after == seen:
            break
        seen = after
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("top")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("top")).union(tops)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (the smallest doc_id it is linked with, itself included),
    and text_hash, which tells apart rows that share a doc_id.

    Two texts are linked if 100 * intersection >= percent * union of their sets. A null text, or one without words, has an
    empty set and is linked with nothing. Texts of any length are read whole. Rows that share a doc_id stand each for
    themselves; a repeated row gives a repeated result. A row with a null doc_id takes the component of its text, null if
    no row with an id is in it. Other columns are not read. An empty table gives no rows.
    """
    sketched = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInPandas(
        _sketched, "doc_id bigint, text_hash bigint, n int, node binary, regs binary, bands array<bigint>")
    rows, _ = materialize(sketched, "sketches")
    filled = rows.where("n > 0")
    classes = filled.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"),
                                         F.first("regs").alias("regs"), F.first("bands").alias("bands"))
    nodes, _ = materialize(classes, "classes")
    keys = nodes.select("node", "n", F.explode("bands").alias("key"))
    groups = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1")
    met, _ = materialize(keys.join(groups.select("key", "pivot"), "key"), "met")

    needed = met.select("node").distinct().join(nodes.select("node", "least"), "node")
    texts = docs.select("doc_id", "text")
    texts = texts.join(needed.selectExpr("least as doc_id"), "doc_id", "left_semi").union(texts.where("doc_id is null"))
    found = texts.mapInPandas(_sets, "node binary, members array<bigint>").join(needed.select("node"), "node", "left_semi")
    sets, _ = materialize(found.groupBy("node").agg(F.first("members").alias("members")), "sets")

    spokes = met.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    first, _ = materialize(links(spokes, nodes, sets, percent), "links-to-pivots")
    labelled = met.join(components(first), "node", "left").select("key", "pivot", "node", "n", F.coalesce("top", "node").alias("top"))
    labelled, _ = materialize(labelled, "labelled")
    still = labelled.groupBy("key").agg(F.min("top").alias("low"), F.max("top").alias("high"),
                                        F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight")).where("low != high")
    pieces = F.greatest(F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("weight") / BLOCK_WEIGHT)).cast("int")
    blocks = labelled.where("node != pivot").join(still.select("key", pieces.alias("pieces")), "key")
    blocks = blocks.withColumn("part", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    blocks = blocks.select(F.concat_ws(" ", "key", F.least("part", "other"), F.greatest("part", "other")).alias("group"),
                           "part", "node", "n", "top")
    blocks = blocks.join(nodes.select("node", "regs"), "node").join(sets, "node")
    blocks = blocks.repartition("group").sortWithinPartitions("group", "node")
    second = blocks.mapInPandas(_block_links(percent), "a binary, b binary").distinct()

    tops, _ = materialize(components(first.union(second)), "components")
    lowest = tops.join(nodes, "node").groupBy("top").agg(F.min("least").alias("component_id"))
    named = tops.join(lowest, "top").select("node", "component_id")
    named = nodes.join(named, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(named, "node", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "text_hash")
