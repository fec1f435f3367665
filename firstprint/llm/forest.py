"""Nearest neighbours by cosine: a forest of random-projection trees, searched best first, and exact reranking.

A tree splits the unit vectors at random hyperplanes, each at the median of the sampled rows that reach it. A bounded sample
is all the forest is fitted on; every row is then sent down every tree and belongs to one leaf of each.

A query's search puts the leaves of all trees into one order: by the chance that a neighbour as near as the query's k-th best
in the sample lies there. Seen from the centre of the rows, a neighbour's projection is the query's, scaled by their cosine,
and some noise. Leaves are read, the most likely first, until the chance that no tree has led to such a neighbour is below a
limit. How wide the noise is taken and how low that limit must be depends on the rows, so it is measured: some queries are
compared with every row, and the setting that reads least is used of those that miss at most `missed` of their true
neighbours. There is no cap on leaves. A query that would read as many leaves as a tree has reads all of one tree, which is
every row. All rows of the leaves read are scored exactly, in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from firstprint.llm.vectors import made, matrix, meet, sample, sound_rows
from firstprint.session import materialize

TREES, LEAF_ROWS, DEEPEST, SAMPLE_PER_LEAF, BLOCK_LEAVES, MISSED = 8, 64, 14, 8, 64, 0.02
WIDTHS = (0.5, 1.0, 2.0, 4.0, 8.0)  # of the noise, as a multiple of what the sample shows
LIMITS = (0.2, 0.1, 0.05, 0.02, 0.01, 3e-3, 1e-3, 1e-4, 1e-6, 1e-9, 1e-15, 1e-24, 1e-48, 0.0)  # 0: every row
MEASURED = 256  # queries compared with every row
NEAR = 1e-9  # scores this close are told apart by the exact measure


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosines(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row, in the same order of additions whatever rows stand beside them."""
    lengths = np.sqrt((one * one).sum(axis=1)) * np.sqrt((other * other).sum(axis=1))
    direct = (one * other).sum(axis=1)
    plain = np.isfinite(direct) & np.isfinite(lengths) & (lengths > 1e-280)
    if plain.all():
        return direct / lengths
    return np.where(plain, direct / np.where(plain, lengths, 1), (units(one) * units(other)).sum(axis=1))


class Forest(NamedTuple):
    """Complete trees of one depth: node n has the children 2n + 1 (below its threshold) and 2n + 2."""
    planes: np.ndarray  # tree, node, dimension
    thresholds: np.ndarray  # tree, node
    spreads: np.ndarray  # tree, level: how far projections lie from the centre's, for rows at distance 1 from it
    centre: np.ndarray  # dimension
    offsets: np.ndarray  # tree, node: thresholds as seen from the centre

    @property
    def depth(self) -> int:
        return self.spreads.shape[1]

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every unit vector in every tree: row, tree."""
        found = np.zeros((len(rows), len(self.planes)), np.int64)
        for tree, (planes, thresholds) in enumerate(zip(self.planes, self.thresholds)):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", rows, planes[node]) >= thresholds[node])
            found[:, tree] = node - (2 ** self.depth - 1)
        return found

    def costs(self, queries: np.ndarray, cosines: np.ndarray, width: float = 1.0) -> np.ndarray:
        """Minus the logarithm of the chance that a neighbour of each query, of this cosine, lies in a leaf: query, tree * leaf."""
        trees, nodes, size = self.planes.shape
        away = queries - self.centre
        radius = np.maximum(np.linalg.norm(away, axis=1), 1e-6)
        apart = np.maximum(1 - cosines, 1e-9)
        scale = np.clip(1 - apart / radius ** 2, 0.05, 1 - 1e-9)  # the cosine as seen from the centre
        noise = width * np.sqrt(np.maximum(2 * apart - ((1 - scale) * radius) ** 2, 1e-12))
        level = np.floor(np.log2(np.arange(1, nodes + 1))).astype(int)
        beyond = (scale[:, None] * away).astype(np.float32) @ self.planes.reshape(-1, size).T - self.offsets.ravel()
        beyond = (1.702 * beyond / (self.spreads[:, level].ravel() * noise[:, None])).reshape(len(queries), trees, nodes)  # the normal curve, nearly
        below = np.logaddexp(0, beyond)
        found = np.zeros((len(queries), trees, 1))
        for at in range(self.depth):
            here = slice(2 ** at - 1, 2 ** (at + 1) - 1)
            found = np.stack([found + below[:, :, here], found + below[:, :, here] - beyond[:, :, here]], axis=3).reshape(len(queries), trees, -1)
        return found.reshape(len(queries), -1)

    def ordered(self, costs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The `most` likeliest leaves of one query, as tree * leaf, and the chance to have missed a neighbour before each is read."""
        some = np.argpartition(costs, most)[:most] if most < len(costs) else np.arange(len(costs))
        some = some[np.lexsort((some, costs[some]))]
        gained = np.zeros((len(some), len(self.planes)))
        gained[np.arange(len(some)), some >> self.depth] = np.exp(-costs[some])
        missed = np.exp(np.log(np.maximum(1 - np.cumsum(gained, axis=0), 1e-12)).sum(axis=1))
        return some, np.r_[1.0, missed[:-1]]

    def likeliest(self, costs: np.ndarray, missed: float) -> np.ndarray:
        """The leaves of one query, as tree * leaf, read until a neighbour is missed with that chance."""
        most = 512
        while True:
            leaves, before = self.ordered(costs, most)
            if before[-1] <= missed or most >= len(costs):
                return leaves[:np.searchsorted(-before, -missed)]
            most *= 4

    def search(self, query: np.ndarray, cosine: float, missed: float = MISSED, width: float = 1.0) -> list[list[int]]:
        """The leaves of each tree that a neighbour of this cosine may lie in, read until it is missed with that chance."""
        leaves = self.likeliest(self.costs(query[None], np.array([cosine]), width)[0], missed)
        return [(leaves[leaves >> self.depth == tree] & (2 ** self.depth - 1)).tolist() for tree in range(len(self.planes))]


def fit(rows: np.ndarray, depth: int, trees: int = TREES, seed: int = 11) -> Forest:
    """A forest from sampled unit vectors."""
    random, nodes = np.random.default_rng(seed), 2 ** depth - 1
    planes = random.standard_normal((trees, nodes, rows.shape[1])).astype(np.float32)
    planes /= np.maximum(np.linalg.norm(planes, axis=2, keepdims=True), 1e-30)
    thresholds, spreads = np.zeros((trees, nodes)), np.ones((trees, depth))
    centre = rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])
    radius = max(np.sqrt(np.mean(((rows - centre) ** 2).sum(axis=1))), 1e-6) if len(rows) else 1.0
    at_centre = planes @ centre
    for tree in range(trees):
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            seen = np.einsum("ij,ij->i", rows, planes[tree][node])
            off = seen - at_centre[tree, node]
            spreads[tree, level] = max(np.sqrt(np.mean(off * off)) / radius, 1e-6) if len(rows) else 1.0
            order = np.lexsort((seen, node))
            starts = np.flatnonzero(np.r_[True, np.diff(node[order]) > 0]) if len(rows) else np.empty(0, int)
            ends = np.r_[starts[1:], len(rows)]
            thresholds[tree, node[order][starts]] = seen[order][(starts + ends) // 2] if len(rows) else 0
            node = 2 * node + 1 + (seen >= thresholds[tree][node])
    return Forest(planes, thresholds, spreads, centre, thresholds - at_centre)


def reranking(k: int) -> Callable:
    """Answers with the k rows of a block nearest to each query, of the leaves that it reads; note: leaf bits and bound."""
    def hold(ids: np.ndarray, leaves: np.ndarray, vectors: np.ndarray) -> Callable:
        rows, place = units(vectors), (leaves % BLOCK_LEAVES).astype(np.uint64)

        def answer(asked, _, queries, notes) -> list[tuple]:
            found, wanted = [], units(queries)
            bits, bounds = matrix(notes, np.int64).T
            for begin in range(0, len(asked), 256):
                part = slice(begin, begin + 256)
                score = wanted[part] @ rows.T
                read = (bits[part].astype(np.uint64)[:, None] >> place[None, :]) & np.uint64(1)
                score[(read == 0) | (asked[part][:, None] == ids[None, :])] = -2
                least = bounds[part] / ALL_OF
                if len(ids) > k:
                    least = np.maximum(least, np.partition(score, -k, axis=1)[:, -k])
                query, row = np.nonzero((score > -2) & (score >= least[:, None] - NEAR))
                exact = cosines(queries[part][query], vectors[row])
                order = np.lexsort((ids[row], -exact, query))
                query, row, exact = query[order], row[order], exact[order]
                nth = np.arange(len(query)) - np.searchsorted(query, query)
                found += [(q, r, s) for q, r, s in zip(asked[part][query[nth < k]].tolist(), ids[row[nth < k]].tolist(), exact[nth < k].tolist())]
            return found
        return answer
    return hold


ALL_OF = 1 << 40  # bounds travel as whole numbers, rounded down


def in_sample(given: np.ndarray, me: int, guess: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Ids and scores of the k sampled rows nearest to a query, by rough scores first, and the k-th score (-1 if there are fewer)."""
    top = np.argsort(-guess, kind="stable")[:4 * k]
    top = top[ids[top] != me]
    exact = cosines(np.broadcast_to(given, vectors[top].shape), vectors[top]) if len(top) else np.zeros(0)
    order = np.lexsort((ids[top], -exact))[:k]
    return ids[top][order], exact[order], exact[order[-1]] if len(order) == k else -1.0


def setting(points: DataFrame, some: pa.Table, shared, k: int, missed: float) -> tuple[float, float]:
    """The width and the limit that read least, of those that miss at most the share `missed` of the true neighbours of `some` rows.

    The true neighbours come from a scan of all `points`; each task hands on its k nearest to each of `some`. The share holds
    with a margin of two standard deviations of the number missed. With too few neighbours to tell, and if nothing less
    suffices, the limit is 0: every row is read.
    """
    if not len(some):
        return 1.0, 0.0
    spark, asked, given = points.sparkSession, some["id"].to_numpy(), matrix(pa.concat_arrays(some["v"].chunks))
    wanted = units(given)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, who, rows = np.full((len(asked), k), -2.0), np.full((len(asked), k), -1), np.zeros((len(asked), k, wanted.shape[1]))
        for batch in batches:
            ids, held = batch.column("id").to_numpy(), units(matrix(batch.column("v"))) if len(batch) else wanted[:0]
            for begin in range(0, len(ids), 8192):
                part = slice(begin, begin + 8192)
                score = wanted @ held[part].T
                score[asked[:, None] == ids[part][None, :]] = -2
                for q in np.flatnonzero(score.max(axis=1) > best[:, -1]):
                    near = np.argpartition(score[q], -k)[-k:] if score.shape[1] > k else np.arange(score.shape[1])
                    all_scores, all_ids = np.r_[best[q], score[q][near]], np.r_[who[q], ids[part][near]]
                    order = np.lexsort((all_ids, -all_scores))[:k]
                    best[q], who[q], rows[q] = all_scores[order], all_ids[order], np.concatenate([rows[q], held[part][near]])[order]
        q, nth = np.nonzero(best > -2)
        if len(q):
            leaves = shared.value[0].leaves(rows[q, nth])
            yield from made("q bigint, score double, id bigint, leaves array<bigint>",
                            list(zip(q.tolist(), best[q, nth].tolist(), who[q, nth].tolist(), leaves.tolist())))

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, ids, vectors, held = shared.value
        whole = 2 ** forest.depth
        for batch in batches:
            out = []
            for q, true in zip(batch.column("q").to_pylist(), batch.column("near").to_pylist()):
                seeds, _, bound = in_sample(given[q], asked[q], wanted[q].astype(np.float32) @ held.T, ids, vectors, k)
                places = np.array([t["leaves"] for t in true]) + np.arange(len(forest.planes)) * whole
                known = np.isin([t["id"] for t in true], seeds)
                for w, width in enumerate(WIDTHS):
                    leaves, before = forest.ordered(forest.costs(wanted[q:q + 1], np.array([bound]), width)[0], len(forest.planes) * whole)
                    at = np.empty(len(leaves), np.int64)
                    at[leaves] = np.arange(len(leaves))
                    reached = np.where(known, -1, at[places].min(axis=1))
                    for m, limit in enumerate(LIMITS):
                        read = int(np.searchsorted(-before, -limit)) if limit else len(leaves)
                        found = len(true) if read >= whole else int((reached < read).sum())
                        out.append((w, m, len(true), found, min(read, whole)))
            yield from made("width bigint, missed bigint, pairs bigint, found bigint, cost bigint", out)

    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    true = points.select("id", "v").mapInArrow(scanned, "q bigint, score double, id bigint, leaves array<bigint>")
    true = true.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
    true = true.groupBy("q").agg(F.collect_list(F.struct("id", "leaves")).alias("near")).repartition(min(16, len(asked)), "q")
    seen = true.mapInArrow(tried, "width bigint, missed bigint, pairs bigint, found bigint, cost bigint")
    seen = seen.groupBy("width", "missed").agg(*[F.sum(c).alias(c) for c in ("pairs", "found", "cost")]).collect()
    lost = [(r["pairs"] - r["found"], r) for r in seen]
    good = [(r["cost"], n, r["width"], r["missed"]) for n, r in lost if n + 2 * np.sqrt(n + 1) <= missed * r["pairs"]]
    if not good:
        return 1.0, 0.0
    _, _, width, limit = min(good)
    return WIDTHS[width], LIMITS[limit]


def nearest(table: DataFrame, queries: Callable[[Column], Column], k: int = 5, identity: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, leaf_rows: int = LEAF_ROWS, deepest: int = DEEPEST, missed: float = MISSED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, by cosine in double precision.

    `queries` says of an id whether its row is a query; candidates are all rows but the query's own. The nearest come
    first, ties by smaller id; all candidates are returned if there are fewer than k. The forest is fitted on about
    8 rows a leaf, at most 8 * 2^`deepest`, chosen by a hash of the id, and holds every row. At most the share `missed` of
    the k nearest is missed by 256 queries, chosen by a hash as well, that are compared with every row.

    Vectors of zeros and the rows that sound_rows() leaves out take no part; an id counts once. Of equal vectors only the
    k + 1 with the smallest ids can be among the nearest, so only they are indexed: a vector that comes very often fills no
    leaf. An empty table, or a single row, gives no rows; other columns are not read.
    """
    single = sound_rows(table, identity, vector).where(F.exists("v", lambda x: x != 0))
    copies = Window.partitionBy("v").orderBy("id")
    points = single.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1).drop("nth")
    points, seen = materialize(points, "points", F.count(F.lit(1)).alias("n"))
    n = seen["n"]
    depth = min(max(int(np.ceil(np.log2(max(n, 1) / leaf_rows))), 0), deepest)
    known = sample(points, n, SAMPLE_PER_LEAF * 2 ** depth)
    ids = known["id"].to_numpy()
    vectors = matrix(pa.concat_arrays(known["v"].chunks)) if len(ids) else np.zeros((0, 1))
    held = units(vectors) if len(ids) else vectors
    forest = fit(held, depth, trees)
    spark = table.sparkSession
    shared = spark.sparkContext.broadcast((forest, ids, vectors.astype(np.float64), held.astype(np.float32)))
    by_hash = F.xxhash64("id", F.lit("measured"))
    some = points.where(queries(F.col("id"))).orderBy(by_hash, "id").limit(MEASURED).toArrow().combine_chunks()
    width, limit = setting(points, some, shared, k, missed)
    whole = 2 ** depth
    blocks = max(1, whole // BLOCK_LEAVES)
    parts = max(1, -(-n // (2 ** depth * 2 * leaf_rows)))  # a leaf of the deepest trees may outgrow a block

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                of = shared.value[0].leaves(units(matrix(batch.column("v"))))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(list(of), pa.list_(pa.int64()))], ["id", "v", "leaves"])

    block = (F.col("tree") * blocks + F.floor(F.col("tag") / BLOCK_LEAVES)) * parts
    no_note = F.array().cast("array<bigint>").alias("note")
    rows = points.mapInArrow(routed, "id bigint, v array<double>, leaves array<bigint>").select(
        "id", "v", F.posexplode("leaves").alias("tree", "tag"), no_note)
    if not limit:  # every query reads all of the first tree
        rows = rows.where("tree = 0")
    rows = rows.withColumn("block", (block + F.pmod(F.xxhash64("id"), F.lit(parts))).cast("bigint"))
    kinds = "id bigint, v array<double>, blocks array<bigint>, bits array<bigint>, bound bigint, seed_ids array<bigint>, seed_scores array<double>"

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, ids, vectors, held = shared.value
        for batch in batches:
            if not len(batch):
                continue
            given = matrix(batch.column("v"))
            out, wanted = [], units(given)
            step = min(256, max(1, 2 ** 20 // (trees * whole)))
            for begin in range(0, len(batch), step):
                part = range(begin, min(begin + step, len(batch)))
                guesses = wanted[part.start:part.stop].astype(np.float32) @ held.T if len(ids) else np.zeros((step, 0))
                tops = [in_sample(given[i], batch.column("id")[i].as_py(), guess, ids, vectors, k) for i, guess in zip(part, guesses)]
                costs = forest.costs(wanted[part.start:part.stop], np.array([bound for _, _, bound in tops]), width) if limit else [None] * len(part)
                for i, (seed_ids, seed_scores, bound), cost in zip(part, tops, costs):
                    read = forest.likeliest(cost, limit) if limit else range(whole)
                    if len(read) >= whole:  # all rows, once
                        masks = dict.fromkeys(range(blocks), (1 << min(whole, BLOCK_LEAVES)) - 1)
                    else:
                        masks = {}
                        for place in read.tolist():
                            tree, leaf = divmod(place, whole)
                            key = tree * blocks + leaf // BLOCK_LEAVES
                            masks[key] = masks.get(key, 0) | 1 << leaf % BLOCK_LEAVES
                    signed = [m - (1 << 64) if m >> 63 else m for m in masks.values()]
                    me = batch.column("id")[i].as_py()
                    out.append((me, given[i], list(masks), signed, int(np.floor(bound * ALL_OF)), seed_ids, seed_scores))
            yield from made(kinds, out)

    asked = single.where(queries(F.col("id"))).repartition(F.col("id")).mapInArrow(searched, kinds)
    asked, _ = materialize(asked, "searched")
    probes = asked.select("id", "v", "bound", F.inline(F.arrays_zip("blocks", "bits"))).select(
        "id", F.lit(0).cast("bigint").alias("tag"), "v", F.array("bits", "bound").alias("note"), F.col("blocks").alias("first"))
    probes = probes.withColumn("block", F.explode(F.sequence(F.col("first") * parts, F.col("first") * parts + parts - 1)))
    near = meet(rows.withColumn("tag", F.col("tag").cast("bigint")), probes, reranking(k), "query_id bigint, vec_id bigint, score double")
    seeds = asked.select(F.col("id").alias("query_id"), F.inline(F.arrays_zip("seed_ids", "seed_scores"))).toDF("query_id", "vec_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    each = near.unionByName(seeds).repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
