"""Hard negatives by coordinate pruning in buckets of like length.

Rows are put into buckets by the length of their vector. A question (an anchor with the smallest score that still matters)
skips the buckets whose longest vector is too short to reach that score. In a bucket the score asks for an angle; that angle
leaves a feasible range of values for every coordinate, and the anchor's largest coordinates, the focus, have the narrowest
ones. The bucket keeps its rows in lists sorted by coordinate: the range of one focus coordinate is a run of its list, the
others cut it down, and only what is left is scored exactly, in whole numbers.

The smallest score that matters is taken from a bounded sample of the rows. It is a bound that real rows reach, so no answer
depends on the sample: it only decides how much is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from firstprint.llm.vectors import made, matrix, meet, sample, sound_rows
from firstprint.session import materialize

SAMPLE_ROWS, BLOCK_ROWS, LENGTH_BUCKETS, FOCUS = 8_192, 4_096, 16, 5
LEAST, MOST, EXACT = -(1 << 63), (1 << 63) - 1, 1 << 53


def scores(rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Whole inner products, exact whatever their size; beyond 64 bits the nearest 64-bit number."""
    if not len(rows) or np.abs(rows).max() * np.abs(asked).max() * rows.shape[-1] < EXACT:
        return (rows @ asked).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(row, asked)) for row in rows]
    return np.array([min(max(s, LEAST), MOST) for s in whole], np.int64)


def feasible(unit: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The range of every coordinate of unit vectors within the angle of `cosine` around a unit vector."""
    angle, own = np.arccos(np.clip(cosine, -1, 1)), np.arccos(np.clip(unit, -1, 1))
    return np.cos(np.minimum(own + angle, np.pi)) - 1e-9, np.cos(np.maximum(own - angle, 0)) + 1e-9


class Bucket:
    """Rows of like length with their sorted coordinate lists."""

    def __init__(self, vectors: np.ndarray, focus: int = FOCUS):
        self.vectors, self.focus = vectors, focus
        lengths = np.linalg.norm(vectors, axis=1)
        self.longest, self.shortest = lengths.max(), lengths.min()
        self.unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        if coordinate not in self.lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self.lists[coordinate] = order, self.unit[order, coordinate]
        return self.lists[coordinate]

    def candidates(self, asked: np.ndarray, least: int) -> np.ndarray:
        """The places of all rows that can have a score of `least` or more."""
        length = np.linalg.norm(asked)
        everyone = np.arange(len(self.vectors))
        if least <= 0 or length == 0 or not length * self.longest < np.inf:  # half the space or more: nothing to skip
            return everyone
        cosine = least / (length * self.longest) * (1 - 1e-9)
        if cosine > 1:
            return everyone[:0]
        low, high = feasible(asked / length, cosine)
        focus = np.argsort(-np.abs(asked), kind="stable")[:self.focus]
        runs = [np.searchsorted(self.sorted_list(f)[1], (low[f], high[f] + 1e-12)) for f in focus]
        first = min(range(len(focus)), key=lambda k: runs[k][1] - runs[k][0])
        found = self.sorted_list(focus[first])[0][slice(*runs[first])]
        for k, f in enumerate(focus):
            if k != first and runs[k][1] - runs[k][0] < len(everyone):
                values = self.unit[found, f]
                found = found[(values >= low[f]) & (values <= high[f])]
        return found


def best(place: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The n of `place` with the highest scores, ties by smaller id; an argument for `score`, highest first."""
    if len(score) > 4 * n:
        place = place[score[place] >= np.partition(score[place], -n)[-n]] if len(place) > n else place
    return place[np.lexsort((ids[place], -score[place]))][:n]


def like(n: int) -> Callable:
    """Answers with the n best other rows of the anchor's label; the note is the smallest score that matters."""
    def hold(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Callable:
        bucket = Bucket(vectors)

        def answer(anchors, own, asked, notes) -> list[tuple]:
            rows = []
            for anchor, label, vector, (least,) in zip(anchors.tolist(), own, asked, notes.to_pylist()):
                place = bucket.candidates(vector, least)
                place = place[(labels[place] == label) & (ids[place] != anchor)]
                score = scores(bucket.vectors[place], vector)
                top = best(np.flatnonzero(score >= least), score, ids[place], n)
                rows += [(anchor, i, s) for i, s in zip(ids[place[top]].tolist(), score[top].tolist())]
            return rows
        return answer
    return hold


def unlike(n: int) -> Callable:
    """Answers, for each window, with the n best rows of other labels; the note is (positive, its score, least, most) again and again."""
    def hold(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Callable:
        bucket = Bucket(vectors)

        def answer(anchors, own, asked, notes) -> list[tuple]:
            rows = []
            for anchor, label, vector, note in zip(anchors.tolist(), own, asked, notes.to_pylist()):
                windows = list(zip(note[::4], note[1::4], note[2::4], note[3::4]))
                place = bucket.candidates(vector, min(w[2] for w in windows))
                place = place[labels[place] != label]
                score = scores(bucket.vectors[place], vector)
                for positive, positive_score, least, most in windows:
                    top = best(np.flatnonzero((score >= least) & (score <= most)), score, ids[place], n)
                    rows += [(anchor, positive, positive_score, i, s) for i, s in zip(ids[place[top]].tolist(), score[top].tolist())]
            return rows
        return answer
    return hold


def nth_highest(score: np.ndarray, n: int, otherwise: int) -> int:
    return int(np.partition(score, -n)[-n]) if len(score) >= n else otherwise


def hard_negatives(table: DataFrame, anchor: Callable[[Column], Column], identity: str = "vec_id", vector: str = "embedding",
                   label: Column | str = "label", positives: int = 5, negatives: int = 3, least_percent: int = 50,
                   most_percent: int = 95, scale: float = 256.0, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS,
                   ) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hardest negatives of each positive.

    Every component x becomes floor(scale * x) and a score is the inner product of two such rows; higher scores come first,
    then smaller ids. `anchor` says of an id whether its row is an anchor. Its positives are the best `positives` other rows
    of its label (all, if fewer). A positive's negatives are the best `negatives` rows of other labels whose score is at
    least `least_percent` and at most `most_percent` per cent of the positive's, so a positive below zero has none.

    Rows with a null label and those that sound_rows() leaves out take no part; an id counts once; ties go to the smaller
    id; scores beyond 64 bits count as the largest or smallest 64-bit number; an empty table, and one with a single label,
    gives no rows; other columns are not read.
    """
    labels = (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("tag")
    rows = sound_rows(table.where(labels.isNotNull()), identity, vector, labels, value=lambda x: whole(x, scale))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    rows, seen = materialize(rows.withColumn("length", length), "whole-vectors", F.count(F.lit(1)).alias("n"))
    buckets = max(1, min(LENGTH_BUCKETS, seen["n"] // block_rows))
    cuts = rows.agg(F.percentile_approx("length", [k / buckets for k in range(1, buckets)] or [0.5], 1000).alias("cuts")).first()["cuts"]
    above = F.array(*[F.lit(float(c)) for c in (cuts if buckets > 1 and cuts else [])]).cast("array<double>")
    bucketed = rows.withColumn("bucket", F.size(F.filter(above, lambda c: c < F.col("length"))))
    sizes = {r["bucket"]: (r["n"], r["longest"])  # a row per bucket
             for r in bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest")).collect()}
    blocks, firsts, longest, total = [0] * buckets, [0] * buckets, [0.0] * buckets, 0
    for b, (n, most) in sorted(sizes.items()):
        blocks[b], firsts[b], longest[b] = -(-n // block_rows), total, most
        total += blocks[b]
    of = lambda values, kind: F.array(*[F.lit(x) for x in values]).cast(f"array<{kind}>")
    nothing = F.array().cast("array<bigint>")
    dealt = bucketed.withColumn("block", of(firsts, "bigint")[F.col("bucket")] + F.expr("pmod(xxhash64(id), " + "case bucket " + " ".join(
        f"when {b} then {max(n, 1)}" for b, n in enumerate(blocks)) + " end)")).withColumn("note", nothing)
    known = sample(rows.select("id", "tag", "v"), seen["n"], sample_rows)
    ids, tags = known["id"].to_numpy(), known["tag"].to_numpy()
    held = matrix(pa.concat_arrays(known["v"].chunks)) if len(ids) else np.zeros((0, 1))
    reach = np.array(longest) * (1 + 1e-9)
    kinds = "id bigint, tag bigint, v array<double>, note array<bigint>, buckets array<bigint>"

    def asking(note: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                asked, out = matrix(batch.column("v")), []
                for k, row in enumerate(batch.drop_columns(["v"]).to_pylist()):
                    least, found = note(row, scores(held, asked[k]) if len(held) else np.zeros(0, np.int64))
                    if found:
                        size = np.linalg.norm(asked[k])
                        out.append((row["id"], row["tag"], asked[k], found,
                                    [b for b in range(buckets) if blocks[b] and (least <= 0 or not size * reach[b] < least)]))
                yield from made(kinds, out)
        return run

    def questions(asked: DataFrame, note: Callable) -> DataFrame:
        each = asked.mapInArrow(asking(note), kinds).withColumn("bucket", F.explode("buckets"))
        numbers = F.sequence(of(firsts, "bigint")[F.col("bucket")], (of(firsts, "bigint")[F.col("bucket")] + of(blocks, "bigint")[F.col("bucket")]) - 1)
        return each.withColumn("block", F.explode(numbers))

    def nearest(row, score):
        least = nth_highest(score[(tags == row["tag"]) & (ids != row["id"])], positives, LEAST)
        return least, [least]

    anchors = rows.where(anchor(F.col("id"))).select("id", "tag", "v")
    found = meet(dealt, questions(anchors, nearest), like(positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found, _ = materialize(found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives).drop("nth"), "positives")

    def window(row, score):
        other, note = score[tags != row["tag"]], []
        for positive, reached in row["found"]:
            low, high = -(-reached * least_percent // 100), reached * most_percent // 100
            if low <= high:
                inside = other[(other >= low) & (other <= high)]
                note += [positive, reached, nth_highest(inside, negatives, low), high]
        return min(note[2::4], default=0), note

    each = found.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.array("positive_id", "positive_score"))).alias("found"))
    harder = meet(dealt, questions(anchors.join(each, "id"), window), unlike(negatives),
                  "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return harder.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def whole(x: Column, scale: float) -> Column:
    """floor(scale * x) as a double; numbers too large for a bigint are whole already."""
    scaled = x * scale
    return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)
