"""Pack token sequences into windows by non-negative least squares over length combinations.

Documents are cut into full windows and one rest. The lengths of the pieces are counted in bins of STEP tokens. Every
combination of at most DEPTH bins that fills a window is a column of a matrix, and non-negative least squares finds how
often to use each so that together they use up the histogram. The repeat counts are rounded and limited to what is there,
and the few pieces left over are packed greedily, largest first, again as combinations with counts.

All of that happens on the histogram, which has WINDOW / STEP numbers however large the corpus is. The result is a list of
slots: the pieces ranked s to s + n of bin b take place j of the sequences q to q + n. So each piece finds its sequence
from its rank within its bin alone. Ranks come from counts of (bin, shard) groups: a bin that holds a third of all rows is
spread over SHARDS groups.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from firstprint.llm.caching import RememberedOften
from firstprint.llm.frames import frame
from firstprint.session import materialize

WINDOW = 2048
STEP = 8
DEPTH = 3
SHARDS = 1024
END_ID = 1
WORDS, PIECES = 400_000, 300_000  # remembered by each Python worker: about 130 MB when full


def combinations(total: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Every way to write `total` as a sum of at most `depth` positive whole numbers, smallest first."""
    found = [(total,)] if depth else []
    for n in range(2, depth + 1):
        for head in combinations_with_replacement(range(1, total // 2 + 1), n - 1):
            last = total - sum(head)
            if last >= head[-1]:
                found.append((*head, last))
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, inside = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, np.abs(b).max(initial=0.0)) * a.shape[0]
    for _ in range(rounds or 3 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[inside] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tolerance:
            break
        inside[best] = True
        while True:
            at = np.flatnonzero(inside)
            part = a[:, at]
            trial = np.linalg.solve(part.T @ part + 1e-12 * np.eye(len(at)), part.T @ b)
            if (trial > 0).all():
                x[:] = 0
                x[at] = trial
                break
            low = trial <= 0
            step = np.min(x[at][low] / np.maximum(x[at][low] - trial[low], 1e-300))
            x[at] += step * (trial - x[at])
            gone = at[low & (x[at] <= 1e-12)] if (low & (x[at] <= 1e-12)).any() else at[low][:1]
            inside[gone], x[gone] = False, 0.0
            if not inside.any():
                break
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(combination of bins, repeats) that use up the histogram exactly; histogram[i] counts the pieces of bin i + 1."""
    total, left = len(histogram), histogram.astype(np.int64).copy()
    if not left.any():
        return []
    ways = combinations(total, depth)
    a = np.zeros((total, len(ways)))
    for column, way in enumerate(ways):
        for size in way:
            a[size - 1, column] += 1
    solved = nnls(a, left / left.max()) * left.max()
    made: list[tuple[tuple[int, ...], int]] = []
    for column in np.argsort(-solved, kind="stable"):
        if solved[column] < 0.5:
            break
        used = a[:, column].astype(np.int64)
        n = min(int(round(solved[column])), int((left[used > 0] // used[used > 0]).min()))
        if n > 0:
            made.append((ways[column][::-1], n))
            left -= n * used
    while left.any():  # each round uses up one bin at least
        way, room, spare = [], total, left.copy()
        while room > 0 and spare[:room].any():
            size = int(np.flatnonzero(spare[:room])[-1]) + 1
            take = min(room // size, int(spare[size - 1]))
            way += [size] * take
            spare[size - 1] -= take
            room -= take * size
        used = np.bincount(np.array(way) - 1, minlength=total)
        n = int((left[used > 0] // used[used > 0]).min())
        made.append((tuple(way), n))
        left -= n * used
    return made


def slots(made: list[tuple[tuple[int, ...], int]], bins: int) -> dict[str, np.ndarray]:
    """The slots of a plan, ordered by bin and first rank."""
    rows, taken, sequence = [], np.zeros(bins + 1, np.int64), 0
    for way, n in made:
        for place, size in enumerate(way):
            rows.append((size, taken[size], sequence, place))
            taken[size] += n
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"bin": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "place": table[:, 3]}


def pack(pieces: DataFrame, window: int = WINDOW, step: int = STEP, depth: int = DEPTH, shards: int = SHARDS) -> DataFrame:
    """`pieces` (doc_id, start, length and any further columns) with sequence_id and offset.

    A piece has 1 to `window` tokens. `pieces` should be a stored table: it is read twice. Offsets in a sequence run from
    0 without gaps, and no sequence is longer than `window`. An empty table gives no rows.
    """
    bins = window // step
    carried = F.struct("*").alias("piece")
    keyed = pieces.select(F.ceil(F.col("length") / step).cast("int").alias("bin"),
                          F.pmod(F.xxhash64("doc_id", "start"), F.lit(shards)).alias("shard"), carried)
    counts = keyed.groupBy("bin", "shard").agg(F.count(F.lit(1)).alias("n"))
    counts, _ = materialize(counts, "length-counts")
    histogram = np.zeros(bins, np.int64)
    for row in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        histogram[row["bin"] - 1] = row["n"]
    table = slots(plan(histogram, depth), bins)
    before = Window.partitionBy("bin").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("bin", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # Rows that tie are equal in every column, so a task that runs again ranks them alike.
    within = Window.partitionBy("bin", "shard").orderBy("piece.doc_id", "piece.start", "piece.length", F.xxhash64("piece"))
    ranked = keyed.withColumn("nth", F.row_number().over(within)).join(firsts, ["bin", "shard"])
    ranked = ranked.select("piece", "bin", (F.col("first") + F.col("nth") - 1).alias("rank"))
    scale = int(histogram.max(initial=0)) + 1
    heads = table["bin"] * scale + table["rank"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank = batch["rank"].to_numpy()
            at = np.searchsorted(heads, batch["bin"].to_numpy() * scale + rank, side="right") - 1
            yield pd.DataFrame({"piece": batch["piece"], "sequence_id": table["sequence"][at] + rank - table["rank"][at],
                                "place": table["place"][at]})

    kind = ranked.schema["piece"].dataType.simpleString()
    placed = ranked.mapInPandas(place, f"piece {kind}, sequence_id bigint, place bigint")
    earlier = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("piece.*", "sequence_id",
                         F.coalesce(F.sum(F.col("piece.length")).over(earlier), F.lit(0)).alias("offset"))


class WordIds:
    """From one word to its ids, as little-endian unsigned 32-bit numbers.

    A word of Latin letters with ASCII signs behind it is two pieces for a lower-casing byte-level BPE, and these go to the
    model itself, without the tokenizer's regular expressions. That way is taken only if it agrees with the tokenizer on
    PROBES; all other words always go through the tokenizer.
    """

    PROBES = ("word", "Word,", "ÉTÉ!!", "straße.", "a***", "&&&", "ñÑ", "the", "re", "x", "$")
    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)\Z")

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level BPE shows these bytes as themselves
        hidden = [b for b in range(256) if b not in set(shown)]
        self.signs = {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}
        self.pieces = RememberedOften(self._piece, most=PIECES)
        self.direct = all(self._split(w) == self._whole(w) for w in self.PROBES)

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        tokens = self.tokenizer.model.tokenize("".join(map(self.signs.__getitem__, piece.encode())))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def _split(self, word: str) -> bytes | None:
        found = self.PLAIN.match(word)
        if not found:
            return None
        letters, signs = found[1].lower(), found[2]
        return (self.pieces[letters] if letters else b"") + (self.pieces[signs] if signs else b"")

    def __call__(self, word: str) -> bytes:
        ids = self._split(word) if self.direct else None
        return self._whole(word) if ids is None else ids


def encoded(text: str | None, ids: RememberedOften, end: bytes) -> bytes:
    """The ids of a text and the end id.

    For tokenizers that drop white space and never join across it, so that words can be encoded one by one; the split is at
    the space and \\t, \\n, \\r only, all other white space is left to the tokenizer.
    """
    words = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
    return b"".join(map(ids.__getitem__, words)) + end


def token_pieces(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, end_id: int = END_ID,
                 with_ids: bool = True) -> DataFrame:
    """The pieces of every text: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids.

    A null text is an empty one: one piece that holds the end id alone. Texts of any length are cut whole. Repeated rows
    give repeated pieces, a null doc_id is carried like any other, and other columns are not read.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, end, width = RememberedOften(WordIds(tokenizer_file), most=WORDS), np.array([end_id], "<u4").tobytes(), 4 * window
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                data = encoded(text, known, end)
                for at in range(0, len(data), width):
                    part = data[at:at + width]
                    rows.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(data) // 4)
                                + ((np.frombuffer(part, "<u4").astype(np.int32),) if with_ids else ()))
            yield frame("doc_id start length ids_crc32 doc_tokens" + " ids" * with_ids, rows)

    kinds = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return docs.select("doc_id", "text").mapInPandas(cut, kinds + ", ids array<int>" * with_ids)


def packed(docs: DataFrame, tokenizer_file: str, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Cut and pack every text; the pieces are written once, so that no text is tokenized twice."""
    pieces, _ = materialize(token_pieces(docs, tokenizer_file, window, with_ids=with_ids), "pieces")
    return pack(pieces, window)
