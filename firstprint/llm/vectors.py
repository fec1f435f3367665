"""What the operators on vectors share: which rows take part, samples, and blocks of rows that a stream of questions meets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

ALL = 1 << 30


def sound_rows(table: DataFrame, identity: str, vector: str, *more: Column, value: Callable[[Column], Column] = lambda x: x) -> DataFrame:
    """One row per id: id, `more` and the vector v as doubles (each passed through `value`).

    Left out are rows without an id, without a vector, with a null or non-finite component, with no component, and with
    another number of components than most rows (the smaller number if several are as common). Of rows that share an id the
    smallest by `more` and vector counts, so repeated rows count once.
    """
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    numbers = F.col(vector).cast("array<double>")
    rows = table.select(F.col(identity).cast("bigint").alias("id"), *more, numbers.alias("v")).where(
        F.col("id").isNotNull() & F.coalesce(F.size("v") > 0, F.lit(False)) & F.coalesce(F.forall("v", good), F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("v") == (sizes[0]["n"] if sizes else 0)).withColumn("v", F.transform("v", value))
    names = [c for c in rows.columns if c != "id"]
    return rows.groupBy("id").agg(F.min(F.struct(*names)).alias("row")).select("id", "row.*")


def matrix(column: pa.Array, dtype: type = np.float64) -> np.ndarray:
    """A column of equally long lists as the rows of a matrix."""
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(rows, -1)


def sample(rows: DataFrame, total: int, wanted: int) -> pa.Table:
    """About `wanted` rows, chosen by a hash of their id: the same ones whoever asks."""
    share = min(ALL, int(wanted / max(total, 1) * ALL))
    return rows.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(ALL)) < share).toArrow().combine_chunks()


def meet(rows: DataFrame, questions: DataFrame, hold: Callable, kinds: str) -> DataFrame:
    """Every question answered by the block of rows with the same `block`.

    `rows` and `questions` have block, id, tag (bigint), v (array<double>) and note (array<bigint>). A block's rows come
    first and are held; its questions then stream by, so a task holds one block and one batch. `hold(ids, tags, matrix)`
    returns a function of (ids, tags, matrix, notes) that gives the answers as a list of rows of `kinds`.
    """
    names = ["block", "kind", "id", "tag", "v", "note"]
    both = rows.withColumn("kind", F.lit(0)).select(names).unionByName(questions.withColumn("kind", F.lit(1)).select(names))
    dealt = both.repartition("block").sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, answer = None, [], None
        for batch in batches:
            block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for begin, end in zip([0, *edges], [*edges, len(block)]):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if kind[begin] == 0:
                    parts = [*parts, part] if at == block[begin] else [part]
                    at, answer = block[begin], None
                elif at == block[begin]:
                    if answer is None:
                        held = pa.Table.from_batches(parts).combine_chunks()
                        answer = hold(held["id"].to_numpy(), held["tag"].to_numpy(), matrix(pa.concat_arrays(held["v"].chunks)))
                    notes = part.column("note")
                    asked = part.column("id").to_numpy(), part.column("tag").to_numpy(), matrix(part.column("v"))
                    yield from made(kinds, answer(*asked, notes))

    return dealt.mapInArrow(run, kinds)


ARROW = {"bigint": pa.int64(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def made(kinds: str, rows: list[tuple]) -> list[pa.RecordBatch]:
    """Rows as a batch with the columns that `kinds` names; none without rows."""
    names, types = zip(*(column.split() for column in kinds.split(", ")))
    columns = [pa.array(list(values), ARROW[kind]) for values, kind in zip(zip(*rows), types)]
    return [pa.RecordBatch.from_arrays(columns, list(names))] if rows else []
