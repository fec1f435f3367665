"""Language identification by multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, everything but letters becomes a space, and its 1- to 3-character grams are hashed into BUCKETS
buckets. Counts per language over a bounded sample give one matrix of log probabilities, which is broadcast. Texts are
scored in sparse batches: the bucket numbers of many texts in one array, with the place where each text begins, look up
their rows of the matrix and are summed per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from firstprint.llm.frames import frame

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SAMPLE_PER_LANGUAGE = 1_000
MOST_LANGUAGES = 256
SMOOTHING = 0.5
BATCH = 1 << 18
LEAST_SCORE = 0.5
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def buckets_of(text: str | None, orders: tuple[int, ...] = ORDERS, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every gram of a text; empty if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return np.empty(0, np.int32)
    points = np.where(is_letter, points, np.uint32(32))
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]])
    keep = (points[1:] != 32) | (points[:-1] != 32)  # runs of spaces count as one
    points = np.concatenate([points[:1], points[1:][keep]])
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    parts = []
    for n in orders:
        code = np.full(max(len(points) - n + 1, 0), n, np.uint32)
        for i in range(n):
            code = (code ^ points[i:i + len(code)]) * np.uint32(0x01000193)
            code = code ^ (code >> np.uint32(15))
        parts.append(((code * np.uint32(0x9E3779B1)) >> shift).astype(np.int32))
    return np.concatenate(parts)


def sample_ids(docs: DataFrame, usable: Column, per_language: int = SAMPLE_PER_LANGUAGE,
               most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """(doc_id, language): the `per_language` ids with the smallest md5 of each of the `most_languages` commonest languages.

    Ids are first counted by the head of their md5. Only those whose head can hold one of the smallest are ordered, so no
    task orders a common language. An id counts once, however often it is repeated.
    """
    known = docs.select("doc_id", F.col("lang").alias("language")).where("language is not null and doc_id is not null").where(usable)
    known = known.distinct().withColumn("order", F.md5(F.col("doc_id").cast("string"))).withColumn("head", F.substring("order", 1, 4))
    counts = known.groupBy("language", "head").agg(F.count(F.lit(1)).alias("n"))
    common = counts.groupBy("language").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "language").limit(most_languages)
    earlier = Window.partitionBy("language").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = counts.join(F.broadcast(common.select("language")), "language").withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    heads = heads.where(F.col("before") < per_language).select("language", "head")  # at most `per_language` of a language
    order = Window.partitionBy("language").orderBy("order", "doc_id")
    near = known.join(F.broadcast(heads), ["language", "head"]).withColumn("nth", F.row_number().over(order))
    return near.where(F.col("nth") <= per_language).select("doc_id", "language")


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, text in zip(batch["language"], batch["text"]):
            held = sums.setdefault(language, np.zeros(BUCKETS, np.int64))
            held += np.bincount(buckets_of(text), minlength=BUCKETS)
    yield frame("language counts", ((language, x.tobytes()) for language, x in sums.items()))


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.int64) for x in rows["counts"])
    return frame("language counts", [(rows["language"].iloc[0], total.tobytes())])


def fit(docs: DataFrame, usable: Column, per_language: int = SAMPLE_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> dict:
    """The languages and the matrix of log probabilities, a row for each bucket and a column for each language.

    The labelled sample is bounded by its two parameters, so it is broadcast, and one row of counts for each language
    reaches the driver. Rows repeated with one id and language count once, with the smallest of their texts.
    """
    chosen = sample_ids(docs, usable, per_language, most_languages)
    texts = docs.select("doc_id", F.col("lang").alias("language"), "text").join(F.broadcast(chosen), ["doc_id", "language"])
    texts = texts.groupBy("doc_id", "language").agg(F.min("text").alias("text"))
    kind = "language string, counts binary"
    partial = texts.repartition(8, "doc_id").select("language", "text").mapInPandas(_counts, kind)
    rows = sorted(partial.groupBy("language").applyInPandas(_added, kind).collect(), key=lambda r: r["language"])
    if not rows:
        return {"languages": [], "matrix": np.zeros((BUCKETS, 0), np.float32)}
    counts = np.array([np.frombuffer(r["counts"], np.int64) for r in rows], float).T + SMOOTHING
    return {"languages": [r["language"] for r in rows], "matrix": np.log(counts / counts.sum(axis=0)).astype(np.float32)}


def score_texts(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its probability, with equal chances beforehand."""
    languages, matrix = np.array(model["languages"] + [UNKNOWN], object), model["matrix"]
    best, score = np.full(len(texts), len(languages) - 1), np.zeros(len(texts))

    def flush(numbers: list[int], found: list[np.ndarray]) -> None:
        starts = np.cumsum([0] + [len(x) for x in found[:-1]])
        sums = np.add.reduceat(matrix[np.concatenate(found)], starts, axis=0, dtype=np.float64)
        top = sums.argmax(axis=1)
        best[numbers] = top
        score[numbers] = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)

    numbers, found, held = [], [], 0
    for number, text in enumerate(texts):
        grams = buckets_of(text)
        if len(grams) and len(languages) > 1:
            numbers.append(number)
            found.append(grams)
            held += len(grams)
            if held >= BATCH:
                flush(numbers, found)
                numbers, found, held = [], [], 0
    if numbers:
        flush(numbers, found)
    return list(languages[best]), score


def identified(docs: DataFrame, model: dict) -> DataFrame:
    """Every column of `docs` under `doc`, with lang_pred and score.

    A null text, and one without a letter, is `und` with score 0, as is every text if no language was learned. Texts of any
    length are scored whole; a tie goes to the language first in order; equal texts get equal answers; other columns are
    only carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    @pandas_udf(kind)
    def scored(text: pd.Series) -> pd.DataFrame:
        languages, score = score_texts(list(text), shared.value)
        return frame("lang_pred score", zip(languages, score))

    found = docs.select(F.struct("*").alias("doc")).withColumn("found", scored("doc.text"))
    return found.select("doc", "found.lang_pred", "found.score")
