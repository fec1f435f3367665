"""Toxicity by compression distance between two zstandard dictionaries.

The ordinary dictionary is trained by zstandard on ordinary texts. The toxic dictionary holds the same content and, near
its end, text of toxic documents reduced to the words that set them apart (a G-squared test of document counts; the
strongest last, where offsets are cheapest). A window is one word set between two fixed pieces of ordinary text, so that
the fixed cost of a compressed block is the same on both sides and the difference of the two lengths is what the word
alone saves. Lengths of a word are computed once per task and remembered, within a bound.

A document is described by its largest saving and by how many of its windows, and what share of them, save at least 2, 3,
4, 5 or 6 bytes. A logistic curve over these, fitted on labelled documents that did not go into the dictionaries, gives
the score.

The dictionaries and the curve are fitted on at most `sample_rows` labelled documents; at most `base_texts` stretches of
STRETCH bytes travel to the driver, besides word counts. Every text is scored whole, in the tasks that read it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from firstprint.llm.caching import Remembered
from firstprint.llm.frames import frame

SAMPLE_ROWS = 12_000
BASE_TEXTS = 1_500
STRETCH = 2_000
BASE_BYTES = 32_768
TOXIC_BYTES = 8_192
LEVEL = 10
LEAST_G = 8.0
TOXIC_WEIGHT = 2.0
SAVINGS = (2, 3, 4, 5, 6)

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Savings:
    """How many bytes fewer a word takes with the toxic dictionary than with the ordinary one."""

    def __init__(self, base: bytes, toxic: bytes):
        # The last bytes of a dictionary are not indexed, so both end in the same piece of ordinary text.
        tail = base[-64:]
        self.before, self.after = base[-1200:-1176], base[-1400:-1376]
        self.ordinary, self.toxic = self._compressor(base + tail), self._compressor(base + toxic + tail)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False,
            dict_size=len(content), source_size=64)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)

    def __call__(self, word: str) -> int:
        window = self.before + f" {word} ".encode("utf-8", "surrogatepass") + self.after
        return len(self.ordinary.compress(window)) - len(self.toxic.compress(window))


def features(words: list[str], savings: Remembered) -> list[float]:
    found = np.fromiter(map(savings.__getitem__, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts = [int((found >= k).sum()) for k in SAVINGS]
    return [float(found.max()), *[float(np.log1p(c)) for c in counts], *[100 * c / len(found) for c in counts],
            float(np.log1p(len(found)))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30,
             toxic_weight: float = TOXIC_WEIGHT) -> dict[str, np.ndarray]:
    """Ridge logistic regression by Newton's method, on standardised columns; a toxic row counts `toxic_weight` times."""
    weight = np.where(y > 0, toxic_weight, 1.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    beta = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        curve = (z.T * np.maximum(weight * p * (1 - p), 1e-6)) @ z + ridge * np.eye(len(beta))
        beta += np.linalg.solve(curve, z.T @ (weight * (y - p)) - ridge * beta)
    return {"mean": mean, "scale": scale, "beta": beta}


def probabilities(x: np.ndarray, model: dict) -> np.ndarray:
    z = np.c_[(x - model["mean"]) / model["scale"], np.ones(len(x))]
    return 1 / (1 + np.exp(-np.clip(z @ model["beta"], -30, 30)))


def sample(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, label, fits): at most `rows` labelled ids with the smallest md5; `fits` is true for every other one.

    An id that is labelled twice counts as toxic if any label says so. The ids are bounded, so they are broadcast.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(usable)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label")).withColumn("order", F.md5(F.col("doc_id").cast("string")))
    known = known.orderBy("order", "doc_id").limit(rows)
    known = known.select("doc_id", "label", (F.substring("order", 32, 1).isin(*"02468ace")).alias("fits"))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def _distinct_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            yield frame("word label", ((word, label) for word in dict.fromkeys(words_of(text))))


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for text in batch["text"]:
            stretch = " ".join(dict.fromkeys(words_of(text))).encode("utf-8", "surrogatepass")[:STRETCH]
            yield frame("stretch", [(b" " + stretch + b" ",)])


def toxic_words(fitted: DataFrame, least_g: float = LEAST_G, most_bytes: int = TOXIC_BYTES) -> list[str]:
    """The words whose document counts set toxic documents apart, strongest first; at most `most_bytes` words."""
    totals = fitted.groupBy("label").count().collect()
    n = {row["label"]: row["count"] for row in totals}
    toxic, ordinary = n.get(1, 0), n.get(0, 0)
    if not toxic or not ordinary:
        return []
    counts = fitted.select("text", "label").mapInPandas(_distinct_words, "word string, label int").groupBy("word").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o"))
    part = lambda seen, all_: F.when(F.col(seen) > 0, F.col(seen) * F.log(
        F.col(seen) * F.lit(float(toxic + ordinary)) / ((F.col("t") + F.col("o")) * F.lit(float(all_))))).otherwise(0.0)
    g = 2 * (part("t", toxic) + part("o", ordinary))
    apart = counts.where(F.col("t") * ordinary > 2 * F.col("o") * toxic).withColumn("g", g).where(F.col("g") > least_g)
    return [r["word"] for r in apart.orderBy(F.desc("g"), "word").limit(most_bytes).collect()]


def fit(docs: DataFrame, labels: DataFrame, usable: Column, sample_rows: int = SAMPLE_ROWS,
        base_texts: int = BASE_TEXTS) -> dict:
    """The dictionaries and the curve. Without both kinds of labels, every score is the share of toxic ones (0 with none)."""
    labelled = sample(docs, labels, usable, sample_rows).withColumn("label", F.col("label").cast("int")).persist()
    try:
        fitted, rest = labelled.where("fits"), labelled.where("not fits")
        words = toxic_words(fitted)
        texts = fitted.where("label = 0").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(base_texts)
        stretches = [r["stretch"] for r in texts.select("text").mapInPandas(_stretches, "stretch binary").collect()]
        share = labelled.agg(F.coalesce(F.avg("label"), F.lit(0.0)).alias("share")).first()["share"]
        try:
            base = zstandard.train_dictionary(BASE_BYTES, stretches).as_bytes() if words else b""
        except zstandard.ZstdError:  # too few texts to train on: their plain content serves
            base = b"".join(stretches)[-BASE_BYTES:].rjust(2_048, b" ")
        if not words:
            return {"share": share}
        content, room = [], TOXIC_BYTES
        for word in words:
            piece = f" {word}".encode("utf-8", "surrogatepass")
            if len(piece) <= room:
                content.append(piece)
                room -= len(piece)
        model = {"share": share, "base": base, "toxic": b"".join(reversed(content)) + b" "}
        seen = rest.select("label", "text").mapInPandas(_describe(model), "label int, x array<double>").collect()
        y = np.array([r["label"] for r in seen], float)
        if not 0 < y.sum() < len(y):
            return {"share": share}
        return model | logistic(np.array([r["x"] for r in seen]), y)
    finally:
        labelled.unpersist()


def _describe(model: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        savings = Remembered(Savings(model["base"], model["toxic"]))
        for batch in batches:
            yield frame("label x", ((label, features(words_of(t), savings)) for label, t in zip(batch["label"], batch["text"])))
    return run


def toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row: 0 to 1, higher for text that is likelier to be toxic.

    A null text is scored as an empty one; any length is read whole; repeated rows get equal scores; a null doc_id is kept;
    other columns are not read; an empty table gives no rows.
    """
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        savings = Remembered(Savings(model["base"], model["toxic"])) if "beta" in model else None
        for batch in batches:
            if savings is None or batch.empty:
                found = np.full(len(batch), float(model["share"]))
            else:
                found = probabilities(np.array([features(words_of(t), savings) for t in batch["text"]]), model)
            yield frame("doc_id score", zip(batch["doc_id"], found))

    return docs.select("doc_id", "text").mapInPandas(score, "doc_id bigint, score double")
