"""A corpus pipeline: quality rules, language, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame that is written as
Parquet and read again as the next one's `docs`. All but the last return the columns of `docs`, whatever they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from firstprint.llm import decontaminate, language, neardup, packing, quality
from firstprint.llm.queries import load_all
from firstprint.llm.queries.packing import tokenizer_file
from firstprint.llm.queries.registry import ORACLES, QUERIES
from firstprint.llm.texts import table
from firstprint.session import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the quality rules, measured against the trusted ones among them."""
    found = quality.quality_rules(docs, docs, table(spark, sf_dir, "labels"))
    return found.where("kept").select("doc.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised: not `und`, and as likely as LEAST_SCORE at least."""
    found = language.identified(docs, language.fit(docs, F.lit(True)))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= language.LEAST_SCORE)).select("doc.*")


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of `docs` whose (doc_id, text) is not among the rejected (doc_id, text_hash); the columns stay as they are.

    A null doc_id is an id like any other.
    """
    gone = rejected.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_hash"])
    return docs.join(gone, same, "left_anti")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near-duplicates; a row without an id goes if one with an id stays."""
    return without(docs, neardup.near_duplicates(docs).where("not (doc_id <=> component_id)"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return without(docs, decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokens of what is left into windows of 2048."""
    return packing.packed(docs, tokenizer_file(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("packing", packing_stage),
]

# A trained classifier and a tokenizer are not SQL. Tests hold the quality and benchmark stages against SQL, the others by their ids.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs


def register(queries: dict, oracles: dict) -> None:
    """Add the queries of the text operators, and the pipeline."""
    load_all()
    queries.update(QUERIES)
    oracles.update(ORACLES)
    queries["pipeline"] = run
    if ORACLE_SQL:
        oracles["pipeline"] = ORACLE_SQL
