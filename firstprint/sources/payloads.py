"""Raw payloads as rows: one row per archived file, replayable at any time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_payloads(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """(path, body) of every file under a path or glob.

    Payload files are small pages and API answers, so each is one row; the
    parsers work inside the row and need no shuffle.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.decode("content", encoding or "UTF-8").alias("body"))


def file_name(path="path"):
    return F.element_at(F.split(F.col(path), "/"), -1)


def key_from_name(pattern: str, group: int = 1, path: str = "path"):
    """A key the file name carries, such as the series or the month."""
    return F.regexp_extract(file_name(path), pattern, group)
