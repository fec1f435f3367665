"""Word columns and helpers that the text operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (ASCII texts take the faster function, with the same result)."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def white_words(text: Column) -> Column:
    """The maximal runs of characters other than space and \\t-\\r; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def alnum_words(text: Column) -> Column:
    """The maximal runs of ASCII letters, digits and characters from U+0080 on, A-Z lower-cased; none for a null text."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
