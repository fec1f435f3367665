"""Tolerant field access: by candidate name, never by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def first_present_field(df: DataFrame, candidates: list[str]) -> Column:
    """First non-blank among the candidate columns that exist; '' when none."""
    found = [F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in candidates
             if c in df.columns]
    return F.coalesce(*found, F.lit(""))


def first_present_key(record: Column, candidates: list[str]) -> Column:
    """The same for a map of fields."""
    return F.coalesce(*[F.nullif(F.trim(F.try_element_at(record, F.lit(c))), F.lit("")) for c in candidates],
                      F.lit(""))


def match_column(df: DataFrame, needles: list[str]) -> str | None:
    """First column, in file order, whose name contains any of the needles."""
    return next((c for c in df.columns if any(n in c for n in needles)), None)


def extra_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The whole record as JSON with sorted keys, so no field is ever lost."""
    names = sorted(columns or df.columns)
    return F.to_json(F.struct(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in names]))


def map_json(record: Column) -> Column:
    """A field map as JSON with sorted keys."""
    entries = F.array_sort(F.map_entries(record))
    return F.to_json(F.map_from_entries(entries))
