"""Evaluate costly expressions once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, keep: list, **columns: Column) -> DataFrame:
    """Select `keep` and the named columns, each computed exactly once per row.

    A filter on a plain projected column is pushed below the projection, which
    evaluates the expression again for every mention. Passing the columns
    through a one-element generator keeps later filters above it, with no
    shuffle.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
