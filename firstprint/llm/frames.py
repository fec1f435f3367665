"""Pandas frames that go back to Spark."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd


def frame(columns: str, rows: Iterable[tuple]) -> pd.DataFrame:
    """Rows as plain objects, which Arrow turns into the declared types: nulls stay nulls, an empty frame keeps its columns."""
    return pd.DataFrame(list(rows), columns=columns.split(), dtype=object)
