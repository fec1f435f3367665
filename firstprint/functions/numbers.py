"""Number text to doubles and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


_PLAIN = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"


def parse_number(text) -> Column:
    """Published number text as a double; NULL where the cell is not a number.

    Thousands commas and percent signs go, `(x)` and a leading triangle mean
    minus. Blanks, dashes and the words for 'not available' are not numbers,
    and neither is what only Spark would accept, such as '1d' or 'NaN'. Each
    step feeds the next once, so nothing is evaluated twice.
    """
    bare = F.regexp_replace(F.trim(_col(text)), "[,%]", "")
    signed = F.regexp_replace(F.regexp_replace(bare, r"^\((.*)\)$", r"-$1"), "^[△▲]", "-")
    return F.regexp_extract(signed, _PLAIN, 1).try_cast("double")


def fmt_number(value) -> Column:
    """Text form of a stored number: integers bare, the rest with two decimals."""
    x = _col(value).cast("double")
    return (F.when(x.isNull(), F.lit(""))
            .when((x == F.floor(x)) & (F.abs(x) < 9e18), x.cast("bigint").cast("string"))
            .otherwise(F.format_string("%.2f", x)))


def pct_change(now, ago) -> Column:
    """Growth in percent; NULL when the base is missing or zero."""
    return (F.try_divide(_col(now), _col(ago)) - 1.0) * 100.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
