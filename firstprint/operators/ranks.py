"""Ranks of a value among the earlier values of its own series.

Series here have one row per date: raw rows are reduced to that grain by a
partial aggregate first, so a series is never longer than its calendar.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F


def earlier_and_below(series: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For every row, how many rows of its series have a smaller place and a smaller value.

    A merge count over all series at once. Places run from 0 in each series, and rows come series by series. Two places
    differ first at one binary digit: there the earlier has a 0 and the later a 1, and what stands above is the same. So per
    digit one running count of zeros inside the shared upper digits, in value order, finds each such pair once.
    """
    below = np.zeros(len(place), np.int64)
    if not len(place):
        return below
    first = np.flatnonzero(np.r_[True, np.diff(series) != 0])
    start = np.repeat(first, np.diff(np.r_[first, len(place)]))
    by_value = np.lexsort((-place, value, series))  # of equal values the later first: a tie is never counted
    for digit in range(int(place.max()).bit_length()):
        shared = start + (place >> digit + 1)
        order = by_value[np.argsort(shared[by_value], kind="stable")]
        late = (place[order] >> digit & 1).astype(bool)
        zeros = np.cumsum(~late)
        opens = np.flatnonzero(np.r_[True, np.diff(shared[order]) != 0])
        before = np.repeat(np.r_[0, zeros[opens[1:] - 1]], np.diff(np.r_[opens, len(order)]))
        below[order] += np.where(late, zeros - before, 0)
    return below


def past_percents(lists: pa.Array, min_history: int) -> pa.Array:
    """For every list of values: the percent of the earlier ones below each; null for nulls and without enough history."""
    sizes = np.diff(np.asarray(lists.offsets))
    flat = lists.flatten()
    known = np.asarray(flat.is_valid())
    ends = np.cumsum(sizes)
    earlier = np.cumsum(known) - known
    earlier -= np.repeat(np.r_[0, np.cumsum(known)][ends - sizes], sizes)
    which = np.repeat(np.arange(len(sizes)), sizes)
    values = flat.to_numpy(zero_copy_only=False)
    percent, enough = np.zeros(len(flat)), known & (earlier >= max(min_history, 1))
    below = np.zeros(len(flat), np.int64)
    below[known] = earlier_and_below(which[known], earlier[known], values[known])
    percent[enough] = 100.0 * below[enough] / earlier[enough]
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(percent, mask=~enough))


def expanding_rank(df: DataFrame, series: list[str], order: str, value: str, out: str,
                   min_history: int) -> DataFrame:
    """Percent of strictly earlier values strictly below the current one.

    NULL until there are `min_history` earlier values; NULL values neither rank nor count. The rows of a series meet as one
    array in date order, and only its values go to Arrow, where a merge count ranks all series of a batch together. So the
    input is computed and shuffled once, and no length is fixed or looked up beforehand.
    """
    percents = F.arrow_udf(lambda lists: past_percents(lists, min_history), "array<double>")
    rows = F.struct(F.col(order).alias("at"), F.col(value).cast("double").alias("value"), F.struct(*map(F.col, map(_quoted, df.columns))).alias("row"))
    packed = df.groupBy(*series).agg(F.sort_array(F.collect_list(rows)).alias("_rows"))
    ranked = packed.select("_rows", percents(F.col("_rows.value")).alias("_ranks"))
    each = ranked.select(F.inline(F.arrays_zip("_rows", "_ranks")))
    return each.select("_rows.row.*", F.col("_ranks").alias(out))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rolling_rank(df: DataFrame, series: list[str], order: str, value: str, out: str,
                 window: int = 156, min_history: int = 104, valid=None) -> DataFrame:
    """The same percent among the previous `window` valid rows only."""
    ok = F.col(value).isNotNull() if valid is None else valid & F.col(value).isNotNull()
    frame = (Window.partitionBy(*series, "_ok").orderBy(order).rowsBetween(-window, -1))
    past = F.collect_list(value).over(frame)
    rank = F.when(F.col("_ok") & (F.size("_past") >= min_history),
                  100.0 * F.size(F.filter("_past", lambda x: x < F.col(value))) / F.size("_past"))
    return (df.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_past", past)
            .withColumn(out, rank).drop("_ok", "_past"))


def average_rank(keys: list[str], value: str):
    """Rank within the keys where ties share their mean rank."""
    order = Window.partitionBy(*keys).orderBy(value)
    peers = Window.partitionBy(*keys, value)
    return F.rank().over(order) + (F.count(F.lit(1)).over(peers) - 1) / 2.0
