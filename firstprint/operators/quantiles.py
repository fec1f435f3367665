"""Exact medians that never gather a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def exact_median(df: DataFrame, keys: list[str], value: str, accuracy: int = 10000,
                 also: list[Column] = ()) -> DataFrame:
    """Exact median of `value` per key, as (keys, n, median) and the `also` aggregates.

    A mergeable sketch first brackets the middle ranks within n/accuracy. Then
    everything below the bracket is only counted, everything above is dropped,
    and the few values inside are counted per distinct value. A group of any
    size, or one value held by a third of it, costs no more than its bracket.
    """
    present = df.where(F.col(value).isNotNull())
    rows = present.select(*keys, F.col(value).alias("_v"))
    edge = 2.0 / accuracy
    first = present.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(value, [0.5 - edge, 0.5 + edge], accuracy).alias("_b"), *also)
    bracket = first.select(*keys, "n", "_b")
    inside = (_with_same_keys(rows, bracket, keys)
              .where(F.col("_v") <= F.col("_b")[1])
              .withColumn("_v", F.when(F.col("_v") >= F.col("_b")[0], F.col("_v")))
              .groupBy(*keys, "n", "_v").agg(F.count(F.lit(1)).alias("_c")))
    through = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")))
    ranked = inside.withColumn("_hi", through).withColumn("_lo", F.col("_hi") - F.col("_c"))

    def at(rank):
        return F.max(F.when((F.col("_lo") <= rank) & (rank < F.col("_hi")), F.col("_v")))

    middle = (at(F.floor((F.col("n") - 1) / 2)) + at(F.floor(F.col("n") / 2))) / 2.0
    medians = ranked.groupBy(*keys, "n").agg(middle.alias("median"))
    return medians if not also else _with_same_keys(medians, first.drop("n", "_b"), keys)


def _with_same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on the keys, a missing key equal to a missing one."""
    named = right.withColumnsRenamed({k: f"_is_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named[f"_is_{k}"]) for k in keys])
    return left.join(named, same).drop(*[f"_is_{k}" for k in keys])
