"""Weekly readings of daily series: changes, ranks, streaks and states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from firstprint.functions.periods import friday_label

CHART_WEEKS = 156


def weekly_last(df: DataFrame, series: list[str], date: str, value: str) -> DataFrame:
    """Last reading of each week, labelled with its Friday."""
    return df.groupBy(*series, friday_label(date).alias("friday")).agg(
        F.max(date).alias("last_date"), F.max_by(value, date).alias(value))


def sign_streak(df: DataFrame, series: list[str], date: str, value: str) -> DataFrame:
    """Which side of zero the series is on, and since when."""
    positive = F.col(value) >= 0
    before = F.lag("_positive").over(Window.partitionBy(*series).orderBy(date))
    turned = before.isNull() | (F.col("_positive") != before)
    return (df.withColumn("_positive", positive).withColumn("_turn", F.when(turned, F.col(date)))
            .groupBy(*series).agg(F.max_by("_positive", date).alias("positive"),
                                  F.max("_turn").alias("since")))


def weekly_history(df: DataFrame, series: list[str], date: str, value: str) -> DataFrame:
    """One row per series with its weekly readings as a date-ordered array.

    The array has one entry per week, so it is as long as the calendar.
    """
    week = F.struct(F.col("friday").alias("d"), F.col(value).alias("v"))
    return (weekly_last(df, series, date, value).groupBy(*series)
            .agg(F.array_sort(F.collect_list(week)).alias("weeks"),
                 F.max("last_date").alias("as_of"))
            .withColumn("_v", F.transform("weeks", lambda w: w["v"])))


def _weeks_ago(n: int) -> Column:
    return F.when(F.size("_v") > n, F.get("_v", F.size("_v") - 1 - n))


def n_weeks_change(n: int, kind: str) -> Column:
    last = F.element_at("_v", -1)
    if kind == "pct":
        return F.round(100.0 * (F.try_divide(last, _weeks_ago(n)) - 1), 2)
    return F.round(last - _weeks_ago(n), 4)


def _share_below(history: Column, value: Column) -> Column:
    below = F.size(F.filter(history, lambda x: x < value))
    return F.bround(100.0 * below / F.size(history), 0)


def history_rank(least: int = 52) -> Column:
    """Latest reading against all earlier ones, whole percent."""
    earlier = F.slice("_v", 1, F.greatest(F.size("_v") - 1, F.lit(0)))
    return F.when(F.size("_v") > least, _share_below(earlier, F.element_at("_v", -1)))


def four_week_moves(kind: str) -> Column:
    """Absolute four-week moves, oldest first; percent moves skip a zero base."""
    steps = F.greatest(F.size("_v") - 4, F.lit(0))
    pairs = F.arrays_zip(F.slice("_v", 1, steps).alias("a"), F.slice("_v", 5, steps).alias("b"))
    if kind == "pct":
        return F.transform(F.filter(pairs, lambda p: p["a"] != 0), lambda p: F.abs(p["b"] / p["a"] - 1))
    return F.transform(pairs, lambda p: F.abs(p["b"] - p["a"]))


def move_rank(moves: Column, least: int = 53) -> Column:
    earlier = F.slice(moves, 1, F.greatest(F.size(moves) - 1, F.lit(0)))
    return F.when(F.size(moves) >= least, _share_below(earlier, F.element_at(moves, -1)))


def series_summary(df: DataFrame, series: list[str], date: str, value: str,
                   kind: str = "abs") -> DataFrame:
    """Latest value, changes over 4/13/52 weeks, both ranks and the chart points."""
    hist = weekly_history(df, series, date, value).withColumn("_m", four_week_moves(kind))
    return hist.select(
        *series, "as_of", F.element_at("_v", -1).alias("value"),
        F.element_at("weeks", 1)["d"].alias("since"),
        history_rank().alias("rank_pct"),
        *[n_weeks_change(n, kind).alias(f"change_{n}w") for n in (4, 13, 52)],
        move_rank(F.col("_m")).alias("move4_rank_pct"),
        F.slice("weeks", F.greatest(F.size("weeks") - CHART_WEEKS + 1, F.lit(1)), CHART_WEEKS)
        .alias("chart"))


# --- States ---------------------------------------------------------------------

def moved(change: Column, unit: str) -> Column:
    """'no comparison', 'little changed', 'up' or 'down'."""
    small = 0.05 if unit == "pts" else 0.5
    return (F.when(change.isNull(), "no comparison").when(F.abs(change) < small, "little changed")
            .when(change > 0, "up").otherwise("down"))


def curve_state(gap: Column, gap_change: Column, short_change: Column, long_change: Column) -> list[Column]:
    """Inversion, how the shape moved, and which end moved it."""
    known = gap_change.isNotNull() & short_change.isNotNull() & long_change.isNotNull()
    shape = (F.when(gap_change <= -0.15, "flattening").when(gap_change >= 0.15, "steepening")
             .otherwise("unchanged"))
    driver = (F.when((gap_change <= -0.15) & (short_change > 0), "short end rose faster")
              .when(gap_change <= -0.15, "long end fell faster")
              .when((gap_change >= 0.15) & (short_change < 0), "short end fell faster")
              .when(gap_change >= 0.15, "long end rose faster").otherwise(""))
    return [(gap < 0).alias("inverted"), F.when(known, shape).alias("shape"),
            F.when(known, driver).alias("driver")]


def market_state(change: Column, rank: Column, move4_rank: Column, value: Column,
                 unit: str = "%") -> list[Column]:
    """Direction, unusually large move, and crowded side."""
    crowded = (rank >= 90) | (rank <= 10)
    return [moved(change, unit).alias("direction"),
            F.coalesce(move4_rank >= 90, F.lit(False)).alias("unusual_move"),
            F.when(crowded, F.when(value > 0, "crowded long").otherwise("crowded short"))
            .otherwise("").alias("crowding")]
