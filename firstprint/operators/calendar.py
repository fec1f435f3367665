"""Trading calendar as a table, and the dated events derived from it.

The calendar has one row per day, so its size is set by the years covered and
not by any data; lookups against it are joins on the day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def _day(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def nth_weekday(first_of_month: Column, weekday: int, n: int) -> Column:
    """n-th given weekday (Monday 0) of the month."""
    ahead = F.pmod(F.lit(weekday) - F.weekday(first_of_month), F.lit(7))
    return F.date_add(first_of_month, ahead + 7 * (n - 1))


def last_weekday(first_of_month: Column, weekday: int) -> Column:
    last = F.last_day(first_of_month)
    return F.date_sub(last, F.pmod(F.weekday(last) - weekday, F.lit(7)))


def easter(year: Column) -> Column:
    """Western Easter by the ecclesiastical full moon (Gauss, Gregorian form)."""
    golden = F.pmod(year, F.lit(19))
    century = F.floor(year / 100)
    drift = F.floor((13 + 8 * century) / 25)
    moon = F.pmod(15 - drift + century - F.floor(century / 4), F.lit(30))
    sun = F.pmod(4 + century - F.floor(century / 4), F.lit(7))
    d = F.pmod(19 * golden + moon, F.lit(30))
    e = F.pmod(2 * F.pmod(year, F.lit(4)) + 4 * F.pmod(year, F.lit(7)) + 6 * d + sun, F.lit(7))
    days = 22 + d + e
    late = (F.when((d == 29) & (e == 6), 50)
            .when((d == 28) & (e == 6) & (golden > 10), 49).otherwise(days))
    return F.date_add(_day(year, 3, 1), (late - 1).cast("int"))


def _observed(day: Column) -> Column:
    """Weekend holidays move to Friday or Monday; a Saturday 1 January to nowhere."""
    new_year = (F.month(day) == 1) & (F.dayofmonth(day) == 1)
    return (F.when((F.weekday(day) == 5) & new_year, None)
            .when(F.weekday(day) == 5, F.date_sub(day, F.lit(1)))
            .when(F.weekday(day) == 6, F.date_add(day, 1)).otherwise(day))


def holidays_of(year: Column) -> Column:
    """Array of the exchange's full-day closures of a year, by rule."""
    fixed = [_observed(_day(year, m, d)) for m, d in ((1, 1), (6, 19), (7, 4), (12, 25))]
    moving = [nth_weekday(_day(year, 1, 1), 0, 3), nth_weekday(_day(year, 2, 1), 0, 3),
              F.date_sub(easter(year), F.lit(2)), last_weekday(_day(year, 5, 1), 0),
              nth_weekday(_day(year, 9, 1), 0, 1), nth_weekday(_day(year, 11, 1), 3, 4)]
    return F.array_compact(F.array(*fixed, *moving))


def trading_calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day: trading or not, next and previous trading day, day count."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("day"))
    return calendar_of(days)


def calendar_of(days: DataFrame) -> DataFrame:
    """The same for a table of consecutive days."""
    closed = F.array_contains(holidays_of(F.year("day")), F.col("day"))
    open_ = (F.weekday("day") < 5) & ~closed
    # The whole calendar is one ordered run of days: a few tens of thousands of
    # rows for a century, whatever the facts joined to it hold.
    run = Window.partitionBy(F.lit(0)).orderBy("day")
    ahead = run.rowsBetween(0, Window.unboundedFollowing)
    behind = run.rowsBetween(Window.unboundedPreceding, 0)
    month = Window.partitionBy(F.trunc(F.col("day"), "month"))
    return (days.withColumn("is_trading", open_)
            .withColumn("_t", F.when(F.col("is_trading"), F.col("day")))
            .withColumn("next_trading", F.min("_t").over(ahead))
            .withColumn("previous_trading", F.max("_t").over(behind))
            .withColumn("trading_number", F.count("_t").over(behind))
            .withColumn("from_month_end", F.count("_t").over(
                month.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)))
            .drop("_t"))


def add_trading_days(df: DataFrame, day: str, calendar: DataFrame, n: int, out: str) -> DataFrame:
    """The n-th trading day after the day: two equality joins on the calendar."""
    here = calendar.select(F.col("day").alias(day), (F.col("trading_number") + n).alias("_n"))
    there = calendar.where("is_trading").select(F.col("trading_number").alias("_n"), F.col("day").alias(out))
    return df.join(here, day, "left").join(there, "_n", "left").drop("_n")


def _months(calendar: DataFrame, month_end_days: int) -> DataFrame:
    """Month-level facts: rebalancing span, expiry, settlements."""
    first = F.trunc(F.col("day"), "month").alias("month")
    last_n = F.col("is_trading") & (F.col("from_month_end") <= month_end_days)
    third_friday = nth_weekday(F.trunc(F.col("day"), "month"), 4, 3)
    at = lambda d: F.max(F.when(F.col("day") == d, F.col("previous_trading")))
    return calendar.groupBy(first).agg(
        F.min(F.when(last_n, F.col("day"))).alias("rebalance_start"),
        F.max(F.when(last_n, F.col("day"))).alias("rebalance_end"),
        at(third_friday).alias("expiry"),
        at(F.date_add(F.trunc(F.col("day"), "month"), 14)).alias("settle_mid"),
        F.max(F.when(F.col("is_trading"), F.col("day"))).alias("settle_end"))


def event_calendar(calendar: DataFrame, start, horizon_days: int, month_end_days: int = 5,
                   form13f_days: int = 45, monitor_days: tuple[int, int] = (3, 10),
                   publish_days: int = 7, published: list[dt.date] = (),
                   rate_decisions: list[dt.date] = ()) -> DataFrame:
    """Dated events meeting [start, start + horizon]: (start, end, kind, basis).

    Published short-interest dates, when given, replace the estimated ones. The
    calendar should reach a few months beyond both ends of the horizon.
    """
    months = _months(calendar, month_end_days)
    quarter_end = F.month("month").isin(3, 6, 9, 12)

    def event(df, a, b, kind, basis):
        return df.select(F.col(a).alias("start"), F.col(b).alias("end"),
                         kind.alias("kind"), basis.alias("basis")).where(F.col("start").isNotNull())

    lit = F.lit
    rebalance = event(months, "rebalance_start", "rebalance_end",
                      F.when(quarter_end, "rebalance_quarter").otherwise("rebalance_month"), lit("rule"))
    expiry = event(months.where(quarter_end), "expiry", "expiry", lit("expiry"), lit("rule"))
    nexts = calendar.select(F.col("day").alias("_due"), F.col("next_trading").alias("deadline"))
    deadlines = (months.where(quarter_end)
                 .withColumn("_due", F.date_add(F.last_day("month"), form13f_days)).join(nexts, "_due"))
    filing = event(deadlines, "deadline", "deadline", lit("13f"), lit("rule"))
    monitor = event(deadlines.withColumn("_a", F.date_add("deadline", monitor_days[0]))
                    .withColumn("_b", F.date_add("deadline", monitor_days[1])),
                    "_a", "_b", lit("trend_monitor"), lit("estimate"))
    spark = calendar.sparkSession

    def dated(days, kind):
        return spark.createDataFrame([(d, d, kind, "published") for d in days],
                                     "start date, end date, kind string, basis string")

    if published:
        short = dated(published, "short_interest")
    else:
        settles = months.select(F.explode(F.array("settle_mid", "settle_end")).alias("settle"))
        pub = add_trading_days(settles.where("settle is not null"), "settle", calendar, publish_days, "pub")
        short = event(pub, "pub", "pub", lit("short_interest"), lit("estimate"))
    out = rebalance.unionByName(expiry).unionByName(filing).unionByName(monitor).unionByName(short)
    if rate_decisions:
        out = out.unionByName(dated(rate_decisions, "rate_decision"))
    first = F.lit(start).cast("date") if not isinstance(start, Column) else start
    last = F.date_add(first, horizon_days)
    return out.where((F.col("end") >= first) & (F.col("start") <= last))
