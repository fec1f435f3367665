"""Cross rates, window means, lagged weekly rates and currency restatement."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from firstprint.functions.fixed_values import WINDOW_DAYS
from firstprint.functions.numbers import pct_change
from firstprint.functions.periods import week_start_sunday


def cross_rate(df: DataFrame, date: str, currency: str, per_base: str, quotes: list[str],
               leg: str = "USD") -> DataFrame:
    """Rates per common base turned into rates per `leg`; both legs must exist.

    One pivoting aggregate per date instead of a self-join.
    """
    def rate_of(code):
        return F.max(F.when(F.col(currency) == code, F.col(per_base)))

    legs = df.where(F.col(per_base) > 0).groupBy(date).agg(
        rate_of(leg).alias("_leg"), *[rate_of(q).alias(q) for q in quotes])
    return (legs.where(F.col("_leg").isNotNull())
            .unpivot([date, "_leg"], quotes, "quote", "_q").where(F.col("_q").isNotNull())
            .select(date, "quote", (F.col("_q") / F.col("_leg")).alias(f"rate_per_{leg.lower()}")))


def window_mean(rates: DataFrame, keys: list[str], date: str, rate: str) -> DataFrame:
    """Mean rate of each month's first ten days, first twenty and whole month."""
    day = F.dayofmonth(date)
    means = rates.groupBy(*keys, F.trunc(F.col(date), "month").alias("period")).agg(
        *[F.avg(F.when(day.between(lo, hi), F.col(rate))).alias(name)
          for name, (lo, hi) in WINDOW_DAYS.items()])
    return (means.unpivot([*keys, "period"], list(WINDOW_DAYS), "window", "rate")
            .where(F.col("rate").isNotNull()))


def lagged_week_rates(rates: DataFrame, keys: list[str], date: str, rate: str,
                      weeks: int = 2) -> DataFrame:
    """Rate of each calendar day: the mean of the Sunday week `weeks` before it."""
    weekly = rates.groupBy(*keys, week_start_sunday(date).alias("_w")).agg(F.avg(rate).alias("rate"))
    first = F.date_add(F.col("_w"), 7 * weeks)
    return weekly.select(*keys, "rate",
                         F.explode(F.sequence(first, F.date_add(first, 6))).alias("day"))


def lagged_week_window_mean(rates: DataFrame, keys: list[str], date: str, rate: str,
                            weeks: int = 2) -> DataFrame:
    """Mean of the lagged weekly rate over the calendar days of each window."""
    return window_mean(lagged_week_rates(rates, keys, date, rate, weeks), keys, "day", "rate")


def window_fx_restate(rows: DataFrame, means: DataFrame, period: str = "period",
                      window: str = "window", value: str = "value", yoy: str = "yoy_pct",
                      scale: float = 1.0, suffix: str = "usd", by: list[str] = ()) -> DataFrame:
    """Restate a print and its year-ago base at the mean rates of their windows.

    `by` names key columns of rows and means, such as the currency a row is restated in.

    `fx_effect_pt` is the local growth less the restated growth: the part of
    the growth that is the currency. NULL wherever a rate is missing.
    """
    keys = [*by, period, window]
    now = means.select(*by, F.col("period").alias(period), F.col("window").alias(window),
                       F.col("rate").alias("rate_now"))
    ago = means.select(*by, F.add_months("period", 12).alias(period), F.col("window").alias(window),
                       F.col("rate").alias("rate_ago"))
    base = F.col(f"{value}_year_ago")
    out = (rows.join(now, keys, "left").join(ago, keys, "left")
           .withColumn(f"value_{suffix}", F.col(value) * scale / F.col("rate_now"))
           .withColumn(f"yoy_pct_{suffix}",
                       pct_change(F.col(value) / F.col("rate_now"), base / F.col("rate_ago"))))
    return out.withColumn("fx_effect_pt", F.col(yoy) - F.col(f"yoy_pct_{suffix}"))
