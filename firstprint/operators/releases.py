"""Growth tables as they are published: one scan of the rows feeds every grain of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from firstprint.operators import fx
from firstprint.operators.growth import latest_of_key, yoy_self_join

ALL_CODE, ALL_NAME = "-", "ALL COUNTRIES"


def grain_sums(rows: DataFrame, grains: dict[str, list[str]], **sums: Column) -> DataFrame:
    """Aggregates at several grains from one scan, one row per group: `grain` names the grain, keys it lacks are NULL.

    Grouping sets: Spark sends each row once per grain into one partial aggregate, so a hot key meets itself before the
    shuffle and the rows are read and joined once, whatever number of grains a table has.
    """
    keys = list(dict.fromkeys(k for grain in grains.values() for k in grain))
    sets = [[F.col(k) for k in grain] for grain in grains.values()]
    lacking = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in grain) for name, grain in grains.items()}
    made = rows.groupingSets(sets, *keys).agg(F.grouping_id().alias("_lacks"), *[c.alias(n) for n, c in sums.items()])
    grain = F.coalesce(*[F.when(F.col("_lacks") == bits, F.lit(name)) for name, bits in lacking.items()])
    return made.withColumn("grain", grain).drop("_lacks")


def windows_long(sums: DataFrame, windows: list[str], value: str = "value", window: str = "period_type") -> DataFrame:
    """A column per window turned into rows; a window without a value, or with a zero, is not published yet."""
    rest = [c for c in sums.columns if c not in windows]
    return sums.unpivot(rest, windows, window, value).where(F.col(value) != 0)


def partner_table(lines: DataFrame, keys: list[str], partner: str, name: str, value: Column, quantity: Column, unit: str,
                  period: str = "period") -> DataFrame:
    """Value, year-ago value, growth, share of the code's total and quantity per partner, and the total as partner '-'.

    Details and totals come from one scan, and a row finds its total among the rows of its own (period, keys). The total has
    a share of 100 and no quantity. Values are in thousands.
    """
    both = grain_sums(lines, {"partner": [period, *keys, partner, name], "total": [period, *keys]},
                      value=(F.sum(value).cast("double") / 1000), qty1=F.sum(quantity).cast("double"))
    total = F.col("grain") == "total"
    group = Window.partitionBy(period, *keys)
    both = both.withColumn("_total", F.max(F.when(total, F.col("value"))).over(group))
    both = both.withColumns({
        partner: F.when(total, F.lit(ALL_CODE)).otherwise(F.col(partner)), name: F.when(total, F.lit(ALL_NAME)).otherwise(F.col(name)),
        "share_of_code_pct": F.when(total, 100.0).otherwise(100.0 * F.try_divide(F.col("value"), F.col("_total"))),
        "qty1": F.when(~total, F.col("qty1")), "unit1": F.when(~total, F.lit(unit))}).drop("_total", "grain")
    return yoy_self_join(both, [*keys, partner], period)


def flash_table(windows: DataFrame, totals: DataFrame, monthly: DataFrame) -> DataFrame:
    """period, period_type, item, value, year-ago value and growth of three kinds of prints under one header.

    `windows` (period, period_type, item, value) and `monthly` (period, item, value) grow against their own history;
    `totals` (period, period_type, value, published) carry the growth that was published with them and no year-ago value.
    """
    grown = yoy_self_join(windows.unionByName(monthly.withColumn("period_type", F.lit("MONTH"))), ["item", "period_type"])
    printed = totals.select("period", "period_type", F.lit("exp:TOTAL (tradedata)").alias("item"), "value",
                            F.lit(None).cast("double").alias("value_year_ago"), F.col("published").alias("yoy_pct"))
    return grown.unionByName(printed)


def customs_table(press: DataFrame, series: DataFrame, codes: DataFrame, market: DataFrame, customs: DataFrame, quotes: list[str],
                  press_ranks: dict[str, int], code_ranks: dict[str, int]) -> DataFrame:
    """Press prints, long series and code sums with growth, published growth and their restatement at each quote's rates.

    `press` (period, stage, item, value, published, arrival): stages in `press_ranks` are one window, MONTH, whose strongest
    stage stays, later arrivals first; any other stage is a window of its own. `series` (period, series, item, value).
    `codes` (period, stage, item, value): the strongest stage per (period, item) stays and is named in the source; growth is
    against whatever stage stayed a year before. `market` and `customs` hold the window means of the rates (quote, period,
    window, rate). A row without a rate keeps NULLs.
    """
    window = F.when(F.col("stage").isin(list(press_ranks)), F.lit("MONTH")).otherwise(F.col("stage"))
    rank = F.coalesce(*[F.when(F.col("stage") == s, F.lit(r)) for s, r in press_ranks.items()], F.lit(0))
    picked = latest_of_key(press.withColumn("period_type", window), ["period", "period_type", "item"],
                           [rank.alias("r"), F.col("arrival").alias("t")], ["value", "published"])
    blank = F.lit(None).cast("double").alias("published")
    best = F.coalesce(*[F.when(F.col("stage") == s, F.lit(r)) for s, r in code_ranks.items()], F.lit(0))
    strongest = latest_of_key(codes, ["period", "item"], [best.alias("r"), F.col("stage").alias("t")], ["stage", "value"])
    source = lambda prefix, column: F.concat(F.lit(prefix), F.col(column))
    rows = picked.select("period", "period_type", F.lit("press_release").alias("source"), F.lit("press").alias("family"), "item", "value", "published")
    rows = rows.unionByName(series.select("period", F.lit("MONTH").alias("period_type"), source("timeseries:", "series").alias("source"),
                                          source("timeseries:", "series").alias("family"), "item", "value", blank))
    rows = rows.unionByName(strongest.select("period", F.lit("MONTH").alias("period_type"), source("estat_hs:", "stage").alias("source"),
                                             F.lit("estat_hs").alias("family"), "item", "value", blank))
    grown = yoy_self_join(rows, ["family", "item", "period_type"]).withColumn("quote", F.explode(F.array(*[F.lit(q) for q in quotes])))
    out = fx.window_fx_restate(grown, market, window="period_type", scale=1000.0, by=["quote"])
    lagged = fx.window_fx_restate(grown, customs, window="period_type", scale=1000.0, suffix="customs", by=["quote"])
    return out.join(lagged.select("family", "item", "period_type", "period", "quote", F.col("rate_now").alias("rate_customs"), "yoy_pct_customs"),
                    ["family", "item", "period_type", "period", "quote"]).drop("family")
