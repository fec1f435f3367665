"""Exchange rates, window means and currency restatement."""

from pyspark.sql import functions as F

from firstprint.operators import fx, growth as G, reshape
from firstprint.plans.registry import query
from firstprint.plans.tables import DAILY_PRICE, FX_DAILY, WINDOW_RELEASE, daily_price, fx_daily, window_release
from firstprint.plans.weekly import GAPS, gaps

MEANS = """means AS (
  SELECT quote, CAST(date_trunc('month', date) AS DATE) AS period, w AS "window", avg(rate) AS rate
  FROM fx_daily JOIN (VALUES ('D10', 10), ('D20', 20), ('MONTH', 31)) t(w, last) ON day(date) <= last
  GROUP BY 1, 2, 3)"""

LAGGED = """weekly_rate AS (
  SELECT quote, date - CAST(isodow(date) % 7 AS INTEGER) AS sunday, avg(rate) AS rate FROM fx_daily GROUP BY 1, 2),
  lagged AS (
  SELECT quote, sunday + 14 + k AS date, rate FROM weekly_rate, (SELECT unnest(range(0, 7)) AS k) t),
  lagged_means AS (
  SELECT quote, CAST(date_trunc('month', date) AS DATE) AS period, w AS "window", avg(rate) AS rate
  FROM lagged JOIN (VALUES ('D10', 10), ('D20', 20), ('MONTH', 31)) t(w, last) ON day(date) <= last
  GROUP BY 1, 2, 3)"""
LAGGED = LAGGED.replace("sunday + 14 + k AS date", "sunday + CAST(14 + k AS INTEGER) AS date")


@query("window_mean", "quote period:d window rate:n", FX_DAILY, MEANS, "result AS (SELECT * FROM means)")
def window_mean(spark, sf):
    return fx.window_mean(fx_daily(spark, sf), ["quote"], "date", "rate")


@query("lagged_week_rate", "quote period:d window rate:n", FX_DAILY, LAGGED, "result AS (SELECT * FROM lagged_means)")
def lagged_week_rate(spark, sf):
    return fx.lagged_week_window_mean(fx_daily(spark, sf), ["quote"], "date", "rate")


@query("cross_rate", "date:d quote rate_per_usd:n", DAILY_PRICE, """result AS (
  SELECT q.date, q.ticker AS quote, q.price / u.price AS rate_per_usd
  FROM daily_price q JOIN daily_price u ON q.date = u.date AND u.ticker = 'R'
  WHERE q.ticker IN ('A', 'N') AND q.price > 0 AND u.price > 0)""")
def cross_rate(spark, sf):
    rows = fx.cross_rate(daily_price(spark, sf), "date", "ticker", "price", ["A", "N"], leg="R")
    return rows.withColumnRenamed("rate_per_r", "rate_per_usd")


@query("spread_columns", "date:d gap_2s10s:n gap_3m10y:n", DAILY_PRICE, GAPS, """result AS (
  SELECT date, y10y - y2y AS gap_2s10s, y10y - y3m AS gap_3m10y FROM gaps)""")
def spread_columns(spark, sf):
    return reshape.spread_columns(gaps(spark, sf))


RESTATED = """grown AS (
  SELECT a.*, b.value AS value_year_ago, (a.value / nullif(b.value, 0) - 1.0) * 100.0 AS yoy_pct
  FROM window_release a LEFT JOIN window_release b ON a.item = b.item AND a."window" = b."window"
    AND b.period = a.period - INTERVAL 12 MONTH)"""


@query("window_fx_restate", "item period:d window quote value:n yoy_pct:n rate_now:n value_usd:n yoy_pct_usd:n "
       "fx_effect_pt:n yoy_pct_customs:n", WINDOW_RELEASE, FX_DAILY, MEANS, LAGGED, RESTATED, """result AS (
  SELECT g.item, g.period, g."window", quotes.quote, g.value, g.yoy_pct, n.rate AS rate_now, g.value / n.rate AS value_usd,
         ((g.value / n.rate) / nullif(value_year_ago / o.rate, 0) - 1.0) * 100.0 AS yoy_pct_usd,
         g.yoy_pct - ((g.value / n.rate) / nullif(value_year_ago / o.rate, 0) - 1.0) * 100.0 AS fx_effect_pt,
         ((g.value / cn.rate) / nullif(value_year_ago / co.rate, 0) - 1.0) * 100.0 AS yoy_pct_customs
  FROM grown g CROSS JOIN (VALUES ('A'), ('N'), ('R')) quotes(quote)
  LEFT JOIN means n ON n.quote = quotes.quote AND n.period = g.period AND n."window" = g."window"
  LEFT JOIN means o ON o.quote = quotes.quote AND o.period = g.period - INTERVAL 12 MONTH AND o."window" = g."window"
  LEFT JOIN lagged_means cn ON cn.quote = quotes.quote AND cn.period = g.period AND cn."window" = g."window"
  LEFT JOIN lagged_means co ON co.quote = quotes.quote AND co.period = g.period - INTERVAL 12 MONTH
    AND co."window" = g."window")""")
def window_fx_restate(spark, sf):
    quotes = F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R")))
    grown = G.yoy_self_join(window_release(spark, sf), ["item", "window"]).withColumn("quote", quotes)
    rates = fx_daily(spark, sf)
    market = fx.window_mean(rates, ["quote"], "date", "rate")
    customs = fx.lagged_week_window_mean(rates, ["quote"], "date", "rate")
    out = fx.window_fx_restate(grown, market, by=["quote"])
    extra = (fx.window_fx_restate(grown, customs, suffix="customs", by=["quote"])
             .select("item", "period", "window", "quote", "yoy_pct_customs"))
    return out.join(extra, ["item", "period", "window", "quote"])
