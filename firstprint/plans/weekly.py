"""Weekly positions and weekly readings of daily series."""

import datetime as dt

from pyspark.sql import functions as F

from firstprint.operators import asof, flows as P, series as S
from firstprint.operators.ranks import expanding_rank, rolling_rank
from firstprint.plans.registry import query
from firstprint.plans.tables import DAILY_PRICE, POSITIONS, daily_price, positions

WATCH = [("1-URGENT", "urgent orders"), ("2-HIGH", "high orders"), ("5-LOW", "low orders")]
WATCH_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in WATCH)

# Weekly change, then both ranks as correlated counts over earlier weeks.
FLOWS = """moves AS (
  SELECT *, CASE WHEN date_diff('day', lag(report_date) OVER w, report_date) BETWEEN 5 AND 9
                 THEN net - lag(net) OVER w END AS net_change
  FROM positions WINDOW w AS (PARTITION BY series ORDER BY report_date)), ranked AS (
  SELECT m.*,
    (SELECT CASE WHEN count(*) >= 52 THEN 100.0 * count(*) FILTER (abs(e.net_change) < abs(m.net_change)) / count(*) END
     FROM moves e WHERE e.series = m.series AND e.report_date < m.report_date AND e.net_change IS NOT NULL) AS mr,
    (SELECT CASE WHEN count(*) >= 52 THEN 100.0 * count(*) FILTER (e.net < m.net) / count(*) END
     FROM moves e WHERE e.series = m.series AND e.report_date < m.report_date) AS net_rank_pct
  FROM moves m), flows AS (
  SELECT *, CASE WHEN net_change IS NOT NULL THEN mr END AS move_rank_pct,
         100.0 * net / nullif(open_interest, 0) AS net_pct_oi FROM ranked), flagged AS (
  SELECT *, concat_ws(' ', CASE WHEN move_rank_pct >= 90 THEN 'unusual_move' END,
                      CASE WHEN net_rank_pct >= 95 OR net_rank_pct <= 5 THEN 'extreme_net' END) AS flag
  FROM flows)"""


def flows(spark, sf):
    return P.positioning_flows(positions(spark, sf), ["series"])


@query("watch_filter", "series label report_date:d net:n", POSITIONS, f"""result AS (
  SELECT series, label, report_date, net FROM positions JOIN (VALUES {WATCH_ROWS}) t(series, label) USING (series))""")
def watch_filter(spark, sf):
    return P.watch_filter(positions(spark, sf), spark.createDataFrame(WATCH, "series string, label string"), ["series"])


@query("gap_guarded_delta", "series report_date:d net:n net_change:n", POSITIONS, """result AS (
  SELECT series, report_date, net, CASE WHEN date_diff('day', lag(report_date) OVER w, report_date) BETWEEN 5 AND 9
         THEN net - lag(net) OVER w END AS net_change
  FROM positions WINDOW w AS (PARTITION BY series ORDER BY report_date))""")
def gap_guarded_delta(spark, sf):
    return P.gap_guarded_delta(positions(spark, sf), ["series"], "report_date", "net", "net_change")


@query("expanding_rank", "ticker date:d price:n rank_pct:n", DAILY_PRICE, """result AS (
  SELECT p.ticker, p.date, p.price,
    (SELECT CASE WHEN count(*) >= 52 THEN 100.0 * count(*) FILTER (e.price < p.price) / count(*) END
     FROM daily_price e WHERE e.ticker = p.ticker AND e.date < p.date) AS rank_pct FROM daily_price p)""")
def expanding_rank_query(spark, sf):
    return expanding_rank(daily_price(spark, sf), ["ticker"], "date", "price", "rank_pct", 52)


@query("rolling_rank", "series report_date:d net:n crowd:n", POSITIONS, """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY report_date) AS rn FROM positions
  WHERE open_interest <> 0)""", """result AS (
  SELECT p.series, p.report_date, p.net,
    (SELECT CASE WHEN count(*) >= 104 THEN 100.0 * count(*) FILTER (e.net < p.net) / count(*) END
     FROM numbered e WHERE e.series = p.series AND e.rn BETWEEN p.rn - 156 AND p.rn - 1) AS crowd FROM numbered p)""")
def rolling_rank_query(spark, sf):
    return rolling_rank(positions(spark, sf), ["series"], "report_date", "net", "crowd",
                        valid=F.col("open_interest") != 0)


@query("lag_k_guarded", "series report_date:d chg4:n", POSITIONS, """result AS (
  SELECT series, report_date, CASE WHEN date_diff('day', lag(report_date, 4) OVER w, report_date) BETWEEN 25 AND 31
         THEN (net - lag(net, 4) OVER w) / nullif(open_interest, 0) END AS chg4
  FROM positions WINDOW w AS (PARTITION BY series ORDER BY report_date))""")
def lag_k_guarded(spark, sf):
    moved = P.gap_guarded_delta(positions(spark, sf), ["series"], "report_date", "net", "d4", k=4, low=25, high=31)
    return moved.withColumn("chg4", F.try_divide("d4", "open_interest"))


SIGNALS = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY report_date) AS rn FROM positions
  WHERE open_interest <> 0), crowds AS (
  SELECT p.series, p.report_date,
    (SELECT CASE WHEN count(*) >= 104 THEN 100.0 * count(*) FILTER (e.net < p.net) / count(*) END
     FROM numbered e WHERE e.series = p.series AND e.rn BETWEEN p.rn - 156 AND p.rn - 1) AS crowd
  FROM numbered p), changes AS (
  SELECT series, report_date,
    CASE WHEN date_diff('day', lag(report_date) OVER w, report_date) BETWEEN 5 AND 9
         THEN (net - lag(net) OVER w) / nullif(open_interest, 0) END AS chg1,
    CASE WHEN date_diff('day', lag(report_date, 4) OVER w, report_date) BETWEEN 25 AND 31
         THEN (net - lag(net, 4) OVER w) / nullif(open_interest, 0) END AS chg4
  FROM positions WINDOW w AS (PARTITION BY series ORDER BY report_date)), signals AS (
  SELECT c.*, crowd, CASE WHEN crowd IS NULL OR chg4 IS NULL THEN NULL
    WHEN crowd <= 20 AND chg4 > 0 THEN 1.0 WHEN crowd >= 80 AND chg4 < 0 THEN -1.0 ELSE 0.0 END AS turn
  FROM changes c LEFT JOIN crowds USING (series, report_date))"""


def signals(spark, sf):
    moved = P.gap_guarded_delta(positions(spark, sf), ["series"], "report_date", "net", "net_change")
    return P.build_signals(moved, ["series"])


@query("turn_signal", "series report_date:d chg1:n chg4:n crowd:n turn:n", POSITIONS, SIGNALS,
       "result AS (SELECT * FROM signals)")
def turn_signal(spark, sf):
    return signals(spark, sf)


@query("threshold_flags", "series flag n:i", POSITIONS, FLOWS, """result AS (
  SELECT series, flag, count(*) AS n FROM flagged GROUP BY 1, 2)""")
def threshold_flags(spark, sf):
    return flows(spark, sf).groupBy("series", "flag").agg(F.count(F.lit(1)).alias("n"))


@query("net_pct_oi", "series report_date:d net_pct_oi:n", POSITIONS, """result AS (
  SELECT series, report_date, 100.0 * net / nullif(open_interest, 0) AS net_pct_oi FROM positions)""")
def net_pct_oi(spark, sf):
    return positions(spark, sf).withColumn("net_pct_oi", P.net_pct_oi(F.col("net"), F.col("open_interest")))


@query("positioning_flows", "series report_date:d long:n short:n net:n net_change:n open_interest:n "
       "net_pct_oi:n move_rank_pct:n net_rank_pct:n flag", POSITIONS, FLOWS, "result AS (SELECT * FROM flagged)")
def positioning_flows(spark, sf):
    return flows(spark, sf)


TODAY = dt.date(2001, 8, 3)
HEADLINE = [("1-URGENT", "Urgent"), ("5-LOW", "Low"), ("9-NONE", "Not reported")]
HEADLINE_ROWS = ", ".join(f"('{k}', '{v}')" for k, v in HEADLINE)


@query("release_staleness", "series name row_status status expected_week:d net:n net_change:n move_rank_pct:n "
       "net_rank_pct:n flag net_year_earlier:n date_year_earlier:d", POSITIONS, FLOWS,
       "latest AS (SELECT max(report_date) AS d FROM flagged)", f"""result AS (
  SELECT h.series, h.name, CASE WHEN f.series IS NULL THEN 'missing' ELSE 'ok' END AS row_status,
         CASE WHEN g.any_week IS NOT NULL AND l.d >= DATE '2001-07-24' THEN 'current' ELSE 'STALE' END AS status,
         DATE '2001-07-24' AS expected_week, f.net, f.net_change, f.move_rank_pct, f.net_rank_pct, f.flag,
         y.net AS net_year_earlier, y.report_date AS date_year_earlier
  FROM (VALUES {HEADLINE_ROWS}) h(series, name) CROSS JOIN latest l
  LEFT JOIN (SELECT series, max(report_date) AS any_week FROM flagged GROUP BY 1) g ON g.series = h.series
  LEFT JOIN flagged f ON f.series = h.series AND f.report_date = l.d
  LEFT JOIN (SELECT p.* FROM flagged p, latest WHERE p.report_date <= latest.d - 364
             QUALIFY row_number() OVER (PARTITION BY series ORDER BY report_date DESC) = 1) y
    ON y.series = h.series AND f.series IS NOT NULL)""")
def release_staleness(spark, sf):
    headline = spark.createDataFrame(HEADLINE, "series string, name string")
    return P.release_staleness(flows(spark, sf), headline, ["series"], TODAY)


# --- Weekly readings of daily series ----------------------------------------------

WEEKLY = """weekly AS (
  SELECT ticker, date + CAST((12 - isodow(date)) % 7 AS INTEGER) AS friday, max(date) AS last_date,
         arg_max(price, date) AS price
  FROM daily_price GROUP BY 1, 2)"""


@query("weekly_last", "ticker friday:d last_date:d price:n", DAILY_PRICE, WEEKLY, "result AS (SELECT * FROM weekly)")
def weekly_last(spark, sf):
    return S.weekly_last(daily_price(spark, sf), ["ticker"], "date", "price")


def gaps(spark, sf):
    """Daily gap between the A and the N price, the sign of which flips often."""
    return (daily_price(spark, sf).groupBy("date")
            .agg(F.max(F.when(F.col("ticker") == "A", F.col("price"))).alias("y2y"),
                 F.max(F.when(F.col("ticker") == "N", F.col("price"))).alias("y10y"),
                 F.max(F.when(F.col("ticker") == "R", F.col("price"))).alias("y3m"))
            .withColumn("gap", F.round(F.col("y10y") - F.col("y2y"), 4)))


GAPS = """gaps AS (
  SELECT date, max(price) FILTER (ticker = 'A') AS y2y, max(price) FILTER (ticker = 'N') AS y10y,
         max(price) FILTER (ticker = 'R') AS y3m,
         round(max(price) FILTER (ticker = 'N') - max(price) FILTER (ticker = 'A'), 4) AS gap
  FROM daily_price GROUP BY 1)"""


@query("sign_streak", "name positive:b since:d", DAILY_PRICE, GAPS, """sided AS (
  SELECT year(date) AS name, date, gap >= 0 AS positive FROM gaps WHERE gap IS NOT NULL), ends AS (
  SELECT name, arg_max(positive, date) AS positive FROM sided GROUP BY 1)""", """result AS (
  SELECT e.name, e.positive, (SELECT min(s.date) FROM sided s WHERE s.name = e.name AND s.date > coalesce(
    (SELECT max(o.date) FROM sided o WHERE o.name = e.name AND o.positive <> e.positive), DATE '1900-01-01')) AS since
  FROM ends e)""")
def sign_streak(spark, sf):
    rows = gaps(spark, sf).where(F.col("gap").isNotNull()).withColumn("name", F.year("date"))
    return S.sign_streak(rows, ["name"], "date", "gap")


@query("n_weeks_change", "ticker kind change_4w:n change_13w:n change_52w:n", DAILY_PRICE, WEEKLY, """back AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY friday DESC) - 1 AS k FROM weekly), lasts AS (
  SELECT ticker, max(price) FILTER (k = 0) AS v0, max(price) FILTER (k = 4) AS v4, max(price) FILTER (k = 13) AS v13,
         max(price) FILTER (k = 52) AS v52 FROM back GROUP BY 1)""", """result AS (
  SELECT ticker, 'abs' AS kind, round(v0 - v4, 4) AS change_4w, round(v0 - v13, 4) AS change_13w,
         round(v0 - v52, 4) AS change_52w FROM lasts
  UNION ALL SELECT ticker, 'pct', round(100.0 * (v0 / nullif(v4, 0) - 1), 2),
         round(100.0 * (v0 / nullif(v13, 0) - 1), 2), round(100.0 * (v0 / nullif(v52, 0) - 1), 2) FROM lasts)""")
def n_weeks_change(spark, sf):
    hist = S.weekly_history(daily_price(spark, sf), ["ticker"], "date", "price")
    out = [hist.select("ticker", F.lit(kind).alias("kind"),
                       *[S.n_weeks_change(n, kind).alias(f"change_{n}w") for n in (4, 13, 52)])
           for kind in ("abs", "pct")]
    return out[0].unionByName(out[1])


RANKS = """latest AS (
  SELECT ticker, max(friday) AS friday FROM weekly GROUP BY 1), history AS (
  SELECT w.ticker, CASE WHEN count(*) >= 52 THEN round_even(
           100.0 * count(*) FILTER (w.price < v.price) / count(*), 0) END AS rank_pct
  FROM weekly w JOIN latest l ON w.ticker = l.ticker AND w.friday < l.friday
    JOIN weekly v ON v.ticker = l.ticker AND v.friday = l.friday GROUP BY 1), moves AS (
  SELECT ticker, friday, abs(price - lag(price, 4) OVER w) AS mv FROM weekly
  WINDOW w AS (PARTITION BY ticker ORDER BY friday)), move_ranks AS (
  SELECT m.ticker, CASE WHEN count(*) >= 52 THEN round_even(
           100.0 * count(*) FILTER (m.mv < v.mv) / count(*), 0) END AS move4_rank_pct
  FROM moves m JOIN latest l ON m.ticker = l.ticker AND m.friday < l.friday
    JOIN moves v ON v.ticker = l.ticker AND v.friday = l.friday WHERE m.mv IS NOT NULL GROUP BY 1)"""


@query("history_rank", "ticker rank_pct:n", DAILY_PRICE, WEEKLY, RANKS,
       "result AS (SELECT ticker, rank_pct FROM latest LEFT JOIN history USING (ticker))")
def history_rank(spark, sf):
    return (S.weekly_history(daily_price(spark, sf), ["ticker"], "date", "price")
            .withColumn("rank_pct", S.history_rank()))


@query("move_rank", "ticker move4_rank_pct:n", DAILY_PRICE, WEEKLY, RANKS,
       "result AS (SELECT ticker, move4_rank_pct FROM latest LEFT JOIN move_ranks USING (ticker))")
def move_rank(spark, sf):
    hist = S.weekly_history(daily_price(spark, sf), ["ticker"], "date", "price")
    return hist.withColumn("move4_rank_pct", S.move_rank(S.four_week_moves("abs")))


SUMMARY = """back AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY friday DESC) - 1 AS k FROM weekly), summary AS (
  SELECT b.ticker, max(last_date) FILTER (k = 0) AS as_of, max(price) FILTER (k = 0) AS value, min(friday) AS since,
         any_value(h.rank_pct) AS rank_pct,
         round(max(price) FILTER (k = 0) - max(price) FILTER (k = 4), 4) AS change_4w,
         round(max(price) FILTER (k = 0) - max(price) FILTER (k = 13), 4) AS change_13w,
         round(max(price) FILTER (k = 0) - max(price) FILTER (k = 52), 4) AS change_52w,
         any_value(m.move4_rank_pct) AS move4_rank_pct, count(*) FILTER (k < 156) AS chart_points,
         sum(CAST(price AS DECIMAL(18,4))) FILTER (k < 156) AS chart_sum
  FROM back b LEFT JOIN history h ON h.ticker = b.ticker LEFT JOIN move_ranks m ON m.ticker = b.ticker GROUP BY 1)"""


def summary(spark, sf):
    return S.series_summary(daily_price(spark, sf), ["ticker"], "date", "price")


@query("series_summary", "ticker as_of:d value:n since:d rank_pct:n change_4w:n change_13w:n change_52w:n "
       "move4_rank_pct:n chart_points:i chart_sum:n", DAILY_PRICE, WEEKLY, RANKS, SUMMARY,
       "result AS (SELECT * FROM summary)")
def series_summary(spark, sf):
    points = F.aggregate("chart", F.lit(0).cast("decimal(28,4)"),
                         lambda acc, w: (acc + w["v"].cast("decimal(18,4)")).cast("decimal(28,4)"))
    return summary(spark, sf).withColumn("chart_points", F.size("chart")).withColumn("chart_sum", points)


def yields(spark, sf):
    """The three daily prices and their gap as one long table of series."""
    return (gaps(spark, sf).unpivot(["date"], ["y2y", "y10y", "gap"], "name", "v")
            .where(F.col("v").isNotNull()))


@query("curve_state", "inverted:b shape driver gap_13w:n", DAILY_PRICE, GAPS, """long_rows AS (
  SELECT date, 'y2y' AS name, y2y AS v FROM gaps WHERE y2y IS NOT NULL
  UNION ALL SELECT date, 'y10y', y10y FROM gaps WHERE y10y IS NOT NULL
  UNION ALL SELECT date, 'gap', gap FROM gaps WHERE gap IS NOT NULL), fridays AS (
  SELECT name, date + CAST((12 - isodow(date)) % 7 AS INTEGER) AS friday, arg_max(v, date) AS v
  FROM long_rows GROUP BY 1, 2), back AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY friday DESC) - 1 AS k FROM fridays), wide AS (
  SELECT max(v) FILTER (k = 0 AND name = 'gap') AS gap,
    round(max(v) FILTER (k = 0 AND name = 'gap') - max(v) FILTER (k = 13 AND name = 'gap'), 4) AS g,
    round(max(v) FILTER (k = 0 AND name = 'y2y') - max(v) FILTER (k = 13 AND name = 'y2y'), 4) AS s,
    round(max(v) FILTER (k = 0 AND name = 'y10y') - max(v) FILTER (k = 13 AND name = 'y10y'), 4) AS l
  FROM back)""", """result AS (
  SELECT gap < 0 AS inverted, g AS gap_13w,
    CASE WHEN g <= -0.15 THEN 'flattening' WHEN g >= 0.15 THEN 'steepening' ELSE 'unchanged' END AS shape,
    CASE WHEN g <= -0.15 AND s > 0 THEN 'short end rose faster' WHEN g <= -0.15 THEN 'long end fell faster'
         WHEN g >= 0.15 AND s < 0 THEN 'short end fell faster' WHEN g >= 0.15 THEN 'long end rose faster'
         ELSE '' END AS driver FROM wide)""")
def curve_state(spark, sf):
    hist = S.weekly_history(yields(spark, sf), ["name"], "date", "v")
    rows = hist.select("name", F.element_at("_v", -1).alias("value"), S.n_weeks_change(13, "abs").alias("c13"))
    of = lambda name, c: F.max(F.when(F.col("name") == name, F.col(c)))
    wide = rows.agg(of("gap", "value").alias("gap"), of("gap", "c13").alias("gap_13w"),
                    of("y2y", "c13").alias("short_13w"), of("y10y", "c13").alias("long_13w"))
    return wide.select("gap_13w", *S.curve_state(F.col("gap"), F.col("gap_13w"), F.col("short_13w"),
                                                 F.col("long_13w")))


@query("market_state", "ticker direction unusual_move:b crowding", DAILY_PRICE, WEEKLY, RANKS, SUMMARY, """result AS (
  SELECT ticker, CASE WHEN change_13w IS NULL THEN 'no comparison' WHEN abs(change_13w) < 0.5 THEN 'little changed'
                      WHEN change_13w > 0 THEN 'up' ELSE 'down' END AS direction,
         coalesce(move4_rank_pct >= 90, false) AS unusual_move,
         CASE WHEN rank_pct >= 90 OR rank_pct <= 10 THEN CASE WHEN value > 0 THEN 'crowded long' ELSE 'crowded short' END
              ELSE '' END AS crowding FROM summary)""")
def market_state(spark, sf):
    return summary(spark, sf).select("ticker", *S.market_state(
        F.col("change_13w"), F.col("rank_pct"), F.col("move4_rank_pct"), F.col("value")))


@query("asof_backward", "series latest_date:d latest_value:n earlier_date:d earlier_value:n", POSITIONS, """lasts AS (
  SELECT series, max(report_date) AS latest_date, arg_max(net, report_date) AS latest_value FROM positions GROUP BY 1)""",
       """result AS (
  SELECT l.series, latest_date, latest_value, max(p.report_date) AS earlier_date,
         arg_max(p.net, p.report_date) AS earlier_value
  FROM lasts l LEFT JOIN positions p ON p.series = l.series AND p.report_date <= l.latest_date - 364
  GROUP BY 1, 2, 3)""")
def asof_backward(spark, sf):
    return asof.asof_backward(positions(spark, sf), ["series"], "report_date", "net")
