"""As-of lookups, forward returns and the lead-lag grid."""

import datetime as dt

from pyspark.sql import functions as F

from firstprint.operators import asof, stats
from firstprint.plans.registry import query
from firstprint.plans.tables import DAILY_PRICE, FX_DAILY, POSITIONS, daily_price, fx_daily, positions, table
from firstprint.plans.weekly import SIGNALS, signals

LAGS, HORIZONS = [6, 3], [1, 2, 3, 4]
SPLIT = dt.date(1998, 6, 1)


TARGETS = ["A", "N", "R"]


def prices(spark, sf):
    """The price series that weekly series are tested against, by ticker."""
    return daily_price(spark, sf).select("ticker", "date", "price")


def against_targets(df):
    """Each row once for every target."""
    return df.withColumn("ticker", F.explode(F.array(*[F.lit(t) for t in TARGETS])))


def cells(spark, sf):
    """The grid as a table: every series against every target, entry lag and horizon."""
    each = lambda values: F.explode(F.array(*[F.lit(v) for v in values]))
    series = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("series")).distinct()
    return against_targets(series).withColumn("entry_lag", each(LAGS)).withColumn("horizon", each(HORIZONS))


@query("asof_forward", "o_orderkey:i ticker day:d obs_date:d obs_value:n", DAILY_PRICE, """result AS (
  SELECT o_orderkey, t.ticker, CAST(o_orderdate AS DATE) AS day, min(p.date) AS obs_date, arg_min(p.price, p.date) AS obs_value
  FROM orders CROSS JOIN (VALUES ('A'), ('N'), ('R')) t(ticker) LEFT JOIN daily_price p ON p.ticker = t.ticker
    AND p.date >= CAST(o_orderdate AS DATE) AND p.date <= CAST(o_orderdate AS DATE) + 7 GROUP BY 1, 2, 3)""")
def asof_forward(spark, sf):
    """Every order against the next price of every ticker."""
    lookup = asof.forward_lookup(prices(spark, sf), ["ticker"], "date", "price")
    left = against_targets(table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")))
    return asof.asof_forward(left, lookup, ["ticker"], "day", "obs")


@query("asof_sweep", "o_orderkey:i ticker day:d next_date:d next_value:n last_date:d last_value:n", DAILY_PRICE, """asked AS (
  SELECT o_orderkey, t.ticker, CAST(o_orderdate AS DATE) AS day FROM orders CROSS JOIN (VALUES ('A'), ('N'), ('R')) t(ticker)), result AS (
  SELECT a.o_orderkey, a.ticker, a.day, CASE WHEN n.date <= a.day + 7 THEN n.date END AS next_date, CASE WHEN n.date <= a.day + 7 THEN n.price END AS next_value,
    l.date AS last_date, l.price AS last_value FROM asked a
  ASOF LEFT JOIN daily_price n ON n.ticker = a.ticker AND n.date >= a.day
  ASOF LEFT JOIN daily_price l ON l.ticker = a.ticker AND l.date <= a.day)""")
def asof_sweep(spark, sf):
    """Every order against the next price of every ticker within a week, and the last one however old."""
    left = against_targets(table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")))
    ahead = asof.asof_sweep(left, prices(spark, sf), ["ticker"], "day", "date", "price", "next", max_gap=7)
    return asof.asof_sweep(ahead, prices(spark, sf), ["ticker"], "day", "date", "price", "last", backward=True)


FORWARD = """entries AS (
  SELECT s.series, p.ticker, s.report_date, g.entry_lag, min(p.date) AS entry_date, arg_min(p.price, p.date) AS entry_value
  FROM positions s CROSS JOIN (VALUES (6), (3)) g(entry_lag)
  JOIN daily_price p ON p.date BETWEEN s.report_date + g.entry_lag AND s.report_date + g.entry_lag + 7
  GROUP BY ALL), forward AS (
  SELECT e.series, e.ticker, e.report_date, e.entry_lag, h.horizon, e.entry_date, min(p.date) AS exit_date,
         ln(arg_min(p.price, p.date) / e.entry_value) AS fwd_return
  FROM entries e CROSS JOIN (VALUES (1), (2), (3), (4)) h(horizon)
  JOIN daily_price p ON p.ticker = e.ticker AND p.date BETWEEN e.entry_date + 7 * h.horizon AND e.entry_date + 7 * h.horizon + 7
  GROUP BY e.series, e.ticker, e.report_date, e.entry_lag, h.horizon, e.entry_date, e.entry_value)"""


def forward(spark, sf, left=None):
    left = positions(spark, sf).select("series", "report_date") if left is None else left
    return asof.grid_returns(left, cells(spark, sf), prices(spark, sf), ["series"], ["ticker"], "report_date", "date", "price")


@query("forward_return", "series ticker report_date:d entry_lag:i horizon:i entry_date:d exit_date:d fwd_return:n",
       POSITIONS, DAILY_PRICE, FORWARD, "result AS (SELECT * FROM forward)")
def forward_return(spark, sf):
    return forward(spark, sf)


# --- Cells --------------------------------------------------------------------------

def pairs(spark, sf):
    """One row per cell and week: the signal and the forward return."""
    keep = ["series", "report_date", "chg1", "chg4", "crowd", "turn"]
    rows = forward(spark, sf, signals(spark, sf).select(*keep))
    return (rows.unpivot(["series", "ticker", "report_date", "entry_lag", "horizon", "fwd_return"],
                         ["chg1", "chg4", "crowd", "turn"], "signal", "x")
            .where(F.col("x").isNotNull()).withColumnRenamed("fwd_return", "y"))


CELL = ["series", "ticker", "entry_lag", "horizon", "signal"]
CELL_SPEC = "series ticker entry_lag:i horizon:i signal"

PAIRS = """pairs AS (
  SELECT series, ticker, report_date, entry_lag, horizon, signal, x, fwd_return AS y FROM (
    SELECT f.*, s.chg1, s.chg4, s.crowd, s.turn FROM forward f JOIN signals s USING (series, report_date))
  UNPIVOT (x FOR signal IN (chg1, chg4, crowd, turn)) WHERE x IS NOT NULL)"""

SCORED = """ranked AS (
  SELECT *, rank() OVER (PARTITION BY series, ticker, entry_lag, horizon, signal ORDER BY x)
           + (count(*) OVER (PARTITION BY series, ticker, entry_lag, horizon, signal, x) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY series, ticker, entry_lag, horizon, signal ORDER BY y)
           + (count(*) OVER (PARTITION BY series, ticker, entry_lag, horizon, signal, y) - 1) / 2.0 AS ry
  FROM pairs), moments AS (
  SELECT series, ticker, entry_lag, horizon, signal, count(*) AS n, avg(rx) AS mx, avg(ry) AS my,
         coalesce(nullif(stddev_pop(rx), 0), 1) AS sx, coalesce(nullif(stddev_pop(ry), 0), 1) AS sy
  FROM ranked GROUP BY ALL), zs AS (
  SELECT r.*, n, (rx - mx) / sx AS zx, (ry - my) / sy AS zy FROM ranked r
  JOIN moments USING (series, ticker, entry_lag, horizon, signal)), rhos AS (
  SELECT series, ticker, entry_lag, horizon, signal, avg(zx * zy) AS rho, avg(zx * zx) AS sxx FROM zs
  GROUP BY ALL), scores AS (
  SELECT zs.*, rho, sxx, zx * (zy - rho * zx) AS u,
         row_number() OVER (PARTITION BY series, ticker, entry_lag, horizon, signal ORDER BY report_date) AS t
  FROM zs JOIN rhos USING (series, ticker, entry_lag, horizon, signal)), autocov AS (
  SELECT a.series, a.ticker, a.entry_lag, a.horizon, a.signal, a.t - b.t AS l, sum(a.u * b.u) / any_value(a.n) AS c
  FROM scores a JOIN scores b ON a.series = b.series AND a.ticker = b.ticker AND a.entry_lag = b.entry_lag AND a.horizon = b.horizon
    AND a.signal = b.signal AND a.t - b.t BETWEEN 0 AND a.horizon GROUP BY ALL), lrv AS (
  SELECT series, ticker, entry_lag, horizon, signal,
         sum(CASE WHEN l = 0 THEN c ELSE 2.0 * (1.0 - l / (horizon + 1.0)) * c END) AS s FROM autocov
  GROUP BY ALL), tstats AS (
  SELECT m.series, m.ticker, m.entry_lag, m.horizon, m.signal, m.n, CASE WHEN n >= 30 THEN rho END AS rho,
         CASE WHEN n >= 30 AND s / nullif(sxx * sxx, 0) / n > 0 THEN rho / sqrt(s / (sxx * sxx) / n) END AS t_nw
  FROM moments m JOIN rhos USING (series, ticker, entry_lag, horizon, signal)
  JOIN lrv USING (series, ticker, entry_lag, horizon, signal))"""

HALVES = """half_ranks AS (
  SELECT *, CASE WHEN report_date < DATE '1998-06-01' THEN 1 ELSE 2 END AS half FROM pairs), half_r AS (
  SELECT *, rank() OVER (PARTITION BY series, ticker, entry_lag, horizon, signal, half ORDER BY x)
           + (count(*) OVER (PARTITION BY series, ticker, entry_lag, horizon, signal, half, x) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY series, ticker, entry_lag, horizon, signal, half ORDER BY y)
           + (count(*) OVER (PARTITION BY series, ticker, entry_lag, horizon, signal, half, y) - 1) / 2.0 AS ry
  FROM half_ranks), half_rho AS (
  SELECT series, ticker, entry_lag, horizon, signal, half, CASE WHEN count(*) >= 30 THEN
         coalesce((avg(rx * ry) - avg(rx) * avg(ry)) / nullif(stddev_pop(rx) * stddev_pop(ry), 0), 0) END AS rho
  FROM half_r GROUP BY ALL), half_wide AS (
  SELECT series, ticker, entry_lag, horizon, signal, max(rho) FILTER (half = 1) AS rho_half1,
         max(rho) FILTER (half = 2) AS rho_half2 FROM half_rho GROUP BY ALL)"""

QUINTILES = """pasts AS (
  SELECT p.*, CASE WHEN p.signal <> 'turn' THEN
    (SELECT CASE WHEN count(*) >= 104 THEN 100.0 * count(*) FILTER (e.x < p.x) / count(*) END FROM pairs e
     WHERE e.series = p.series AND e.ticker = p.ticker AND e.entry_lag = p.entry_lag AND e.horizon = p.horizon AND e.signal = p.signal
       AND e.report_date < p.report_date) END AS past FROM pairs p), sides AS (
  SELECT *, CASE WHEN signal = 'turn' THEN sign(x) WHEN past >= 80 THEN 1 WHEN past < 20 THEN -1 ELSE 0 END AS side
  FROM pasts), quintiles AS (
  SELECT series, ticker, entry_lag, horizon, signal, (avg(y) FILTER (side = 1) - avg(y) FILTER (side = -1)) * 100
           AS top_minus_bottom_pct, count(*) FILTER (side = 1) AS top_n, count(*) FILTER (side = -1) AS bottom_n
  FROM sides GROUP BY ALL)"""

VERDICT = """CASE WHEN abs(t_nw) >= 2.5 AND rho_half1 IS NOT NULL AND rho_half2 IS NOT NULL
    AND (rho_half1 > 0) = (rho_half2 > 0) AND (rho_half2 > 0) = (rho > 0) THEN 'yes' ELSE '' END AS consistent"""
BASE = (POSITIONS, DAILY_PRICE, SIGNALS, FORWARD, PAIRS)


@query("spearman_corr", f"{CELL_SPEC} n:i rho:n", *BASE, SCORED, "result AS (SELECT * FROM tstats)")
def spearman_corr(spark, sf):
    return stats.spearman_corr(pairs(spark, sf), CELL, "x", "y")


@query("newey_west_t", f"{CELL_SPEC} n:i rho:n t_nw:n", *BASE, SCORED, "result AS (SELECT * FROM tstats)")
def newey_west_t(spark, sf):
    return stats.newey_west_t(pairs(spark, sf), CELL, "report_date", "x", "y", "horizon")


@query("quintile_spread", f"{CELL_SPEC} top_minus_bottom_pct:n top_n:i bottom_n:i", *BASE, QUINTILES,
       "result AS (SELECT * FROM quintiles)")
def quintile_spread(spark, sf):
    return stats.quintile_spread(pairs(spark, sf), CELL, "report_date", "x", "y", 104,
                                 turn=F.col("signal") == "turn")


@query("split_half_consistency", f"{CELL_SPEC} n:i rho:n t_nw:n rho_half1:n rho_half2:n consistent",
       *BASE, SCORED, HALVES, f"""result AS (
  SELECT t.*, rho_half1, rho_half2, {VERDICT}
  FROM tstats t LEFT JOIN half_wide USING (series, ticker, entry_lag, horizon, signal))""")
def split_half_consistency(spark, sf):
    return stats.split_half_consistency(pairs(spark, sf), CELL, "report_date", SPLIT, "x", "y", "horizon")


@query("signal_grid", f"{CELL_SPEC} n:i rho:n t_nw:n top_minus_bottom_pct:n top_n:i bottom_n:i rho_half1:n "
       "rho_half2:n consistent", *BASE, SCORED, HALVES, QUINTILES, f"""result AS (
  SELECT t.*, top_minus_bottom_pct, top_n, bottom_n, rho_half1, rho_half2, {VERDICT}
  FROM tstats t LEFT JOIN half_wide USING (series, ticker, entry_lag, horizon, signal)
  LEFT JOIN quintiles USING (series, ticker, entry_lag, horizon, signal))""")
def signal_grid(spark, sf):
    return stats.signal_grid(pairs(spark, sf), CELL, "report_date", "x", "y", SPLIT)


# --- Controls -------------------------------------------------------------------------

def controls(spark, sf):
    """Every series against every target, whose flow and price share a name."""
    flow = fx_daily(spark, sf).select(F.col("quote").alias("ticker"), "date", F.col("rate").alias("price"))
    left = against_targets(signals(spark, sf).select("series", "report_date", "chg1", "chg4", "crowd"))
    return asof.multi_asof_controls(left, flow, prices(spark, sf), ["ticker"], "report_date", "date", "price", HORIZONS)


CONTROLS = """c0 AS (
  SELECT s.series, f.quote AS ticker, s.report_date, s.chg1, s.chg4, s.crowd, min(f.date) AS entry_date,
         arg_min(f.rate, f.date) AS entry_value FROM signals s
  JOIN fx_daily f ON f.date BETWEEN s.report_date + 6 AND s.report_date + 13 GROUP BY ALL), c1 AS (
  SELECT c0.*, (SELECT arg_min(rate, date) FROM fx_daily
      WHERE quote = ticker AND date BETWEEN entry_date - 28 AND entry_date - 21) AS past_value,
    (SELECT arg_min(price, date) FROM daily_price p
      WHERE p.ticker = c0.ticker AND date BETWEEN entry_date AND entry_date + 7) AS p_now,
    (SELECT arg_min(price, date) FROM daily_price p
      WHERE p.ticker = c0.ticker AND date BETWEEN entry_date - 28 AND entry_date - 21) AS p_past
  FROM c0), c2 AS (
  SELECT c1.*, h.horizon, (SELECT arg_min(rate, date) FROM fx_daily
     WHERE quote = ticker AND date BETWEEN entry_date + 7 * h.horizon AND entry_date + 7 * h.horizon + 7) AS exit_value
  FROM c1 CROSS JOIN (VALUES (1), (2), (3), (4)) h(horizon)), controls AS (
  SELECT *, ln(exit_value / entry_value) AS y, ln(entry_value / past_value) AS past_flow,
         ln(p_now / p_past) AS past_price
  FROM c2 WHERE exit_value IS NOT NULL AND past_value IS NOT NULL AND p_now IS NOT NULL AND p_past IS NOT NULL)"""


@query("multi_asof_controls", "series ticker report_date:d horizon:i entry_date:d y:n past_flow:n past_price:n",
       POSITIONS, DAILY_PRICE, FX_DAILY, SIGNALS, CONTROLS, "result AS (SELECT * FROM controls)")
def multi_asof_controls(spark, sf):
    return controls(spark, sf)


# The same regression written out: the 3x3 correlation matrix inverted by its
# adjugate, and lagged products of the scores taken by self-join.
OLS = """cells AS (
  SELECT series, ticker, report_date, horizon, signal, x, y, past_flow, past_price FROM controls
  UNPIVOT (x FOR signal IN (chg1, chg4, crowd)) WHERE x IS NOT NULL), m AS (
  SELECT series, ticker, horizon, signal, count(*) AS n, avg(x) mx, avg(past_flow) mf, avg(past_price) mp, avg(y) my,
    coalesce(nullif(stddev_pop(x), 0), 1) sx, coalesce(nullif(stddev_pop(past_flow), 0), 1) sf,
    coalesce(nullif(stddev_pop(past_price), 0), 1) sp, coalesce(nullif(stddev_pop(y), 0), 1) sy
  FROM cells GROUP BY ALL), z AS (
  SELECT c.series, c.ticker, c.horizon, c.signal, report_date, n, (x - mx) / sx AS a, (past_flow - mf) / sf AS b,
         (past_price - mp) / sp AS c, (y - my) / sy AS w
  FROM cells c JOIN m USING (series, ticker, horizon, signal) WHERE n >= 100), g AS (
  SELECT series, ticker, horizon, signal, avg(a*a) aa, avg(a*b) ab, avg(a*c) ac, avg(b*b) bb, avg(b*c) bc, avg(c*c) cc,
         avg(a*w) aw, avg(b*w) bw, avg(c*w) cw FROM z GROUP BY ALL), inv AS (
  SELECT *, aa*(bb*cc-bc*bc) - ab*(ab*cc-bc*ac) + ac*(ab*bc-bb*ac) AS det FROM g), inv2 AS (
  SELECT *, (bb*cc-bc*bc)/det i11, (ac*bc-ab*cc)/det i12, (ab*bc-ac*bb)/det i13, (aa*cc-ac*ac)/det i22,
         (ab*ac-aa*bc)/det i23, (aa*bb-ab*ab)/det i33 FROM inv), beta AS (
  SELECT *, i11*aw+i12*bw+i13*cw b1, i12*aw+i22*bw+i23*cw b2, i13*aw+i23*bw+i33*cw b3 FROM inv2), q AS (
  SELECT z.series, z.ticker, z.horizon, z.signal, n, b1, b2, b3,
         row_number() OVER (PARTITION BY z.series, z.ticker, z.horizon, z.signal ORDER BY report_date) AS t,
         (w-b1*a-b2*b-b3*c)*(i11*a+i12*b+i13*c)/n q1, (w-b1*a-b2*b-b3*c)*(i12*a+i22*b+i23*c)/n q2,
         (w-b1*a-b2*b-b3*c)*(i13*a+i23*b+i33*c)/n q3
  FROM z JOIN beta USING (series, ticker, horizon, signal)), v AS (
  SELECT p.series, p.ticker, p.horizon, p.signal, any_value(p.n) AS n, any_value(p.b1) b1, any_value(p.b2) b2, any_value(p.b3) b3,
    sum(CASE WHEN p.t = r.t THEN 1.0 ELSE 2.0 * (1.0 - (p.t - r.t) / (p.horizon + 1.0)) END * p.q1 * r.q1) v1,
    sum(CASE WHEN p.t = r.t THEN 1.0 ELSE 2.0 * (1.0 - (p.t - r.t) / (p.horizon + 1.0)) END * p.q2 * r.q2) v2,
    sum(CASE WHEN p.t = r.t THEN 1.0 ELSE 2.0 * (1.0 - (p.t - r.t) / (p.horizon + 1.0)) END * p.q3 * r.q3) v3
  FROM q p JOIN q r ON p.series = r.series AND p.ticker = r.ticker AND p.horizon = r.horizon AND p.signal = r.signal
    AND p.t - r.t BETWEEN 0 AND p.horizon GROUP BY ALL)"""


@query("ols_hac", "series ticker horizon:i signal n:i coef_signal:n t_signal:n t_past_flow:n t_past_price:n",
       POSITIONS, DAILY_PRICE, FX_DAILY, SIGNALS, CONTROLS, OLS, """result AS (
  SELECT series, ticker, horizon, signal, n, b1 AS coef_signal, CASE WHEN v1 > 0 THEN b1 / sqrt(v1) END AS t_signal,
         CASE WHEN v2 > 0 THEN b2 / sqrt(v2) END AS t_past_flow, CASE WHEN v3 > 0 THEN b3 / sqrt(v3) END AS t_past_price
  FROM v)""")
def ols_hac(spark, sf):
    rows = (controls(spark, sf)
            .unpivot(["series", "ticker", "report_date", "horizon", "y", "past_flow", "past_price"],
                     ["chg1", "chg4", "crowd"], "signal", "x").where(F.col("x").isNotNull()))
    return stats.ols_hac(rows, ["series", "ticker", "horizon", "signal"], "report_date", "y",
                         ["x", "past_flow", "past_price"], "horizon")


# Two regressors have a closed form.
PAIR = """cells AS (
  SELECT series, ticker, report_date, horizon, signal, x, y, past_flow FROM controls
  UNPIVOT (x FOR signal IN (chg1, chg4, crowd)) WHERE x IS NOT NULL), m AS (
  SELECT series, ticker, horizon, signal, count(*) AS n, avg(x) mx, avg(past_flow) mf, avg(y) my,
    coalesce(nullif(stddev_pop(x), 0), 1) sx, coalesce(nullif(stddev_pop(past_flow), 0), 1) sf, coalesce(nullif(stddev_pop(y), 0), 1) sy
  FROM cells GROUP BY ALL), z AS (
  SELECT c.series, c.ticker, c.horizon, c.signal, report_date, n, (x - mx) / sx AS a, (past_flow - mf) / sf AS b, (y - my) / sy AS w
  FROM cells c JOIN m USING (series, ticker, horizon, signal) WHERE n >= 100), g AS (
  SELECT series, ticker, horizon, signal, avg(a*a) aa, avg(a*b) ab, avg(b*b) bb, avg(a*w) aw, avg(b*w) bw FROM z GROUP BY ALL), beta AS (
  SELECT *, aa*bb - ab*ab AS det, (bb*aw - ab*bw) / (aa*bb - ab*ab) AS b1, (aa*bw - ab*aw) / (aa*bb - ab*ab) AS b2 FROM g), q AS (
  SELECT z.series, z.ticker, z.horizon, z.signal, n, b1, b2,
    row_number() OVER (PARTITION BY z.series, z.ticker, z.horizon, z.signal ORDER BY report_date) AS t,
    (w-b1*a-b2*b)*(bb*a-ab*b)/det/n q1, (w-b1*a-b2*b)*(aa*b-ab*a)/det/n q2 FROM z JOIN beta USING (series, ticker, horizon, signal)), v AS (
  SELECT p.series, p.ticker, p.horizon, p.signal, any_value(p.n) AS n, any_value(p.b1) b1, any_value(p.b2) b2,
    sum(CASE WHEN p.t = r.t THEN 1.0 ELSE 2.0 * (1.0 - (p.t - r.t) / (p.horizon + 1.0)) END * p.q1 * r.q1) v1,
    sum(CASE WHEN p.t = r.t THEN 1.0 ELSE 2.0 * (1.0 - (p.t - r.t) / (p.horizon + 1.0)) END * p.q2 * r.q2) v2
  FROM q p JOIN q r ON p.series = r.series AND p.ticker = r.ticker AND p.horizon = r.horizon AND p.signal = r.signal
    AND p.t - r.t BETWEEN 0 AND p.horizon GROUP BY ALL)"""


@query("ols_hac_regressors", "series ticker horizon:i signal n:i coef_x:n coef_past_flow:n t_x:n t_past_flow:n",
       POSITIONS, DAILY_PRICE, FX_DAILY, SIGNALS, CONTROLS, PAIR, """result AS (
  SELECT series, ticker, horizon, signal, n, b1 AS coef_x, b2 AS coef_past_flow, CASE WHEN v1 > 0 THEN b1 / sqrt(v1) END AS t_x,
    CASE WHEN v2 > 0 THEN b2 / sqrt(v2) END AS t_past_flow FROM v)""")
def ols_hac_regressors(spark, sf):
    """The signal beside one control."""
    rows = (controls(spark, sf).unpivot(["series", "ticker", "report_date", "horizon", "y", "past_flow"], ["chg1", "chg4", "crowd"], "signal", "x")
            .where(F.col("x").isNotNull()))
    return stats.ols_hac_cells(rows, ["series", "ticker", "horizon", "signal"], "report_date", "y", ["x", "past_flow"], "horizon")
