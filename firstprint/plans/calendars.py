"""Trading calendar, event calendar and interval overlaps over the tables."""

from pyspark.sql import functions as F

from firstprint.functions.fixed_values import EASTER_SUNDAYS
from firstprint.operators import asof, calendar as C
from firstprint.plans.registry import query
from firstprint.plans.tables import table

# The calendar written out: holidays per year by rule, then one row per day.
# Easter here comes from the published dates.
DAYS = f"""days AS (
  SELECT CAST(unnest(generate_series((SELECT date_trunc('year', min(o_orderdate)) FROM orders) - INTERVAL 12 MONTH,
    (SELECT date_trunc('year', max(o_orderdate)) FROM orders) + INTERVAL 24 MONTH - INTERVAL 1 DAY,
    INTERVAL 1 DAY)) AS DATE) AS day), years AS (SELECT DISTINCT year(day) AS y FROM days), easters AS (
  SELECT CAST(unnest({EASTER_SUNDAYS}) AS DATE) AS easter), fixed AS (
  SELECT make_date(y, m, d) AS h FROM years CROSS JOIN (VALUES (1, 1), (6, 19), (7, 4), (12, 25)) t(m, d)), holidays AS (
  SELECT CASE isodow(h) WHEN 6 THEN h - 1 WHEN 7 THEN h + 1 ELSE h END AS h FROM fixed
  WHERE NOT (isodow(h) = 6 AND month(h) = 1)
  UNION SELECT easter - 2 FROM easters
  UNION SELECT max(day) FROM days WHERE month(day) = 5 AND isodow(day) = 1 GROUP BY year(day)
  UNION SELECT day FROM days WHERE isodow(day) = 1 AND month(day) IN (1, 2) AND day(day) BETWEEN 15 AND 21
  UNION SELECT day FROM days WHERE isodow(day) = 1 AND month(day) = 9 AND day(day) <= 7
  UNION SELECT day FROM days WHERE isodow(day) = 4 AND month(day) = 11 AND day(day) BETWEEN 22 AND 28), trading AS (
  SELECT day, row_number() OVER (ORDER BY day) AS k FROM days
  WHERE isodow(day) < 6 AND day NOT IN (SELECT h FROM holidays))"""


def calendar(spark, sf):
    """Every day from the year before the first order to the year after the last."""
    span = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    first = F.add_months(F.trunc("a", "year"), -12)
    last = F.date_sub(F.add_months(F.trunc("b", "year"), 24), F.lit(1))
    return C.calendar_of(span.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("day")))


@query("trading_calendar", "day:d n:i is_trading:b next_trading:d previous_trading:d plus_ten:d from_month_end:i",
       DAYS, """ordered AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)""",
       """result AS (
  SELECT o.day, o.n, t.k IS NOT NULL AS is_trading, (SELECT min(day) FROM trading x WHERE x.day >= o.day) AS next_trading,
         (SELECT max(day) FROM trading x WHERE x.day <= o.day) AS previous_trading,
         (SELECT day FROM trading x WHERE x.k = 10 + (SELECT count(*) FROM trading z WHERE z.day <= o.day)) AS plus_ten,
         (SELECT count(*) FROM trading x WHERE x.day >= o.day AND date_trunc('month', x.day) = date_trunc('month', o.day))
           AS from_month_end
  FROM ordered o LEFT JOIN trading t USING (day))""")
def trading_calendar(spark, sf):
    days = calendar(spark, sf)
    ordered = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return C.add_trading_days(ordered.join(days, "day", "left"), "day", days, 10, "plus_ten")


EVENTS = """months AS (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS m FROM days), lasts AS (
  SELECT CAST(date_trunc('month', day) AS DATE) AS m, day,
         row_number() OVER (PARTITION BY date_trunc('month', day) ORDER BY day DESC) AS r FROM trading), quarters AS (
  SELECT m, (SELECT min(day) FROM trading t WHERE t.day >= last_day(m) + 45) AS deadline
  FROM months WHERE month(m) IN (3, 6, 9, 12)), settles AS (
  SELECT m, (SELECT max(day) FROM trading t WHERE t.day <= m + 14) AS s FROM months
  UNION ALL SELECT m, day FROM lasts WHERE r = 1), all_events AS (
  SELECT min(day) AS "start", max(day) AS "end",
         CASE WHEN month(m) IN (3, 6, 9, 12) THEN 'rebalance_quarter' ELSE 'rebalance_month' END AS kind, 'rule' AS basis
  FROM lasts WHERE r <= 5 GROUP BY m
  UNION ALL SELECT x, x, 'expiry', 'rule' FROM (SELECT (SELECT max(t.day) FROM trading t WHERE t.day <= d.day) AS x
    FROM days d WHERE isodow(d.day) = 5 AND day(d.day) BETWEEN 15 AND 21 AND month(d.day) IN (3, 6, 9, 12))
  UNION ALL SELECT deadline, deadline, '13f', 'rule' FROM quarters
  UNION ALL SELECT deadline + 3, deadline + 10, 'trend_monitor', 'estimate' FROM quarters
  UNION ALL SELECT p, p, 'short_interest', 'estimate' FROM (SELECT (SELECT t.day FROM trading t WHERE t.k = 7 +
    (SELECT k FROM trading z WHERE z.day = s)) AS p FROM settles))"""


NEAR = """near AS (
  SELECT * FROM all_events WHERE "end" >= (SELECT CAST(min(o_orderdate) AS DATE) FROM orders)
    AND "start" <= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders))"""


def events(spark, sf):
    """The dated events of the whole span of the orders."""
    day = F.to_date("o_orderdate")
    first, last = (table(spark, sf, "orders").select(f(day)).scalar() for f in (F.min, F.max))
    return C.event_calendar(calendar(spark, sf), first, F.date_diff(last, first))


@query("event_calendar", "start:d end:d kind basis n_orders:i", DAYS, EVENTS, NEAR, """result AS (
  SELECT dated.*, count(*) AS n_orders FROM (SELECT DISTINCT * FROM near) dated JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN "start" AND "end" GROUP BY ALL)""")
def event_calendar(spark, sf):
    """Every dated event with the orders placed in it; an event without any is left out."""
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("a"), F.to_date("o_orderdate").alias("b"))
    return asof.overlap_counts(events(spark, sf).distinct(), days, ("start", "end"), ("a", "b"), [], "n_orders")


@query("interval_overlap", "kind start:d end:d o_orderpriority n:i", DAYS, EVENTS, NEAR, """spans AS (
  SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)""", """result AS (
  SELECT kind, "start", "end", o_orderpriority, count(*) AS n FROM (SELECT DISTINCT kind, "start", "end" FROM near)
  JOIN spans ON a <= "end" AND b >= "start" AND a <= b GROUP BY 1, 2, 3, 4)""")
def interval_overlap(spark, sf):
    """Orders still open during each dated event, by priority."""
    shipped = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
               .agg(F.to_date(F.max("l_shipdate")).alias("b")))
    spans = (table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("a"))
             .join(shipped, "o_orderkey"))
    dated = events(spark, sf).select("kind", "start", "end").distinct()
    return asof.overlap_counts(dated, spans, ("start", "end"), ("a", "b"), ["o_orderpriority"])
