"""Screening and record-keeping rules over the driver tables."""

import datetime as dt

from pyspark.sql import functions as F

from firstprint.functions.text import story_key
from firstprint.operators import asof, screen as S
from firstprint.plans.grid import against_targets, prices
from firstprint.plans.registry import query
from firstprint.plans.tables import DAILY_PRICE, RELEASE, money, release, table
from firstprint.session import materialize


@query("liquidity_gate", "supplier:i day:d adv:f capacity:f passes:b", """daily AS (
  SELECT l_suppkey AS supplier, CAST(l_shipdate AS DATE) AS day, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
  FROM lineitem GROUP BY 1, 2), averaged AS (
  SELECT supplier, day, CAST(sum(v) OVER w AS DOUBLE) / count(*) OVER w AS adv,
         day - min(day) OVER (PARTITION BY supplier) + 1 >= 30 AS known FROM daily
  WINDOW w AS (PARTITION BY supplier ORDER BY day RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW))""",
       """result AS (
  SELECT supplier, day, adv, adv * 0.1 * 5 AS capacity, known AND adv * 0.1 * 5 >= 20000 AS passes FROM averaged)""")
def liquidity_gate(spark, sf):
    daily = (table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("supplier"), F.to_date("l_shipdate").alias("day"))
             .agg(F.sum(money("l_extendedprice")).alias("v")))
    return S.liquidity_gate(daily, "supplier", "day", "v", 20000)


@query("universe_dedup", "p_name p_partkey:i p_retailprice:n", """result AS (
  SELECT p_name, p_partkey, p_retailprice FROM part WHERE p_type = 'ECONOMY' AND p_retailprice >= 905
  QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_retailprice DESC, p_partkey DESC) = 1)""")
def universe_dedup(spark, sf):
    return S.universe_dedup(table(spark, sf, "part"), "p_name", "p_type", "p_retailprice", 905.0,
                            [F.col("p_retailprice"), F.col("p_partkey")], "ECONOMY")


# --- Funnel -----------------------------------------------------------------------------

def customer_facts(spark, sf, until=None):
    orders = table(spark, sf, "orders")
    if until is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    value = money("o_totalprice")
    facts = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).cast("double").alias("total"),
        F.coalesce(F.sum(F.when(F.year("o_orderdate") >= 1998, value)), F.lit(0)).cast("double").alias("late"),
        F.count_if(F.col("o_orderstatus") == "P").alias("pending"))
    return table(spark, sf, "customer").join(facts, "c_custkey")


def _facts_sql(name: str, where: str) -> str:
    return f"""{name} AS (
  SELECT c.*, f.* EXCLUDE (o_custkey) FROM customer c JOIN (
    SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
      CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (year(o_orderdate) >= 1998), 0) AS DOUBLE) AS late,
      count(*) FILTER (o_orderstatus = 'P') AS pending FROM orders WHERE {where} GROUP BY 1) f ON c_custkey = o_custkey)"""


FACTS = _facts_sql("facts", "true")


def tests():
    return {"ruin": F.col("c_acctbal") >= 0, "return": F.col("total") / F.col("n") >= 200000,
            "quality": F.col("late") >= F.col("total") * 0.4, "dilution": F.col("pending") <= 4}


FIRST_FAIL = """CASE WHEN c_acctbal < 0 THEN 'ruin' WHEN total / n < 200000 THEN 'return'
    WHEN late < total * 0.4 THEN 'quality' WHEN pending > 4 THEN 'dilution' END AS first_fail"""


@query("screen_funnel", "c_custkey:i first_fail newly_passing:b", FACTS,
       _facts_sql("before", "o_orderdate < TIMESTAMP '2001-01-01'"), f"""result AS (
  SELECT a.c_custkey, a.first_fail, a.first_fail IS NULL AND (b.c_custkey IS NULL OR b.first_fail IS NOT NULL)
    AS newly_passing FROM (SELECT c_custkey, {FIRST_FAIL} FROM facts) a
  LEFT JOIN (SELECT c_custkey, {FIRST_FAIL} FROM before) b USING (c_custkey))""")
def screen_funnel(spark, sf):
    now = S.screen_funnel(customer_facts(spark, sf), tests())
    before = S.screen_funnel(customer_facts(spark, sf, dt.datetime(2001, 1, 1)), tests())
    fresh = S.newly_passing(before, now, "c_custkey").select("c_custkey", F.lit(True).alias("newly_passing"))
    return now.join(fresh, "c_custkey", "left").fillna(False, ["newly_passing"])


@query("funnel_counts", "stage survivors:i", FACTS, f"""failed AS (SELECT {FIRST_FAIL} FROM facts)""", """result AS (
  SELECT stage, (SELECT count(*) FROM failed WHERE first_fail IS NULL OR
    CASE first_fail WHEN 'ruin' THEN 1 WHEN 'return' THEN 2 WHEN 'quality' THEN 3 ELSE 4 END > i) AS survivors
  FROM (VALUES ('ruin', 1), ('return', 2), ('quality', 3), ('dilution', 4)) t(stage, i))""")
def funnel_counts(spark, sf):
    return S.funnel_counts(S.screen_funnel(customer_facts(spark, sf), tests()), list(tests()))


@query("three_year_return", "nation:i year:i return_3y:n passes:b", """yearly AS (
  SELECT s_nationkey AS nation, year(l_shipdate) AS year,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2)) * 100) AS DOUBLE) AS profit,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS capital,
    CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R'), 0) AS DOUBLE) AS building
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2), rates AS (
  SELECT nation, year, 100.0 * profit / (capital - building) AS r FROM yearly WHERE capital > building)""", """result AS (
  SELECT y.nation, y.year, m.r3 AS return_3y, m.r3 >= 12 AS passes FROM yearly y LEFT JOIN (
    SELECT a.nation, a.year, (a.r + b.r + c.r) / 3 AS r3 FROM rates a JOIN rates b ON a.nation = b.nation AND b.year = a.year - 1
    JOIN rates c ON a.nation = c.nation AND c.year = a.year - 2) m ON m.nation = y.nation AND m.year = y.year)""")
def three_year_return(spark, sf):
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    price = money("l_extendedprice")
    yearly = (table(spark, sf, "lineitem").join(supplier, "l_suppkey").groupBy("nation", F.year("l_shipdate").alias("year"))
              .agg(F.sum(money("l_quantity") * 100).cast("double").alias("profit"), F.sum(price).cast("double").alias("capital"),
                   F.coalesce(F.sum(F.when(F.col("l_returnflag") == "R", price)), F.lit(0)).cast("double").alias("building")))
    return S.three_year_return(yearly, "nation", "year", "profit", "capital", "building")


@query("rank_score_topk", "c_custkey:i score:n", FACTS, """result AS (
  SELECT c_custkey, greatest(0.0, least(10.0, 10.0 * (c_acctbal - 0.0) / 10000.0))
    + greatest(0.0, least(10.0, 10.0 * (total - 0.0) / 5000000.0))
    + greatest(0.0, least(10.0, 10.0 * (n - 20.0) / -20.0)) + greatest(0.0, least(10.0, 10.0 * (pending - 10.0) / -10.0)) AS score
  FROM facts ORDER BY score DESC, c_custkey LIMIT 40)""")
def rank_score_topk(spark, sf):
    scores = {"price": (F.col("c_acctbal"), 0.0, 10000.0), "growth": (F.col("total"), 0.0, 5000000.0),
              "coverage": (F.col("n"), 20.0, 0.0), "overlap": (F.col("pending"), 10.0, 0.0)}
    return S.rank_score_topk(customer_facts(spark, sf), "c_custkey", scores, 40)


@query("price_test_bands", "c_custkey:i estimated_return:n price_band", FACTS, """estimates AS (
  SELECT c_custkey, c_acctbal / 1000.0 + least(20.0 * late / total, CAST(n AS DOUBLE), 12.0) AS estimated_return FROM facts)""",
       """result AS (SELECT *, CASE WHEN estimated_return >= 15 THEN 'pass' WHEN estimated_return >= 10 THEN 'second list'
  ELSE 'fail' END AS price_band FROM estimates)""")
def price_test_bands(spark, sf):
    return customer_facts(spark, sf).select("c_custkey", *S.price_test_bands(
        F.col("c_acctbal") / 1000.0, 20.0 * F.col("late") / F.col("total"), F.col("n").cast("double")))


@query("brier_calibration", "lang band:n n:i brier:n stated:n realised:n overconfident:b", """forecasts AS (
  SELECT lang, (n_chars % 997) / 997.0 AS p, quality AS o FROM labels JOIN documents USING (doc_id)
  WHERE quality IS NOT NULL)""", """result AS (
  SELECT lang, round(least(floor(p / 0.1), 9) * 0.1, 2) AS band, count(*) AS n, avg((p - o) * (p - o)) AS brier,
         avg(p) AS stated, avg(CAST(o AS DOUBLE)) AS realised, avg(p) > avg(CAST(o AS DOUBLE)) AS overconfident
  FROM forecasts GROUP BY 1, 2)""")
def brier_calibration(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", (F.pmod(F.col("n_chars"), F.lit(997)) / 997.0).alias("p"))
    rows = table(spark, sf, "labels").where(F.col("quality").isNotNull()).join(docs, "doc_id")
    return S.brier_calibration(rows, ["lang"], "p", "quality")


@query("brier_quarterly", "quarter band:n n:i brier:n stated:n realised:n overconfident:b", """forecasts AS (
  SELECT year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter, (CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) % 997) / 997.0 AS p,
    CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS o FROM orders WHERE o_orderstatus <> 'P')""", """result AS (
  SELECT quarter, round(least(floor(p / 0.1), 9) * 0.1, 2) AS band, count(*) AS n, avg((p - o) * (p - o)) AS brier,
         avg(p) AS stated, avg(CAST(o AS DOUBLE)) AS realised, avg(p) > avg(CAST(o AS DOUBLE)) AS overconfident
  FROM forecasts GROUP BY 1, 2)""")
def brier_quarterly(spark, sf):
    """Calibration by quarter of resolution; what is pending has not resolved."""
    cents = (money("o_totalprice") * 100).cast("bigint")
    quarter = F.concat(F.year("o_orderdate"), F.lit("-Q"), F.quarter("o_orderdate"))
    rows = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P").select(
        quarter.alias("quarter"), (F.pmod(cents, F.lit(997)) / 997.0).alias("p"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("o"))
    return S.brier_calibration(rows, ["quarter"], "p", "o")


# --- Genealogy ------------------------------------------------------------------------------

def claims(spark, sf):
    """Documents as claims: a copy points at the first full copy, that one at the
    first with the same opening line, and that one at the first of its outlet."""
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars", story_key("text").alias("k1"),
        story_key(F.split("text", "\n")[0]).alias("k2"), F.concat_ws("|", "lang", "source").alias("k3"))
    docs, _ = materialize(docs, "story-keys")  # every step below reads the keys, none the texts again
    for key in ("k1", "k2", "k3"):
        docs = docs.join(docs.groupBy(key).agg(F.min("doc_id").alias(f"first_{key}")), key)
    parent = F.coalesce(*[F.when(F.col(f"first_{k}") != F.col("doc_id"), F.col(f"first_{k}")) for k in ("k1", "k2", "k3")])
    return docs.select("doc_id", "lang", "source", parent.alias("parent"), (F.col("n_chars") >= 400).alias("is_primary"),
                       (F.pmod(F.col("n_chars"), F.lit(2)) == 0).alias("resolved"))


CLAIMS = """keyed AS (
  SELECT doc_id, lang, source, n_chars, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS k1,
    trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9]+', ' ', 'g')) AS k2, lang || '|' || source AS k3
  FROM documents), firsts AS (
  SELECT *, min(doc_id) OVER (PARTITION BY k1) AS f1, min(doc_id) OVER (PARTITION BY k2) AS f2,
         min(doc_id) OVER (PARTITION BY k3) AS f3 FROM keyed), claims AS (
  SELECT doc_id, lang, source, CASE WHEN f1 <> doc_id THEN f1 WHEN f2 <> doc_id THEN f2 WHEN f3 <> doc_id THEN f3 END
    AS parent, n_chars >= 400 AS is_primary, n_chars % 2 = 0 AS resolved FROM firsts), walk AS (
  SELECT doc_id, doc_id AS at, parent FROM claims
  UNION ALL SELECT w.doc_id, c.doc_id, c.parent FROM walk w JOIN claims c ON c.doc_id = w.parent), roots AS (
  SELECT c.*, w.at AS root FROM claims c JOIN walk w ON w.doc_id = c.doc_id AND w.parent IS NULL), points AS (
  SELECT lang, source, count(DISTINCT root) AS r FROM roots GROUP BY 1, 2)"""


@query("evidence_genealogy", "lang raw_sources:i distinct_roots:i primary_sources:i corroborated_points:i unresolved:i",
       CLAIMS, """result AS (
  SELECT lang, count(*) AS raw_sources, count(DISTINCT root) AS distinct_roots,
         count(*) FILTER (is_primary) AS primary_sources, count(*) FILTER (NOT resolved) AS unresolved,
         (SELECT count(*) FROM points p WHERE p.lang = r.lang AND p.r >= 2) AS corroborated_points
  FROM roots r GROUP BY lang)""", recursive=True)
def evidence_genealogy(spark, sf):
    return S.evidence_genealogy(claims(spark, sf), "lang", "doc_id", "parent", "is_primary", "resolved", "source")


@query("root_sources", "doc_id:i root:i", CLAIMS, "result AS (SELECT doc_id, root FROM roots)", recursive=True)
def root_sources(spark, sf):
    return S.root_sources(claims(spark, sf), "doc_id", "parent")


# --- Scorecard, windows, exposure ---------------------------------------------------------

@query("weighted_scorecard", "s_suppkey:i score:n decision", """pillars AS (
  SELECT s_suppkey, s_acctbal, CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) * 100 / count(*) AS a,
    CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) * 100 / count(*) AS b,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 5 AS c,
    10.0 * count(*) FILTER (l_returnflag = 'N') / count(*) AS d, 10.0 * count(*) FILTER (l_linestatus = 'F') / count(*) AS e,
    10.0 * count(*) FILTER (l_linenumber <= 3) / count(*) AS f, 10.0 * count(*) FILTER (l_returnflag = 'A') / count(*) AS g,
    count(*) FILTER (l_returnflag = 'R') * 1.0 / count(*) > 0.36 AS o
  FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1, 2)""", """result AS (
  SELECT s_suppkey, (15*a + 15*b + 10*c + 15*d + 15*e + 20*f + 10*g) / 100.0 AS score,
    CASE WHEN s_acctbal < 0 THEN 'rejected' WHEN o THEN 'blocked' WHEN s_acctbal < 1000 THEN 'capped' ELSE 'may advance' END
      AS decision FROM pillars)""")
def weighted_scorecard(spark, sf):
    n = F.count(F.lit(1))
    mean = lambda c: F.sum(money(c)).cast("double") / n
    tenth = lambda cond: 10.0 * F.count_if(cond) / n
    pillars = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        (mean("l_discount") * 100).alias("claim_reality"), (mean("l_tax") * 100).alias("control_capture"),
        (mean("l_quantity") / 5).alias("duration"), tenth(F.col("l_returnflag") == "N").alias("financial_translation"),
        tenth(F.col("l_linestatus") == "F").alias("mispricing"), tenth(F.col("l_linenumber") <= 3).alias("valuation_payoff"),
        tenth(F.col("l_returnflag") == "A").alias("implementability"),
        (F.count_if(F.col("l_returnflag") == "R") / n > 0.36).alias("failed_test"))
    balance = F.col("s_acctbal")
    gate = F.when(balance < 0, "Veto").when(balance < 1000, "Cap").otherwise("Pass")
    return S.weighted_scorecard(table(spark, sf, "supplier").join(pillars, "s_suppkey").withColumn("gate", gate),
                                "gate", ["failed_test"])


TODAY = dt.date(2001, 8, 1)


@query("window_lapse_and_stale", "finding key:i since:d", """lapsed AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 30 AS b FROM orders o
  WHERE CAST(o_orderdate AS DATE) + 30 < DATE '2001-08-01' AND NOT EXISTS (SELECT 1 FROM lineitem l
    WHERE l.l_orderkey = o.o_orderkey AND CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE)
      AND CAST(o_orderdate AS DATE) + 30))""", """result AS (
  SELECT 'lapsed window' AS finding, o_orderkey AS key, b AS since FROM lapsed
  UNION ALL SELECT 'stale entry', o_custkey, CAST(max(o_orderdate) AS DATE) FROM orders GROUP BY o_custkey
  HAVING CAST(max(o_orderdate) AS DATE) + INTERVAL 6 MONTH < DATE '2001-08-01')""")
def window_lapse_and_stale(spark, sf):
    orders = table(spark, sf, "orders")
    windows = orders.select("o_orderkey", F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), 30).alias("b"))
    decisions = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("decided"))
    lapsed = S.window_lapse(windows, decisions, "o_orderkey", "a", "b", "decided", F.lit(TODAY))
    entries = orders.groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("confirmed"))
    stale = S.stale_entries(entries, "confirmed", F.lit(TODAY))
    return (lapsed.select(F.lit("lapsed window").alias("finding"), F.col("o_orderkey").alias("key"), F.col("b").alias("since"))
            .unionByName(stale.select(F.lit("stale entry").alias("finding"), F.col("o_custkey").alias("key"),
                                      F.col("confirmed").alias("since"))))


@query("exposure_lookthrough", "account:i driver exposure:n exposure_pct:n over_cap:b", """held AS (
  SELECT o_custkey AS account, l_partkey AS asset, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2), opened AS (
  SELECT account, asset, CAST(v AS DECIMAL(30,4)) AS v FROM held JOIN part ON asset = p_partkey WHERE p_type <> 'ECONOMY'
  UNION ALL SELECT account, p_size, CAST(v * 0.6 AS DECIMAL(30,4)) FROM held JOIN part ON asset = p_partkey WHERE p_type = 'ECONOMY'
  UNION ALL SELECT account, asset, CAST(v * 0.4 AS DECIMAL(30,4)) FROM held JOIN part ON asset = p_partkey WHERE p_type = 'ECONOMY'), sums AS (
  SELECT account, p_brand AS driver, CAST(sum(v) AS DOUBLE) AS exposure FROM opened JOIN part ON asset = p_partkey
  GROUP BY 1, 2), totals AS (SELECT account, CAST(sum(v) AS DOUBLE) AS t FROM held GROUP BY 1)""", """result AS (
  SELECT account, driver, exposure, 100.0 * exposure / nullif(t, 0) AS exposure_pct, 100.0 * exposure / nullif(t, 0) > 12
    AS over_cap FROM sums JOIN totals USING (account))""")
def exposure_lookthrough(spark, sf):
    part = table(spark, sf, "part")
    owner = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("account"))
    holdings = table(spark, sf, "lineitem").join(owner, "l_orderkey").select(
        "account", F.col("l_partkey").alias("asset"), money("l_extendedprice").alias("value"))
    legs = F.array(F.struct(F.col("p_size").cast("bigint").alias("member"), F.lit("0.60").cast("decimal(3,2)").alias("weight")),
                   F.struct(F.col("p_partkey").alias("member"), F.lit("0.40").cast("decimal(3,2)").alias("weight")))
    constituents = (part.where(F.col("p_type") == "ECONOMY")
                    .select(F.col("p_partkey").alias("asset"), F.explode(legs).alias("l")).select("asset", "l.*"))
    drivers = part.select(F.col("p_partkey").alias("asset"), F.col("p_brand").alias("driver"))
    caps = part.select(F.col("p_brand").alias("driver")).distinct().withColumn("cap", F.lit(12.0))
    return S.exposure_lookthrough(holdings, constituents, drivers, caps, "account", "asset", "value", "member", "weight",
                                  "driver", "cap")


# --- Point in time ----------------------------------------------------------------------------

CUTOFF = dt.date(1998, 6, 1)


@query("point_in_time_packet", "part increment:i key:i value:n", """packet AS (
  SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-06-01'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
    l_suppkey DESC, l_extendedprice DESC) = 1)""", """result AS (
  SELECT 'packet' AS part, 0 AS increment, l_orderkey AS key, l_extendedprice AS value FROM packet
  UNION ALL SELECT 'reveal', (date_diff('day', DATE '1998-06-01', CAST(l_shipdate AS DATE)) - 1) // 90 + 1, count(*),
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
  FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-06-01' GROUP BY 2)""")
def point_in_time_packet(spark, sf):
    lines = table(spark, sf, "lineitem")
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    packet = S.point_in_time_packet(lines, ["l_orderkey"], "l_shipdate", cutoff, ["l_extendedprice"],
                                    ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    steps = (S.reveal_increments(lines, "l_shipdate", CUTOFF, 90).groupBy("increment")
             .agg(F.count(F.lit(1)).alias("key"), F.sum(money("l_extendedprice")).cast("double").alias("value")))
    return (packet.select(F.lit("packet").alias("part"), F.lit(0).cast("bigint").alias("increment"),
                          F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("value"))
            .unionByName(steps.withColumn("part", F.lit("reveal"))))


@query("milestone_lead_times", "c_custkey:i ticker t0:d t2:d t6:d lead_days:i move_before:n rerating_done:n", DAILY_PRICE, """stones AS (
  SELECT o_custkey AS c_custkey, CAST(min(o_orderdate) AS DATE) AS t0,
    CAST(min(o_orderdate) FILTER (o_orderstatus = 'F') AS DATE) AS t2,
    CAST(max(o_orderdate) AS DATE) AS t6 FROM orders GROUP BY 1), priced AS (
  SELECT s.*, t.ticker, (SELECT arg_min(price, date) FROM daily_price p WHERE p.ticker = t.ticker AND date BETWEEN t0 AND t0 + 7) AS p0,
    (SELECT arg_min(price, date) FROM daily_price p WHERE p.ticker = t.ticker AND date BETWEEN t2 AND t2 + 7) AS p2,
    (SELECT arg_min(price, date) FROM daily_price p WHERE p.ticker = t.ticker AND date BETWEEN t6 AND t6 + 7) AS p6
  FROM stones s CROSS JOIN (VALUES ('A'), ('N'), ('R')) t(ticker))""",
       """result AS (
  SELECT c_custkey, ticker, t0, t2, t6, date_diff('day', t0, t2) AS lead_days, ln(p2 / p0) AS move_before,
         ln(p2 / p0) / nullif(ln(p6 / p0), 0) AS rerating_done FROM priced)""")
def milestone_lead_times(spark, sf):
    orders = table(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    events = orders.select(F.col("o_custkey").alias("c_custkey"), day.alias("date"),
                           F.explode(F.array_compact(F.array(
                               F.lit("t0"), F.when(F.col("o_orderstatus") == "F", F.lit("t2"))))).alias("stone"))
    stones = S.milestone_dates(events, "c_custkey", "stone", "date", ["t0", "t2"])
    last = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(day).alias("t6"))
    rows = against_targets(stones.join(last, "c_custkey"))
    lookup = asof.forward_lookup(prices(spark, sf), ["ticker"], "date", "price")
    for stone in ("t0", "t2", "t6"):
        rows = asof.asof_forward(rows, lookup, ["ticker"], stone, f"p_{stone}")
    return S.lead_times(rows, "t0", "t2", "p_t0_value", "p_t2_value", "p_t6_value")


# What stands in for the eight milestones of an idea, by customer.
STONES = {"t0": "true", "t1": "o_orderpriority = '1-URGENT'", "t2": "o_orderstatus = 'F'", "t3": "o_orderpriority = '2-HIGH'",
          "t4": "o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P'", "t5": "o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F'",
          "t6": "o_orderpriority = '5-LOW' AND o_totalprice > 300000", "t7": "o_orderstatus = 'O' AND o_totalprice > 400000"}
CLOCK = f"""stones AS (SELECT o_custkey AS c_custkey, {', '.join(f"CAST(min(o_orderdate) FILTER ({c}) AS DATE) AS {n}" for n, c in STONES.items())}
  FROM orders GROUP BY 1)"""


def stones(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate")).withColumnRenamed("o_custkey", "c_custkey")
    return S.first_dates(orders, "c_custkey", "day", {name: F.expr(met) for name, met in STONES.items()})


@query("recognition_clock", "c_custkey:i ticker t0:d t1:d t2:d t3:d t4:d t5:d t6:d t7:d lead_days:i confirmation_days:i move_before:n "
       "rerating_done:n gap_left:n early:b", DAILY_PRICE, CLOCK, """next_price AS (
  SELECT ticker, date - CAST(k AS INTEGER) AS day, arg_min(price, date) AS price
  FROM daily_price, (SELECT unnest(range(0, 8)) AS k) t GROUP BY 1, 2), priced AS (
  SELECT s.*, t.ticker, a.price AS p0, b.price AS p3, c.price AS p6 FROM stones s CROSS JOIN (VALUES ('A'), ('N'), ('R')) t(ticker)
  LEFT JOIN next_price a ON a.ticker = t.ticker AND a.day = t0 LEFT JOIN next_price b ON b.ticker = t.ticker AND b.day = t3
  LEFT JOIN next_price c ON c.ticker = t.ticker AND c.day = t6)""", """result AS (
  SELECT *, date_diff('day', t0, t3) AS lead_days, date_diff('day', t1, t4) AS confirmation_days, ln(p3 / p0) AS move_before,
    ln(p3 / p0) / nullif(ln(p6 / p0), 0) AS rerating_done, ln(p6 / p3) AS gap_left, t3 IS NULL OR t3 > t0 AS early FROM priced)""")
def recognition_clock(spark, sf):
    """All eight milestones of every customer against every target."""
    rows = against_targets(stones(spark, sf))
    lookup = asof.forward_lookup(prices(spark, sf), ["ticker"], "date", "price")
    for stone in ("t0", "t3", "t6"):
        rows = asof.asof_forward(rows, lookup, ["ticker"], stone, f"p_{stone}")
    return S.recognition_clock(rows, {stone: f"p_{stone}_value" for stone in ("t0", "t3", "t6")})


@query("stage_outcomes", "milestone reached:i failed:i false_positive_pct:n", CLOCK, """reached AS (
  SELECT * FROM stones UNPIVOT (day FOR milestone IN (t0, t1, t2, t3, t4, t5)))""", """result AS (
  SELECT milestone, count(*) AS reached, count(*) FILTER (t6 IS NULL OR t6 < day) AS failed,
    100.0 * count(*) FILTER (t6 IS NULL OR t6 < day) / count(*) AS false_positive_pct
  FROM reached GROUP BY 1)""")
def stage_outcomes(spark, sf):
    return S.stage_outcomes(stones(spark, sf), ["t0", "t1", "t2", "t3", "t4", "t5"], "t6")


@query("flat_run", "item period:d flat_signal:b", RELEASE, """lagged AS (
  SELECT *, value <= lag(value) OVER w AS f FROM release WINDOW w AS (PARTITION BY item ORDER BY period))""", """result AS (
  SELECT item, period, coalesce(f AND lag(f) OVER (PARTITION BY item ORDER BY period), false) AS flat_signal FROM lagged)""")
def flat_run(spark, sf):
    return S.flat_run(release(spark, sf), "item", "period", "value")
