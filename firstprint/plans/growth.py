"""Growth, shares, stage picks and rollups over the driver tables."""

from pyspark.sql import functions as F

from firstprint.operators import diff as D, fx, growth as G, store
from firstprint.operators.filings import ordered_cap
from firstprint.plans.registry import query
from firstprint.plans.tables import (CODE_TOTALS, DAILY_PRICE, ORIGIN_RELEASE, RELEASE, WINDOW_RELEASE, code_totals, daily_price, money,
                                     origin_release, origin_rows, release, table, window_release)

YOY = """result AS (
  SELECT a.item, a.period, a.value, b.value AS value_year_ago,
         (a.value / nullif(b.value, 0) - 1.0) * 100.0 AS yoy_pct
  FROM release a LEFT JOIN release b ON a.item = b.item AND b.period = a.period - INTERVAL 12 MONTH)"""


@query("yoy_self_join", "item period:d value:n value_year_ago:n yoy_pct:n", RELEASE, YOY)
def yoy_self_join(spark, sf):
    return G.yoy_self_join(release(spark, sf), ["item"])


# --- Members and groups -----------------------------------------------------------

def memberships(spark, sf):
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    segment = customer.select("c_custkey", F.col("c_mktsegment").alias("group"))
    region = (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .select("c_custkey", F.col("r_name").alias("group")))
    return segment.unionByName(region)


MEMBERSHIPS = """memberships AS (
  SELECT c_custkey, c_mktsegment AS "group" FROM customer
  UNION SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
  UNION SELECT c_custkey, 'all_listed' FROM customer)"""

MEMBER_MONTHS = """member_months AS (
  SELECT o_custkey AS c_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS value
  FROM orders GROUP BY 1, 2), member_pairs AS (
  SELECT a.c_custkey, a.period, a.value AS now, b.value AS ago
  FROM member_months a JOIN member_months b
    ON a.c_custkey = b.c_custkey AND b.period = a.period - INTERVAL 12 MONTH WHERE b.value > 0)"""


def member_months(spark, sf):
    return (table(spark, sf, "orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"), F.trunc("o_orderdate", "month").alias("period"))
            .agg(F.sum(money("o_totalprice")).alias("value")))


@query("group_membership", "group n:i balance:n", MEMBERSHIPS, """result AS (
  SELECT "group", count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
  FROM customer JOIN memberships USING (c_custkey) GROUP BY 1)""")
def group_membership(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return (G.group_membership(rows, memberships(spark, sf), "c_custkey").groupBy("group")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(money("c_acctbal")).cast("double").alias("balance")))


BREADTH = """breadth AS (
  SELECT period, "group", count(*) AS n_members, CAST(sum(now) AS DOUBLE) AS sum_now,
         CAST(sum(ago) AS DOUBLE) AS sum_year_ago,
         (CAST(sum(now) AS DOUBLE) / CAST(sum(ago) AS DOUBLE) - 1.0) * 100.0 AS agg_yoy_pct,
         quantile_cont((CAST(now AS DOUBLE) / CAST(ago AS DOUBLE) - 1.0) * 100.0, 0.5) AS median_yoy_pct,
         100.0 * count(*) FILTER (now > ago) / count(*) AS breadth_pct
  FROM member_pairs JOIN memberships USING (c_custkey) GROUP BY 1, 2)"""


def breadth(spark, sf):
    pairs = (G.yoy_self_join(member_months(spark, sf), ["c_custkey"])
             .where(F.col("value_year_ago") > 0).select("c_custkey", "period", "value", "value_year_ago"))
    grouped = G.group_membership(pairs, memberships(spark, sf), "c_custkey")
    return G.group_growth_breadth(grouped, ["period", "group"], "value", "value_year_ago")


@query("group_growth_breadth",
       "group period:d n_members:i sum_now:n sum_year_ago:n agg_yoy_pct:n median_yoy_pct:n breadth_pct:n",
       MEMBERSHIPS, MEMBER_MONTHS, BREADTH, "result AS (SELECT * FROM breadth)")
def group_growth_breadth(spark, sf):
    return breadth(spark, sf)


# --- Stages, prefixes, levels, variants ------------------------------------------------

def staged_lines(spark, sf):
    arrival = (F.col("l_linenumber") * F.lit(10 ** 15) + F.col("l_partkey") * F.lit(10 ** 6) + F.col("l_suppkey"))
    stage = F.when(F.col("l_linestatus") == "F", "DETAILED").otherwise("PROV9")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", stage.alias("stage"), arrival.alias("arrival"), F.col("l_extendedprice").alias("value"))


STAGED = """staged AS (
  SELECT l_orderkey, CASE WHEN l_linestatus = 'F' THEN 'DETAILED' ELSE 'PROV9' END AS stage,
         l_linenumber * 1000000000000000 + l_partkey * 1000000 + l_suppkey AS arrival, l_extendedprice AS value
  FROM lineitem)"""


@query("stage_priority_pick", "ties l_orderkey:i stage value:n", STAGED, """result AS (
  SELECT 'last' AS ties, l_orderkey, stage, value FROM staged
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY stage, arrival DESC, value DESC) = 1
  UNION ALL SELECT 'first', l_orderkey, stage, value FROM staged
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY stage, arrival, value DESC) = 1)""")
def stage_priority_pick(spark, sf):
    rows = staged_lines(spark, sf)
    ranks = {"PROV9": 1, "DETAILED": 2}
    picks = [G.stage_priority_pick(rows, ["l_orderkey"], "stage", ranks, ["stage", "value"], ties=ties)
             .withColumn("ties", F.lit(ties)) for ties in ("last", "first")]
    return picks[0].unionByName(picks[1])


PREFIXES = ["Brand#1", "Brand#2", "Brand#12", "Brand#25", "Brand#9", "Br"]
PREFIX_ROWS = ", ".join(f"('{p}')" for p in PREFIXES)


@query("prefix_assign", "p_partkey:i p_brand prefix", f"""result AS (
  SELECT p_partkey, p_brand, prefix FROM part JOIN (VALUES {PREFIX_ROWS}) t(prefix) ON starts_with(p_brand, prefix))""")
def prefix_assign(spark, sf):
    return G.prefix_assign(table(spark, sf, "part"), "p_brand", PREFIXES)


@query("prefix_sum", "period:d l_linestatus prefix value:n", f"""result AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_linestatus, prefix,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN (VALUES {PREFIX_ROWS}) t(prefix) ON starts_with(p_brand, prefix) GROUP BY 1, 2, 3)""")
def prefix_sum(spark, sf):
    line = table(spark, sf, "lineitem").select(
        "l_partkey", "l_linestatus", F.trunc("l_shipdate", "month").alias("period"),
        money("l_extendedprice").alias("value"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return G.prefix_sum(line.join(part, "l_partkey"), ["period", "l_linestatus"], "p_brand", PREFIXES, "value")


@query("detail_level", "level status n:i value:n", """levelled AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'DET' WHEN 'R' THEN 'CGP' ELSE '' END AS level,
         l_linestatus AS status, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem)""", """result AS (
  SELECT level, status, count(*) AS n, CAST(sum(v) AS DOUBLE) AS value FROM levelled
  WHERE NOT EXISTS (SELECT 1 FROM levelled WHERE level = 'DET') OR level IN ('DET', '') GROUP BY 1, 2)""")
def detail_level(spark, sf):
    flag = F.col("l_returnflag")
    level = F.when(flag == "A", "DET").when(flag == "R", "CGP").otherwise("")
    rows = table(spark, sf, "lineitem").select(level.alias("level"), F.col("l_linestatus").alias("status"),
                                               money("l_extendedprice").alias("v"))
    return (G.detail_level(rows, "level").groupBy("level", "status")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("value")))


@query("preferred_variant", "wanted lang source n:i chars:i", """result AS (
  SELECT w AS wanted, lang, source, count(*) AS n, sum(n_chars) AS chars
  FROM documents JOIN (VALUES ('en'), ('xx')) t(w) ON lang = (
    SELECT CASE WHEN count(*) FILTER (d.lang = w) > 0 THEN w ELSE min(d.lang) END FROM documents d)
  GROUP BY 1, 2, 3)""")
def preferred_variant(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "source", "n_chars")
    out = None
    for wanted in ("en", "xx"):
        part = (G.preferred_variant(docs, "lang", wanted).groupBy("lang", "source")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
                .withColumn("wanted", F.lit(wanted)))
        out = part if out is None else out.unionByName(part)
    return out


# --- Shares ---------------------------------------------------------------------------

SHARES = """shares AS (
  SELECT o.period, o.code, o.origin, o.value, t.total, 100.0 * o.value / nullif(t.total, 0) AS share_pct
  FROM origin_release o LEFT JOIN code_totals t USING (period, code))"""


def shares(spark, sf):
    return G.share_of_total_row(origin_rows(spark, sf), ["period", "code"], "origin", "value")


@query("share_of_total", "period:d code origin value:n total:n share_pct:n",
       ORIGIN_RELEASE, CODE_TOTALS, SHARES, "result AS (SELECT * FROM shares)")
def share_of_total(spark, sf):
    return shares(spark, sf)


@query("prior_period_share", "period:d code origin share_pct:n share_pct_prior:n share_move_pt:n",
       ORIGIN_RELEASE, CODE_TOTALS, SHARES, """result AS (
  SELECT a.period, a.code, a.origin, a.share_pct, b.share_pct AS share_pct_prior,
         a.share_pct - b.share_pct AS share_move_pt
  FROM shares a LEFT JOIN shares b ON a.code = b.code AND a.origin = b.origin
    AND b.period = a.period - INTERVAL 1 MONTH)""")
def prior_period_share(spark, sf):
    return G.prior_period_share(shares(spark, sf), ["code", "origin"], "period", "share_pct")


@query("top_n_per_group", "period:d code origin value:n rank:i", ORIGIN_RELEASE, """result AS (
  SELECT *, row_number() OVER (PARTITION BY period, code ORDER BY value DESC, origin) AS rank FROM origin_release
  QUALIFY rank <= 6)""")
def top_n_per_group(spark, sf):
    return G.top_n_per_group(origin_release(spark, sf), ["period", "code"], [F.desc("value"), F.asc("origin")], 6)


@query("headline_filter", "period:d code origin value:n", ORIGIN_RELEASE, CODE_TOTALS, """both_rows AS (
  SELECT period, code, origin, value FROM origin_release
  UNION ALL SELECT period, code, '-', total FROM code_totals)""", """result AS (
  SELECT period, code, origin, value FROM both_rows WHERE origin = '-'
  UNION ALL SELECT period, code, origin, value FROM (
    SELECT * FROM both_rows WHERE origin <> '-' AND code IN ('Brand#1', 'Brand#2', 'Brand#12')
    QUALIFY row_number() OVER (PARTITION BY period, code ORDER BY value DESC, origin) <= 6))""")
def headline_filter(spark, sf):
    return D.origin_headline(origin_rows(spark, sf), ["period", "code"], "origin", "value", codes=["Brand#1", "Brand#2", "Brand#12"])


@query("headline_predicates", "p_partkey:i total:b token:b", """named AS (
  SELECT p_partkey, p_brand AS brand, CASE WHEN p_size % 5 = 0 THEN p_name || ' Total' WHEN p_size % 7 = 0 THEN p_type || ' AREA Grand Total'
    ELSE p_name END AS item, CASE WHEN p_size % 3 = 0 THEN 'estat_hs:' || p_brand WHEN p_size % 11 = 0 THEN 'timeseries:world_total'
    ELSE p_brand END AS source FROM part)""", """result AS (
  SELECT p_partkey, starts_with(source, 'estat_hs') OR (source <> 'timeseries:world_total' AND NOT ends_with(item, 'AREA Grand Total')
    AND (contains(upper(item), 'TOTAL') OR contains(lower(item), 'bolt'))) AS total,
    contains(upper(item), 'WIDGET') OR contains(upper(item), 'GRAND') AS token FROM named)""")
def headline_predicates(spark, sf):
    """Totals, listed items and tokens among the names of all parts."""
    name, brand, size = F.col("p_name"), F.col("p_brand"), F.col("p_size")
    item = F.when(size % 5 == 0, F.concat(name, F.lit(" Total"))).when(
        size % 7 == 0, F.concat("p_type", F.lit(" AREA Grand Total"))).otherwise(name)
    source = F.when(size % 3 == 0, F.concat(F.lit("estat_hs:"), brand)).when(
        size % 11 == 0, F.lit("timeseries:world_total")).otherwise(brand)
    return table(spark, sf, "part").select("p_partkey", D.total_headline(item, source, ["Bolt"]).alias("total"),
                                           D.token_headline(item, ["widget", "grand"]).alias("token"))


# --- Composite tables -----------------------------------------------------------------

@query("growth_tables", "source item period:d window value:n value_year_ago:n yoy_pct:n",
       RELEASE, WINDOW_RELEASE, ORIGIN_RELEASE, CODE_TOTALS, MEMBERSHIPS, MEMBER_MONTHS, BREADTH,
       """all_rows AS MATERIALIZED (
  SELECT 'flash' AS source, item, period, "window", value FROM window_release
  UNION ALL SELECT 'origin', code || ':' || origin, period, 'MONTH', value FROM origin_release
  UNION ALL SELECT 'origin', code || ':-', period, 'MONTH', total FROM code_totals
  UNION ALL SELECT 'stage', l_linestatus || ':' || p_type, CAST(date_trunc('month', l_shipdate) AS DATE), 'MONTH',
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 2, 3)""", """result AS (
  SELECT a.source, a.item, a.period, a."window", a.value, b.value AS value_year_ago,
         (a.value / nullif(b.value, 0) - 1.0) * 100.0 AS yoy_pct
  FROM all_rows a LEFT JOIN all_rows b ON a.source = b.source AND a.item = b.item AND a."window" = b."window"
    AND b.period = a.period - INTERVAL 12 MONTH
  UNION ALL SELECT 'group', "group", period, 'MONTH', sum_now, sum_year_ago, agg_yoy_pct FROM breadth)""")
def growth_tables(spark, sf):
    origin = origin_rows(spark, sf).select(
        F.concat_ws(":", "code", "origin").alias("item"), "period", F.lit("MONTH").alias("window"), "value")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    stage = (table(spark, sf, "lineitem").join(part, "l_partkey")
             .groupBy(F.concat_ws(":", "l_linestatus", "p_type").alias("item"),
                      F.trunc("l_shipdate", "month").alias("period"))
             .agg(F.sum(money("l_extendedprice")).cast("double").alias("value")).withColumn("window", F.lit("MONTH")))
    keyed = G.tagged_union(flash=window_release(spark, sf), origin=origin, stage=stage)
    grown = G.yoy_self_join(keyed, ["source", "item", "window"])
    groups = breadth(spark, sf).select(
        F.lit("group").alias("source"), F.col("group").alias("item"), "period", F.lit("MONTH").alias("window"),
        F.col("sum_now").alias("value"), F.col("sum_year_ago").alias("value_year_ago"),
        F.col("agg_yoy_pct").alias("yoy_pct"))
    return grown.unionByName(groups)


@query("latest_and_previous", "item period:d window value:n prev_period:d prev_window prev_value:n",
       WINDOW_RELEASE, """ordered AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY period DESC,
    CASE "window" WHEN 'D10' THEN 0 WHEN 'D20' THEN 1 ELSE 2 END DESC) AS rn FROM window_release)""", """result AS (
  SELECT a.item, a.period, a."window", a.value, b.period AS prev_period, b."window" AS prev_window,
         b.value AS prev_value
  FROM ordered a LEFT JOIN ordered b ON a.item = b.item AND b.rn = 2 WHERE a.rn = 1)""")
def latest_and_previous(spark, sf):
    return G.latest_and_previous(window_release(spark, sf), ["item"], "period", "window", ["value"])


GROWN_WINDOWS = """grown AS (
  SELECT a.*, b.value AS value_year_ago, (a.value / nullif(b.value, 0) - 1.0) * 100.0 AS yoy_pct
  FROM window_release a LEFT JOIN window_release b ON a.item = b.item AND a."window" = b."window"
    AND b.period = a.period - INTERVAL 12 MONTH), means AS (
  SELECT ticker AS quote, CAST(date_trunc('month', date) AS DATE) AS period, w AS "window", avg(price) AS rate
  FROM daily_price JOIN (VALUES ('D10', 10), ('D20', 20), ('MONTH', 31)) t(w, last) ON day(date) <= last GROUP BY 1, 2, 3)"""


@query("latest_growth_points", "item quote period:d window yoy_pct:n yoy_pct_usd:n prev_period:d prev_window prev_yoy_pct:n "
       "prev_yoy_pct_usd:n currency_points:n", WINDOW_RELEASE, DAILY_PRICE, GROWN_WINDOWS, """ordered AS (
  SELECT g.item, q.quote, g.period, g."window", g.yoy_pct,
    ((g.value / n.rate) / nullif(g.value_year_ago / o.rate, 0) - 1.0) * 100.0 AS yoy_pct_usd,
    row_number() OVER (PARTITION BY g.item, q.quote ORDER BY g.period DESC,
      CASE g."window" WHEN 'D10' THEN 0 WHEN 'D20' THEN 1 ELSE 2 END DESC) AS rn
  FROM grown g CROSS JOIN (VALUES ('A'), ('N'), ('R')) q(quote)
  LEFT JOIN means n ON n.quote = q.quote AND n.period = g.period AND n."window" = g."window"
  LEFT JOIN means o ON o.quote = q.quote AND o.period = g.period - INTERVAL 12 MONTH AND o."window" = g."window")""", """result AS (
  SELECT a.*, b.period AS prev_period, b."window" AS prev_window, b.yoy_pct AS prev_yoy_pct, b.yoy_pct_usd AS prev_yoy_pct_usd,
    CASE WHEN a.yoy_pct - a.yoy_pct_usd >= 3 THEN a.yoy_pct - a.yoy_pct_usd END AS currency_points
  FROM ordered a LEFT JOIN ordered b ON a.item = b.item AND a.quote = b.quote AND b.rn = 2 WHERE a.rn = 1)""")
def latest_growth_points(spark, sf):
    """The newest growth of every item beside the one before it, and how much of it is only the currency of each quote."""
    quotes = F.explode(F.array(*[F.lit(q) for q in ("A", "N", "R")]))
    grown = G.yoy_self_join(window_release(spark, sf), ["item", "window"]).withColumn("quote", quotes)
    rates = daily_price(spark, sf).select(F.col("ticker").alias("quote"), "date", F.col("price").alias("rate"))
    restated = fx.window_fx_restate(grown, fx.window_mean(rates, ["quote"], "date", "rate"), by=["quote"])
    two = G.latest_and_previous(restated, ["item", "quote"], "period", "window", ["yoy_pct", "yoy_pct_usd"])
    return two.withColumn("currency_points", G.currency_points(F.col("yoy_pct"), F.col("yoy_pct_usd")))


@query("ordered_cap", "period:d code origin value:n", ORIGIN_RELEASE, """result AS (
  SELECT period, code, origin, value FROM origin_release ORDER BY value DESC, period, code, origin LIMIT 40)""")
def ordered_cap_query(spark, sf):
    return ordered_cap(origin_release(spark, sf),
                       [F.desc("value"), F.asc("period"), F.asc("code"), F.asc("origin")], 40)


@query("tagged_union", "source item period:d value:n total:n", RELEASE, CODE_TOTALS, """result AS (
  SELECT 'release' AS source, item, period, value, NULL AS total FROM release
  UNION ALL SELECT 'codes', code, period, NULL, total FROM code_totals)""")
def tagged_union(spark, sf):
    codes = code_totals(spark, sf).withColumnRenamed("code", "item")
    return G.tagged_union(release=release(spark, sf), codes=codes)


@query("key_difference", "doc_id:i lang n_chars:i", """result AS (
  SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))""")
def key_difference(spark, sf):
    return store.key_difference(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"),
                                table(spark, sf, "labels"), ["doc_id"])


@query("key_intersection", "doc_id:i lang n_chars:i", """result AS (
  SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))""")
def key_intersection(spark, sf):
    return store.key_intersection(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"),
                                  table(spark, sf, "labels"), ["doc_id"])


@query("distinct_union", "nation:i", """result AS (
  SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier)""")
def distinct_union(spark, sf):
    return store.distinct_union("nation", table(spark, sf, "customer").withColumnRenamed("c_nationkey", "nation"),
                                table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "nation"))
