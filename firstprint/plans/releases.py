"""The four growth tables over the driver tables, each a query of its own."""

from pyspark.sql import functions as F

from firstprint.operators import fx, releases as R
from firstprint.operators.growth import prefix_sum
from firstprint.plans.growth import BREADTH, MEMBERSHIPS, MEMBER_MONTHS, breadth
from firstprint.plans.rates import LAGGED, MEANS
from firstprint.plans.registry import query
from firstprint.plans.tables import FX_DAILY, fx_daily, money, table

QUOTES, PREFIXES = ["A", "N", "R"], ["Brand#1", "Brand#2", "Brand#12"]
WINDOWS = {"D10": 10, "D20": 20, "MONTH": 31}


@query("growth_table_members", "report_month:d group n_members_reporting:i rev_sum_k:n rev_sum_year_ago_k:n agg_yoy_pct:n "
       "median_yoy_pct:n breadth_pct:n", MEMBERSHIPS, MEMBER_MONTHS, BREADTH, """result AS (
  SELECT period AS report_month, "group", n_members AS n_members_reporting, sum_now / 1000 AS rev_sum_k,
         sum_year_ago / 1000 AS rev_sum_year_ago_k, agg_yoy_pct, median_yoy_pct, breadth_pct FROM breadth)""")
def growth_table_members(spark, sf):
    return breadth(spark, sf).select(
        F.col("period").alias("report_month"), "group", F.col("n_members").alias("n_members_reporting"),
        (F.col("sum_now") / 1000).alias("rev_sum_k"), (F.col("sum_year_ago") / 1000).alias("rev_sum_year_ago_k"),
        "agg_yoy_pct", "median_yoy_pct", "breadth_pct")


# --- Flash prints -----------------------------------------------------------------------

def windowed(unit):
    """The value of the month's first ten days, first twenty and all of it, in units of `unit`."""
    day = F.dayofmonth("o_orderdate")
    return {name: F.sum(F.when(day <= last, money("o_totalprice"))).cast("double") / unit for name, last in WINDOWS.items()}


FLASH = """sums AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderpriority AS priority, o_orderstatus AS status, w AS period_type,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
  FROM orders JOIN (VALUES ('D10', 10), ('D20', 20), ('MONTH', 31)) t(w, last) ON day(o_orderdate) <= last GROUP BY ALL), own AS (
  SELECT period, period_type, 'exp:' || priority AS item, CAST(sum(v) AS DOUBLE) / 1000 AS value FROM sums GROUP BY ALL
  UNION ALL SELECT period, 'MONTH', 'HS' || status, CAST(sum(v) AS DOUBLE) / 1000 FROM sums WHERE period_type = 'MONTH' GROUP BY ALL), finished AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, 100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*) - 50 AS published
  FROM orders GROUP BY 1)"""


@query("growth_table_flash", "period:d period_type item value_k:n value_k_year_ago:n yoy_pct:n", FLASH, """result AS (
  SELECT a.period, a.period_type, a.item, a.value AS value_k, b.value AS value_k_year_ago, (a.value / nullif(b.value, 0) - 1.0) * 100.0 AS yoy_pct
  FROM own a LEFT JOIN own b ON a.item = b.item AND a.period_type = b.period_type AND b.period = CAST(a.period - INTERVAL 12 MONTH AS DATE)
  UNION ALL SELECT period, period_type, 'exp:TOTAL (tradedata)', CAST(sum(v) AS DOUBLE) / 1000, NULL, any_value(published)
  FROM sums JOIN finished USING (period) GROUP BY 1, 2)""")
def growth_table_flash(spark, sf):
    """Windows by priority, totals with a published figure, and months by status: three grains of one scan of the orders."""
    rows = table(spark, sf, "orders").withColumn("period", F.trunc("o_orderdate", "month"))
    sums = R.grain_sums(rows, {"item": ["period", "o_orderpriority"], "total": ["period"], "code": ["period", "o_orderstatus"]}, **windowed(1e3),
                        published=100.0 * F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1)) - 50)
    long = R.windows_long(sums, list(WINDOWS))
    of = lambda grain: F.col("grain") == grain
    windows = long.where(of("item")).select("period", "period_type", F.concat(F.lit("exp:"), F.col("o_orderpriority")).alias("item"), "value")
    totals = long.where(of("total")).select("period", "period_type", "value", "published")
    monthly = long.where(of("code") & (F.col("period_type") == "MONTH")).select(
        "period", F.concat(F.lit("HS"), F.col("o_orderstatus")).alias("item"), "value")
    return R.flash_table(windows, totals, monthly).withColumnsRenamed({"value": "value_k", "value_year_ago": "value_k_year_ago"})


# --- Prints with a currency ---------------------------------------------------------------

PRESS = """months AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderpriority AS priority, o_orderstatus AS status,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (day(o_orderdate) <= 10) AS d10,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (day(o_orderdate) <= 20) AS d20, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS month
  FROM orders GROUP BY ALL), press AS (
  SELECT period, 'D10' AS period_type, 'E:' || priority AS item, CAST(sum(d10) AS DOUBLE) / 1e6 AS value,
         100.0 * CAST(coalesce(sum(d10), 0) AS DOUBLE) / CAST(sum(month) AS DOUBLE) AS published FROM months GROUP BY period, priority HAVING sum(d10) <> 0
  UNION ALL SELECT period, 'D20', 'E:' || priority, CAST(sum(d20) AS DOUBLE) / 1e6,
         100.0 * CAST(coalesce(sum(d10), 0) AS DOUBLE) / CAST(sum(month) AS DOUBLE) FROM months GROUP BY period, priority HAVING sum(d20) <> 0
  UNION ALL SELECT period, 'MONTH', 'E:' || priority, value, published FROM (
    SELECT period, priority, status = 'F' AS final, CAST(sum(month) AS DOUBLE) / 1e6 AS value,
           100.0 * CAST(coalesce(sum(d10), 0) AS DOUBLE) / CAST(sum(month) AS DOUBLE) AS published FROM months GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY period, priority ORDER BY final DESC) = 1), codes AS (
  SELECT period, stage, item, CAST(sum(v) AS DOUBLE) / 1e6 AS value FROM (
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, CASE l_linestatus WHEN 'F' THEN 'DETAILED' ELSE 'PROV9' END AS stage,
      l_returnflag || ':HS' || prefix AS item, CAST(l_extendedprice AS DECIMAL(18,2)) AS v
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN (VALUES ('Brand#1'), ('Brand#2'), ('Brand#12')) t(prefix) ON starts_with(p_brand, prefix))
  GROUP BY ALL), printed AS MATERIALIZED (
  SELECT period, period_type, 'press_release' AS source, 'press' AS family, item, value, published FROM press
  UNION ALL SELECT period, 'MONTH', 'timeseries:status', 'timeseries:status', 'E:' || status, CAST(sum(month) AS DOUBLE) / 1e6, NULL
    FROM months GROUP BY period, status
  UNION ALL SELECT period, 'MONTH', 'estat_hs:' || stage, 'estat_hs', item, value, NULL FROM codes
    QUALIFY row_number() OVER (PARTITION BY period, item ORDER BY stage) = 1), grown AS (
  SELECT a.*, b.value AS value_year_ago, (a.value / nullif(b.value, 0) - 1.0) * 100.0 AS yoy_pct FROM printed a LEFT JOIN printed b
    ON a.family = b.family AND a.item = b.item AND a.period_type = b.period_type AND b.period = CAST(a.period - INTERVAL 12 MONTH AS DATE))"""


@query("growth_table_customs", "period:d period_type source item quote value_m:n value_m_year_ago:n yoy_pct:n yoy_pct_published:n "
       "rate:n value_k_restated:n yoy_pct_restated:n fx_effect_pt:n rate_customs:n yoy_pct_customs:n", FX_DAILY, MEANS, LAGGED, PRESS, """result AS (
  SELECT g.period, g.period_type, g.source, g.item, q.quote, g.value AS value_m, g.value_year_ago AS value_m_year_ago, g.yoy_pct,
    g.published AS yoy_pct_published, n.rate, g.value * 1000 / n.rate AS value_k_restated,
    ((g.value / n.rate) / nullif(g.value_year_ago / o.rate, 0) - 1.0) * 100.0 AS yoy_pct_restated,
    g.yoy_pct - ((g.value / n.rate) / nullif(g.value_year_ago / o.rate, 0) - 1.0) * 100.0 AS fx_effect_pt, cn.rate AS rate_customs,
    ((g.value / cn.rate) / nullif(g.value_year_ago / co.rate, 0) - 1.0) * 100.0 AS yoy_pct_customs
  FROM grown g CROSS JOIN (VALUES ('A'), ('N'), ('R')) q(quote)
  LEFT JOIN means n ON n.quote = q.quote AND n.period = g.period AND n."window" = g.period_type
  LEFT JOIN means o ON o.quote = q.quote AND o.period = CAST(g.period - INTERVAL 12 MONTH AS DATE) AND o."window" = g.period_type
  LEFT JOIN lagged_means cn ON cn.quote = q.quote AND cn.period = g.period AND cn."window" = g.period_type
  LEFT JOIN lagged_means co ON co.quote = q.quote AND co.period = CAST(g.period - INTERVAL 12 MONTH AS DATE) AND co."window" = g.period_type)""")
def growth_table_customs(spark, sf):
    """Press prints by stage, series by status and code sums by stage, restated at the market and the customs rate of each quote."""
    orders = table(spark, sf, "orders").withColumns({
        "period": F.trunc("o_orderdate", "month"),
        "stage": F.when(F.col("o_orderstatus") == "F", "MONTH_DP").otherwise("MONTH_PROV")})
    sums = R.grain_sums(orders, {"window": ["period", "o_orderpriority"], "stage": ["period", "o_orderpriority", "stage"],
                                 "status": ["period", "o_orderstatus"]}, **windowed(1e6))
    sums = sums.withColumn("published", 100.0 * F.coalesce("D10", F.lit(0.0)) / F.col("MONTH"))
    of = lambda grain: F.col("grain") == grain
    item = F.concat(F.lit("E:"), F.col("o_orderpriority")).alias("item")
    early = R.windows_long(sums.where(of("window")).drop("stage"), list(WINDOWS), window="stage").where("stage != 'MONTH'")
    press = early.select("period", "stage", item, "value", "published", F.lit(0).alias("arrival")).unionByName(
        sums.where(of("stage")).select("period", "stage", item, F.col("MONTH").alias("value"), "published", F.lit(0).alias("arrival")))
    series = sums.where(of("status")).select("period", F.lit("status").alias("series"), F.concat(F.lit("E:"), F.col("o_orderstatus")).alias("item"),
                                             F.col("MONTH").alias("value"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("code"))
    lines = table(spark, sf, "lineitem").join(part, "l_partkey").select(
        F.trunc("l_shipdate", "month").alias("period"), F.when(F.col("l_linestatus") == "F", "DETAILED").otherwise("PROV9").alias("stage"),
        F.col("l_returnflag").alias("imex"), "code", money("l_extendedprice").alias("value"))
    codes = prefix_sum(lines, ["period", "imex", "stage"], "code", PREFIXES, "value").select(
        "period", "stage", F.concat("imex", F.lit(":HS"), "prefix").alias("item"), (F.col("value") / 1e6).alias("value"))
    rates = fx_daily(spark, sf)
    out = R.customs_table(press, series, codes, fx.window_mean(rates, ["quote"], "date", "rate"),
                          fx.lagged_week_window_mean(rates, ["quote"], "date", "rate"), QUOTES,
                          {"MONTH_PROV": 1, "MONTH_DP": 2}, {"PROV9": 1, "DETAILED": 2})
    return out.withColumnsRenamed({"value": "value_m", "value_year_ago": "value_m_year_ago", "published": "yoy_pct_published",
                                   "rate_now": "rate", "value_usd": "value_k_restated", "yoy_pct_usd": "yoy_pct_restated"})


# --- Partners of a code -------------------------------------------------------------------

PARTNERS = """line AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, CASE l_linestatus WHEN 'O' THEN 'E' ELSE 'I' END AS imex, p_brand AS code,
    CAST(s_nationkey AS VARCHAR) AS cty_code, n_name AS cty_name, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, CAST(l_quantity AS DECIMAL(18,2)) AS q
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey), partner AS (
  SELECT period, imex, code, cty_code, cty_name, CAST(sum(v) AS DOUBLE) / 1000 AS value, CAST(sum(q) AS DOUBLE) AS qty1, 'EA' AS unit1 FROM line GROUP BY ALL
  UNION ALL SELECT period, imex, code, '-', 'ALL COUNTRIES', CAST(sum(v) AS DOUBLE) / 1000, NULL, NULL FROM line GROUP BY period, imex, code)"""


@query("growth_table_partners", "period:d imex code cty_code cty_name value_k:n value_k_year_ago:n yoy_pct:n share_of_code_pct:n qty1:n unit1",
       PARTNERS, """result AS (
  SELECT a.period, a.imex, a.code, a.cty_code, a.cty_name, a.value AS value_k, b.value AS value_k_year_ago,
    (a.value / nullif(b.value, 0) - 1.0) * 100.0 AS yoy_pct, 100.0 * a.value / nullif(t.value, 0) AS share_of_code_pct, a.qty1, a.unit1
  FROM partner a LEFT JOIN partner b ON a.imex = b.imex AND a.code = b.code AND a.cty_code = b.cty_code
    AND b.period = CAST(a.period - INTERVAL 12 MONTH AS DATE)
  JOIN partner t ON t.cty_code = '-' AND t.period = a.period AND t.imex = a.imex AND t.code = a.code)""")
def growth_table_partners(spark, sf):
    """Brands by month, direction and supplier nation."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("code"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("cty_name"))
    supplier = table(spark, sf, "supplier").join(nation, "s_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("cty_code"), "cty_name")
    lines = table(spark, sf, "lineitem").join(part, "l_partkey").join(supplier, "l_suppkey").select(
        F.trunc("l_shipdate", "month").alias("period"), F.when(F.col("l_linestatus") == "O", "E").otherwise("I").alias("imex"),
        "code", "cty_code", "cty_name", "l_extendedprice", "l_quantity")
    out = R.partner_table(lines, ["imex", "code"], "cty_code", "cty_name", money("l_extendedprice"), money("l_quantity"), "EA")
    return out.withColumnsRenamed({"value": "value_k", "value_year_ago": "value_k_year_ago"})
