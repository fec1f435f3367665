"""Snapshot pairs: what is new, what was revised, what deserves a flag."""

from pyspark.sql import functions as F

from firstprint.operators import diff as D, growth as G
from firstprint.plans.registry import query
from firstprint.plans.tables import money, table


# The earlier snapshot lacks the last months and the late line numbers, so the later one brings both new rows and revisions.
BEFORE = "l_shipdate < timestamp_ntz'2001-05-01' AND NOT (l_shipdate >= timestamp_ntz'2001-03-01' AND l_linenumber > 5)"


def facts(spark, sf):
    """Monthly value per brand and nation, of all lines and of those known before, in one pass over them."""
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("code"))
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("origin"))
    line = table(spark, sf, "lineitem")
    thousands = lambda amount: F.sum(amount).cast("double") / 1000
    return (line.join(part, line.l_partkey == part.p_partkey).join(supplier, line.l_suppkey == supplier.s_suppkey)
            .groupBy(F.trunc("l_shipdate", "month").alias("period"), "code", "origin")
            .agg(thousands(money("l_extendedprice")).alias("now"),
                 thousands(F.when(F.expr(BEFORE), money("l_extendedprice"))).alias("before"))
            .withColumn("source", F.lit("us")))


def snapshot(facts, column: str):
    """Monthly shares per brand and nation, and brand totals as '-', with year-ago growth."""
    sums = facts.where(F.col(column).isNotNull()).select("period", "code", "origin", "source", F.col(column).alias("value"))
    cents = (sums.groupBy("source", "period", "code")
             .agg((F.sum((F.col("value") * 100000).cast("decimal(28,0)")).cast("double") / 100000).alias("value"))
             .withColumn("origin", F.lit("-")))
    parts = G.share_of_total(sums, cents.withColumnRenamed("value", "total"), ["source", "period", "code"], "value", "total")
    totals = cents.withColumn("share_pct", F.lit(100.0))
    both = parts.drop("total").unionByName(totals)
    return G.yoy_self_join(both, ["source", "code", "origin"])


def _snapshot_sql(name: str, where: str) -> str:
    return f"""{name}_sums AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, p_brand AS code,
         CAST(s_nationkey AS VARCHAR) AS origin,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  WHERE {where} GROUP BY 1, 2, 3), {name}_totals AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, p_brand AS code, '-' AS origin,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {where} GROUP BY 1, 2), {name}_all AS (
  SELECT s.*, 100.0 * s.value / nullif(t.value, 0) AS share_pct
  FROM {name}_sums s LEFT JOIN {name}_totals t USING (period, code)
  UNION ALL SELECT *, 100.0 FROM {name}_totals), {name} AS (
  SELECT a.*, b.value AS value_year_ago, (a.value / nullif(b.value, 0) - 1.0) * 100.0 AS yoy_pct
  FROM {name}_all a LEFT JOIN {name}_all b ON a.code = b.code AND a.origin = b.origin
    AND b.period = a.period - INTERVAL 12 MONTH)"""


SNAPSHOTS = (_snapshot_sql("previous", "l_shipdate < TIMESTAMP '2001-05-01' AND NOT "
                           "(l_shipdate >= TIMESTAMP '2001-03-01' AND l_linenumber > 5)")
             + ", " + _snapshot_sql("latest", "true") + """, changed AS (
  SELECT l.*, p.value AS previous_value,
         CASE WHEN p.period IS NULL THEN 'new' WHEN l.value IS DISTINCT FROM p.value THEN 'revised' END AS change
  FROM latest l LEFT JOIN previous p ON l.period = p.period AND l.code = p.code AND l.origin = p.origin)""")


def changes(spark, sf):
    both = facts(spark, sf)
    return D.snapshot_diff(snapshot(both, "before"), snapshot(both, "now"), ["source", "period", "code", "origin"], "value")


@query("snapshot_diff", "source period:d code origin value:n previous_value:n change", SNAPSHOTS, """result AS (
  SELECT 'us' AS source, period, code, origin, value, previous_value, change FROM changed WHERE change IS NOT NULL)""")
def snapshot_diff(spark, sf):
    return changes(spark, sf)


@query("change_counts", "source period:d n_new:i n_revised:i groups:i", SNAPSHOTS, """counts AS (
  SELECT period, count(*) FILTER (change = 'new') AS n_new, count(*) FILTER (change = 'revised') AS n_revised
  FROM changed WHERE change IS NOT NULL GROUP BY 1)""", """result AS (
  SELECT 'us' AS source, period, n_new, n_revised, 1 AS groups FROM counts
  UNION ALL SELECT 'all', NULL, sum(n_new), sum(n_revised), count(*) FROM counts)""")
def change_counts(spark, sf):
    counts = D.change_counts(changes(spark, sf), ["source", "period"]).withColumn("groups", F.lit(1).cast("bigint"))
    totals = D.change_totals(counts).select(F.lit("all").alias("source"), F.lit(None).cast("date").alias("period"),
                                            "n_new", "n_revised", F.col("n_groups").alias("groups"))
    return counts.unionByName(totals)


@query("intel_flags", "period:d code origin kind detail:n value:n", SNAPSHOTS, """headline AS (
  SELECT period, code, origin FROM latest WHERE origin = '-'
  UNION ALL SELECT period, code, origin FROM latest WHERE origin <> '-'
  QUALIFY row_number() OVER (PARTITION BY period, code ORDER BY value DESC, origin) <= 6), candidates AS (
  SELECT c.*, p.share_pct AS prior FROM changed c JOIN headline USING (period, code, origin)
  LEFT JOIN latest p ON p.code = c.code AND p.origin = c.origin AND p.period = c.period - INTERVAL 1 MONTH
  WHERE c.change = 'new'), material AS (
  SELECT * FROM candidates WHERE origin = '-'
     OR (greatest(coalesce(share_pct, 0), coalesce(prior, 0)) >= 5 AND coalesce(value, 0) >= 5000))""", """result AS (
  SELECT period, code, origin, 'yoy' AS kind, yoy_pct AS detail, value FROM material
  WHERE abs(yoy_pct) >= CASE WHEN origin = '-' THEN 25 ELSE 50 END
  UNION ALL SELECT period, code, origin, 'share', share_pct - prior, value FROM material
  WHERE origin <> '-' AND abs(share_pct - prior) >= 5)""")
def intel_flags(spark, sf):
    return D.intel_flags(fresh_origins(spark, sf), F.col("yoy_pct"), F.col("value"), F.col("origin") != "-", F.col("share_pct"),
                         F.col("prior"), F.lit(False))


def fresh_origins(spark, sf):
    """New headline rows of brands and nations, with the share of the month before."""
    both = facts(spark, sf)
    current = snapshot(both, "now")
    diff = D.snapshot_diff(snapshot(both, "before"), current, ["source", "period", "code", "origin"], "value")
    headline = D.origin_headline(current, ["period", "code"], "origin", "value")
    prior = current.select("code", "origin", F.add_months("period", 1).alias("period"),
                           F.col("share_pct").alias("prior"))
    return (diff.where(F.col("change") == "new")
            .join(headline.select("period", "code", "origin"), ["period", "code", "origin"], "left_semi")
            .join(prior, ["period", "code", "origin"], "left"))


# --- Flags of several sources ------------------------------------------------------------

PRESS = """press_rows AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, series || o_orderpriority
      || CASE WHEN o_orderpriority = '5-LOW' THEN ' ' || year(o_orderdate) ELSE '' END AS code,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS value,
    100.0 * CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (day(o_orderdate) <= 10), 0) AS DOUBLE) / 1000
      / nullif(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000, 0) AS yoy_published
  FROM orders, (VALUES ('press:'), ('timeseries:')) t(series) GROUP BY 1, 2), press_new AS (
  SELECT a.period, a.code, a.value, coalesce((a.value / nullif(b.value, 0) - 1.0) * 100.0, a.yoy_published) AS yoy
  FROM press_rows a LEFT JOIN press_rows b ON a.code = b.code AND b.period = CAST(a.period - INTERVAL 12 MONTH AS DATE)
  WHERE a.period >= DATE '2001-03-01' AND NOT starts_with(a.code, 'timeseries:'))"""


@query("intel_flags_sources", "source_order:i source period:d place:i code origin kind detail:n value:n", SNAPSHOTS, PRESS, """headline AS (
  SELECT period, code, origin FROM latest WHERE origin = '-'
  UNION ALL SELECT period, code, origin FROM latest WHERE origin <> '-'
  QUALIFY row_number() OVER (PARTITION BY period, code ORDER BY value DESC, origin) <= 6), candidates AS (
  SELECT c.*, p.share_pct AS prior FROM changed c JOIN headline USING (period, code, origin)
  LEFT JOIN latest p ON p.code = c.code AND p.origin = c.origin AND p.period = c.period - INTERVAL 1 MONTH
  WHERE c.change = 'new'), material AS (
  SELECT * FROM candidates WHERE origin = '-'
     OR (greatest(coalesce(share_pct, 0), coalesce(prior, 0)) >= 5 AND coalesce(value, 0) >= 5000)), flags AS (
  SELECT 1 AS source_order, 'press' AS source, period, code, NULL AS origin, 'yoy' AS kind, yoy AS detail, value FROM press_new WHERE abs(yoy) >= 25
  UNION ALL SELECT 2, 'us', period, code, origin, 'yoy', yoy_pct, value FROM material
  WHERE abs(yoy_pct) >= CASE WHEN origin = '-' THEN 25 ELSE 50 END
  UNION ALL SELECT 2, 'us', period, code, origin, 'share', share_pct - prior, value FROM material
  WHERE origin <> '-' AND abs(share_pct - prior) >= 5)""", """result AS (
  SELECT *, row_number() OVER (PARTITION BY source, period ORDER BY abs(value) DESC, code, origin, kind DESC) AS place FROM flags)""")
def intel_flags_sources(spark, sf):
    """Press prints, of which a long series repeats every one and some have no year-ago value, beside brands and nations."""
    orders = table(spark, sf, "orders").withColumns({
        "period": F.trunc("o_orderdate", "month"), "series": F.explode(F.array(F.lit("press:"), F.lit("timeseries:"))),
        "item": F.concat("o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit(" "), F.year("o_orderdate"))).otherwise(""))})
    thousands = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double") / 1000
    early = F.when(F.dayofmonth("o_orderdate") <= 10, money("o_totalprice"))
    prints = (orders.groupBy("period", F.concat("series", "item").alias("code"))
              .agg(thousands(money("o_totalprice")).alias("value"), thousands(early).alias("_early"))
              .withColumn("yoy_published", 100.0 * F.try_divide(F.col("_early"), F.col("value"))).drop("_early")
              .withColumns({"source": F.lit("press"), "origin": F.lit(None).cast("string"),
                            "repeats": F.startswith("code", F.lit("timeseries:"))}))
    current = G.yoy_self_join(prints, ["source", "code", "origin", "repeats"])
    press = D.snapshot_diff(prints.where("period < date '2001-03-01'"), current, ["source", "period", "code", "origin"], "value")
    none = F.lit(None).cast("double")
    press = press.where(F.col("change") == "new").withColumns({"share_pct": none, "prior_share": none})
    origins = fresh_origins(spark, sf).withColumnRenamed("prior", "prior_share").withColumns({"yoy_published": none, "repeats": F.lit(False)})
    columns = ["source", "period", "code", "origin", "value", "yoy_pct", "yoy_published", "share_pct", "prior_share", "repeats"]
    return D.ranked_flags(press.select(columns).unionByName(origins.select(columns)), ["press", "us"], "origin")
