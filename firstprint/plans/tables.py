"""The driver tables, and the release-style views the queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from firstprint.operators.releases import grain_sums


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def money(c) -> F.Column:
    """Cents-exact money, so sums do not depend on the order of addition."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def release(spark, sf) -> DataFrame:
    """Monthly release: order value per month and priority."""
    return (table(spark, sf, "orders")
            .groupBy(F.trunc("o_orderdate", "month").alias("period"), F.col("o_orderpriority").alias("item"))
            .agg(F.sum(money("o_totalprice")).cast("double").alias("value")))


RELEASE = """release AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderpriority AS item,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2)"""


def window_release(spark, sf) -> DataFrame:
    """The same with the windows D10, D20 and MONTH: cumulative within the month."""
    day = F.dayofmonth("o_orderdate")
    sums = [F.sum(F.when(day <= last, money("o_totalprice"))).cast("double").alias(name)
            for name, last in (("D10", 10), ("D20", 20), ("MONTH", 31))]
    wide = table(spark, sf, "orders").groupBy(
        F.trunc("o_orderdate", "month").alias("period"), F.col("o_orderpriority").alias("item")).agg(*sums)
    return (wide.unpivot(["period", "item"], ["D10", "D20", "MONTH"], "window", "value")
            .where(F.col("value") != 0))


WINDOW_RELEASE = """window_release AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderpriority AS item, w AS "window",
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN (VALUES ('D10', 10), ('D20', 20), ('MONTH', 31)) t(w, last)
    ON day(o_orderdate) <= last
  GROUP BY 1, 2, 3)"""


def positions(spark, sf) -> DataFrame:
    """Weekly long, short, net and open interest per priority, dated by Monday."""
    leg = lambda status: F.coalesce(F.sum(F.when(F.col("o_orderstatus") == status, money("o_totalprice"))),
                                    F.lit(0).cast("decimal(18,2)")).cast("double")
    return (table(spark, sf, "orders")
            .groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("report_date"),
                     F.col("o_orderpriority").alias("series"))
            .agg(leg("O").alias("long"), leg("F").alias("short"),
                 F.sum(money("o_totalprice")).cast("double").alias("open_interest"))
            .withColumn("net", F.round(F.col("long") - F.col("short"), 2)))


POSITIONS = """positions AS (
  SELECT report_date, series, long, short, open_interest, round(long - short, 2) AS net FROM (
    SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS report_date, o_orderpriority AS series,
           CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O'), 0) AS DOUBLE) AS long,
           CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F'), 0) AS DOUBLE) AS short,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS open_interest
    FROM orders GROUP BY 1, 2))"""


def daily_price(spark, sf) -> DataFrame:
    """Daily mean unit price per return flag."""
    return (table(spark, sf, "lineitem")
            .groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("ticker"))
            .agg((F.floor(F.sum(money("l_extendedprice")).cast("double")
                          / F.sum(money("l_quantity")).cast("double") * 10000) / 10000).alias("price")))


DAILY_PRICE = """daily_price AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS ticker,
         floor(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
               / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) * 10000) / 10000 AS price
  FROM lineitem GROUP BY 1, 2)"""


def fx_daily(spark, sf) -> DataFrame:
    """Daily rate per return flag: 100 plus the mean tax percent of the day's shipments."""
    return (table(spark, sf, "lineitem")
            .groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("quote"))
            .agg((F.floor((1.0 + F.sum(money("l_tax")).cast("double") / F.count("l_tax")) * 10000) / 100)
                 .alias("rate")))


FX_DAILY = """fx_daily AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS quote,
         floor((1.0 + CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(l_tax)) * 10000) / 100 AS rate
  FROM lineitem GROUP BY 1, 2)"""


def duty_paid() -> F.Column:
    """Price with tax in whole cents: what published totals are in, so parts do not add up to them."""
    return money(money("l_extendedprice") * (F.lit(1) + money("l_tax")))


def origin_lines(spark, sf) -> DataFrame:
    """Shipped lines with month, brand and supplier nation; a line of an unknown supplier has no origin."""
    line = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("code"))
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("origin"))
    return (line.join(part, line.l_partkey == part.p_partkey).join(supplier, line.l_suppkey == supplier.s_suppkey, "left")
            .withColumn("period", F.trunc("l_shipdate", "month")))


def origin_release(spark, sf) -> DataFrame:
    """Monthly value per brand and supplier nation, in thousands."""
    return (origin_lines(spark, sf).where(F.col("origin").isNotNull()).groupBy("period", "code", "origin")
            .agg((F.sum(money("l_extendedprice")).cast("double") / 1000).alias("value")))


ORIGIN_RELEASE = """origin_release AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, p_brand AS code,
         CAST(s_nationkey AS VARCHAR) AS origin,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3)"""


def code_totals(spark, sf) -> DataFrame:
    """Published total per month and brand, tax included."""
    line = table(spark, sf, "lineitem")
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("code"))
    return (line.join(part, line.l_partkey == part.p_partkey)
            .groupBy(F.trunc("l_shipdate", "month").alias("period"), "code")
            .agg((F.sum(duty_paid()).cast("double") / 1000).alias("total")))


CODE_TOTALS = """code_totals AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, p_brand AS code,
         CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(18,2))) AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS total
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def origin_rows(spark, sf) -> DataFrame:
    """`origin_release` and, as origin '-', `code_totals`, from one scan of the lines."""
    both = grain_sums(origin_lines(spark, sf), {"origin": ["period", "code", "origin"], "total": ["period", "code"]},
                      value=F.sum(money("l_extendedprice")).cast("double") / 1000, total=F.sum(duty_paid()).cast("double") / 1000)
    is_total = F.col("grain") == "total"
    return (both.where(is_total | F.col("origin").isNotNull())
            .select("period", "code", F.when(is_total, F.lit("-")).otherwise(F.col("origin")).alias("origin"),
                    F.when(is_total, F.col("total")).otherwise(F.col("value")).alias("value")))


def headlines(spark, sf) -> DataFrame:
    """Documents as collected stories: one row per search that caught each."""
    docs = table(spark, sf, "documents")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("doc_id"), F.lit(180)).cast("int"))
    searches = F.array_compact(F.array(F.concat(F.lit("lang_"), F.col("lang")),
                                       F.when(F.col("n_chars") >= 500, F.lit("long")),
                                       F.when(F.col("text").contains("the"), F.lit("the"))))
    return docs.select("doc_id", F.col("text").alias("title"), F.col("source").alias("outlet"), day.alias("published"),
                       "text", "n_chars", F.explode(searches).alias("query_id"))


HEADLINES = """headlines AS (
  SELECT doc_id, text AS title, source AS outlet,
         DATE '2024-01-01' + CAST(doc_id % 180 AS INTEGER) AS published, text, n_chars, query_id
  FROM documents, LATERAL (SELECT unnest(list_filter(
    ['lang_' || lang, CASE WHEN n_chars >= 500 THEN 'long' END, CASE WHEN contains(text, 'the') THEN 'the' END],
    lambda q: q IS NOT NULL)) AS query_id) t)"""
