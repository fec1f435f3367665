"""Number, month, window, stage and date expressions over whole tables."""

from pyspark.sql import functions as F

from firstprint.functions import numbers as N, periods as P, text as X
from firstprint.plans.registry import query
from firstprint.plans.tables import money, table


@query("parse_number", "l_returnflag l_linestatus n:i missing:i total:n", """result AS (
  SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_linenumber = 4) AS missing,
         CAST(sum(CASE l_linenumber WHEN 4 THEN NULL WHEN 2 THEN -1 WHEN 3 THEN -1 ELSE 1 END
                  * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM lineitem GROUP BY 1, 2)""")
def parse_number(spark, sf):
    """Prices written as '1,234.50', '(1,234.50)', '△1,234.50', '--' and '1234.5%'."""
    grouped = F.format_number("l_extendedprice", 2)
    line = F.col("l_linenumber")
    text = (F.when(line == 1, grouped).when(line == 2, F.concat(F.lit("("), grouped, F.lit(")")))
            .when(line == 3, F.concat(F.lit("△"), grouped)).when(line == 4, F.lit("--"))
            .otherwise(F.concat(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("%"))))
    parsed = table(spark, sf, "lineitem").withColumn("v", N.parse_number(text))
    return parsed.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v").isNull()).alias("missing"),
        F.sum(money("v")).cast("double").alias("total"))


@query("fmt_number", "text n:i", """result AS (
  SELECT CASE WHEN v = floor(v) THEN CAST(CAST(v AS BIGINT) AS VARCHAR) ELSE printf('%.2f', v) END AS text, count(*) AS n
  FROM (SELECT l_quantity AS v FROM lineitem UNION ALL SELECT l_discount FROM lineitem
        UNION ALL SELECT l_tax FROM lineitem) GROUP BY 1""".replace("GROUP BY 1", "GROUP BY 1)"))
def fmt_number(spark, sf):
    values = F.explode(F.array("l_quantity", "l_discount", "l_tax"))
    return (table(spark, sf, "lineitem").select(values.alias("v")).groupBy(N.fmt_number("v").alias("text"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("roc_month", "month slashed_back compact_month n:i", """result AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, (year(o_orderdate) - 1911) || '/' || strftime(o_orderdate, '%m')
         AS slashed_back, strftime(o_orderdate, '%Y-%m') AS compact_month, count(*) AS n FROM orders GROUP BY 1, 2, 3)""")
def roc_month(spark, sf):
    year = (F.year("o_orderdate") - 1911).cast("string")
    month = F.date_format("o_orderdate", "MM")
    slashed, compact = P.roc_month(F.concat_ws("/", year, month)), P.roc_month(F.concat(year, month))
    return (table(spark, sf, "orders").groupBy(slashed.alias("month"), P.to_roc_month(slashed).alias("slashed_back"),
                                               compact.alias("compact_month")).agg(F.count(F.lit(1)).alias("n")))


@query("month_range", "o_custkey:i months:i first:d last:d", """spans AS (
  SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1)""", """result AS (
  SELECT o_custkey, date_diff('month', a, b) + 1 AS months, date_trunc('month', a) AS first,
         date_trunc('month', b) AS last FROM spans)""")
def month_range(spark, sf):
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return (spans.withColumn("m", P.month_range("a", "b"))
            .select("o_custkey", F.size("m").alias("months"), F.col("m")[0].alias("first"),
                    F.element_at("m", -1).alias("last")))


@query("year_ago_key", "period:d year_ago:d n:i", """result AS (
  SELECT date_trunc('month', o_orderdate) AS period, date_trunc('month', o_orderdate) - INTERVAL 12 MONTH AS year_ago,
         count(*) AS n FROM orders GROUP BY 1, 2)""")
def year_ago_key(spark, sf):
    period = F.trunc("o_orderdate", "month")
    return (table(spark, sf, "orders").groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("year_ago", P.year_ago("period")))


@query("classify_window", "window english_month english_window n:i", """labelled AS (
  SELECT day(o_orderdate) AS d, CAST(o_orderdate AS DATE) AS date FROM orders)""", """result AS (
  SELECT CASE WHEN d = 10 THEN 'D10' WHEN d = 20 THEN 'D20' WHEN d >= 28 THEN 'FULL' ELSE '' END AS "window",
         strftime(date, '%Y-%m') AS english_month,
         CASE WHEN d = 10 THEN 'D10' WHEN d = 20 THEN 'D20' WHEN d >= 28 THEN 'FULL' ELSE '' END AS english_window,
         count(*) AS n FROM labelled GROUP BY 1, 2, 3)""")
def classify_window(spark, sf):
    """Labels such as '1998.08.01 ~ 1998.08.10' and 'Aug.1~Aug.10', the latter read weeks later."""
    day = F.to_date("o_orderdate")
    dotted = F.concat(F.date_format(F.trunc(day, "month"), "yyyy.MM.dd"), F.lit(" ~ "), F.date_format(day, "yyyy.MM.dd"))
    english = F.concat(F.date_format(day, "MMM"), F.lit(".1~"), F.date_format(day, "MMM"), F.lit("."), F.dayofmonth(day))
    read = P.english_window(english, F.date_add(day, 40))
    return (table(spark, sf, "orders").select(P.classify_window(dotted).alias("window"), read.alias("e"))
            .groupBy("window", F.col("e.month").alias("english_month"), F.col("e.window").alias("english_window"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("find_month", "o_orderpriority month n:i", """result AS (
  SELECT o_orderpriority, CASE WHEN o_orderpriority = '5-LOW' OR year(o_orderdate) < 2000 THEN '' ELSE strftime(o_orderdate, '%Y-%m') END
         AS month, count(*) AS n FROM orders GROUP BY 1, 2)""")
def find_month(spark, sf):
    kind = F.col("o_orderpriority")
    label = F.when(kind == "1-URGENT", F.date_format("o_orderdate", "yyyy.MM.dd")).otherwise("flash")
    field = F.when(kind == "2-HIGH", F.date_format("o_orderdate", "yyyyMMdd")).when(
        kind == "5-LOW", "none").otherwise(F.date_format("o_orderdate", "'as of' yyyy-MM"))
    """Only months from 2000 on are read as months."""
    return table(spark, sf, "orders").groupBy("o_orderpriority", P.find_month(label, field).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("stage_spans", "o_orderkey:i month:i stage", """result AS (
  SELECT o_orderkey, m AS month, CASE WHEN m < month(o_orderdate) OR month(o_orderdate) = 1 AND m = 1 AND false
           THEN 'DETAILED' WHEN m = month(o_orderdate) THEN 'PROV9' END AS stage
  FROM orders, (SELECT unnest(range(1, 13)) AS m) t WHERE m <= month(o_orderdate))""".replace(
    " OR month(o_orderdate) = 1 AND m = 1 AND false", ""))
def stage_spans(spark, sf):
    """Titles such as '1-6月：確報、7月：輸入9桁速報' for each order's month."""
    month = F.month("o_orderdate")
    head = F.when(month > 2, F.concat(F.lit("1-"), month - 1, F.lit("月：確報、"))).when(
        month == 2, F.lit("1月：確報、")).otherwise("")
    title = F.concat(F.lit("統計品別表 (輸入 "), head, month, F.lit("月：輸入9桁速報)"))
    return (table(spark, sf, "orders").select("o_orderkey", F.explode(P.stage_spans(title)).alias("s"))
            .select("o_orderkey", "s.month", "s.stage"))


@query("parse_any_date", "o_orderkey:i parsed:d document:d", """result AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderdate END AS parsed, o_orderdate AS document
  FROM orders)""")
def parse_any_date(spark, sf):
    kind, day = F.col("o_orderpriority"), F.col("o_orderdate")
    serial = (F.unix_date(F.to_date(day)) + 25569).cast("string")
    text = (F.when(F.col("o_orderstatus") == "P", "HOLIDAY").when(kind == "1-URGENT", serial)
            .when(kind == "2-HIGH", F.date_format(day, "dd-MMM-yyyy")).when(kind == "3-MEDIUM", F.date_format(day, "yyyy-MM-dd"))
            .when(kind == "5-LOW", F.upper(F.date_format(day, "d-MMM-yy"))).otherwise(F.date_format(day, "MM/dd/yyyy")))
    stamp = (F.when(kind == "1-URGENT", F.date_format(day, "yyyy-MM-dd HH:mm")).when(
        kind == "2-HIGH", F.date_format(day, "yyyyMMdd")).otherwise(F.date_format(day, "d MMM yyyy, h:mm a")))
    return table(spark, sf, "orders").select("o_orderkey", P.parse_any_date(text).alias("parsed"),
                                             P.document_date(stamp).alias("document"))


@query("local_date", "new_york:d tokyo:d from_mail:d n:i", """result AS (
  SELECT CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) AS new_york,
         CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo' AS DATE) AS tokyo,
         CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) AS from_mail, count(*) AS n
  FROM events GROUP BY 1, 2, 3)""")
def local_date(spark, sf):
    mail = P.rfc822_timestamp(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
    return (table(spark, sf, "events").groupBy(
        P.local_date("ts").alias("new_york"), P.local_date("ts", "Asia/Tokyo").alias("tokyo"),
        P.local_date(mail).alias("from_mail")).agg(F.count(F.lit(1)).alias("n")))


@query("week_labels", "day:d sunday_end:d friday:d sunday_start:d n:i", """result AS (
  SELECT day, day + CAST(7 - isodow(day) AS INTEGER) AS sunday_end,
         day + CAST((12 - isodow(day)) % 7 AS INTEGER) AS friday, day - CAST(isodow(day) % 7 AS INTEGER) AS sunday_start,
         count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders) GROUP BY 1)""")
def week_labels(spark, sf):
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return (days.withColumn("sunday_end", P.week_ending_sunday("day")).withColumn("friday", P.friday_label("day"))
            .withColumn("sunday_start", P.week_start_sunday("day")))


@query("business_days_between", "l_returnflag n:i business_days:i", """days AS (
  SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders) - INTERVAL 1 DAY,
    (SELECT max(l_shipdate) FROM lineitem), INTERVAL 1 DAY)) AS DATE) AS d), running AS (
  SELECT d, sum(CASE WHEN isodow(d) < 6 THEN 1 ELSE 0 END) OVER (ORDER BY d) AS k FROM days)""", """result AS (
  SELECT l_returnflag, count(*) AS n, sum(CASE WHEN b.d > a.d THEN b.k - a.k ELSE 0 END) AS business_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN running a ON a.d = CAST(o_orderdate AS DATE)
  JOIN running b ON b.d = CAST(l_shipdate AS DATE) GROUP BY 1)""")
def business_days_between(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("a"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", F.to_date("l_shipdate").alias("b"))
    return (lines.join(orders, "l_orderkey").groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(P.business_days_between("a", "b")).alias("business_days")))


@query("link_helpers", "page_id:i target dotted", """result AS (
  SELECT page_id, url AS target, substr(lpad(CAST(page_id AS VARCHAR), 10, '0'), 1, 4) || '.'
         || substr(lpad(CAST(page_id AS VARCHAR), 10, '0'), 5, 2) || '.'
         || substr(lpad(CAST(page_id AS VARCHAR), 10, '0'), 7, 2) || '.'
         || substr(lpad(CAST(page_id AS VARCHAR), 10, '0'), 9, 2) AS dotted FROM pages)""")
def link_helpers(spark, sf):
    """Redirect links unwrapped, and ten-digit codes written with their dots."""
    wrapped = F.concat(F.lit("https://example.org/rd.php?"), F.col("url"))
    code = F.lpad(F.col("page_id").cast("string"), 10, "0")
    return table(spark, sf, "pages").select("page_id", X.unwrap_redirect(wrapped).alias("target"),
                                            X.dotted_code(code).alias("dotted"))
