"""Published layouts and payload shapes, derived from the tables and parsed back."""

from pyspark.sql import functions as F

from firstprint.functions.numbers import parse_number
from firstprint.functions.periods import parse_any_date, stage_spans
from firstprint.functions.staging import once
from firstprint.operators import reshape as R
from firstprint.plans.registry import query
from firstprint.plans.tables import FX_DAILY, fx_daily, money, table
from firstprint.session import scratch_dir, spread
from firstprint.sources import delimited as DL, fields as FD, jsons as J, pages as PG, xmls as XM


# --- Delimited files ------------------------------------------------------------------

@query("csv_strings", "c_custkey c_mktsegment c_acctbal missing:b n:i", """result AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal,
         true AS missing, 1 AS n FROM customer
  UNION ALL SELECT NULL, NULL, NULL, true, 0""" + ")")
def csv_strings(spark, sf):
    """Customers written as a CSV and read back by name, and a file that is not there."""
    path = scratch_dir(spark, "csv")
    (table(spark, sf, "customer").withColumn("c_acctbal", money("c_acctbal")).write.option("header", True).csv(path))
    rows = DL.csv_strings(spark, path, ["c_custkey", "c_mktsegment", "c_acctbal", "c_phone"])
    absent = DL.csv_strings(spark, path + "-absent", ["c_custkey"]).agg(F.count(F.lit(1)).alias("n"))
    return (rows.select("c_custkey", "c_mktsegment", "c_acctbal", F.col("c_phone").isNull().alias("missing"), F.lit(1).alias("n"))
            .unionByName(absent.withColumn("missing", F.lit(True)), allowMissingColumns=True))


@query("multi_file_last_wins", "o_custkey value:n", """yearly AS (
  SELECT o_custkey, year(o_orderdate) AS y, max(o_totalprice) AS v FROM orders GROUP BY 1, 2)""", """result AS (
  SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, arg_max(v, y) AS value FROM yearly GROUP BY 1)""")
def multi_file_last_wins(spark, sf):
    path = scratch_dir(spark, "monthly-files")
    yearly = (table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y"))
              .agg(money(F.max("o_totalprice")).alias("value")))
    yearly.repartition("y").write.partitionBy("y").option("header", True).csv(path)
    rows = DL.multi_file_last_wins(spark, f"{path}/y=*/*.csv", ["o_custkey", "value"], ["o_custkey"])
    return rows.withColumn("value", F.col("value").cast("double"))


ARCHIVE = "Fund archive,,\nDisclaimer: none,,\nDate,Price,Tonnes in Trust\n"


@query("preamble_csv", "l_orderkey:i l_linenumber:i date:d tonnes:n", """result AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, l_quantity + 1 AS tonnes FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) + 1, l_quantity FROM lineitem)""")
def preamble_csv(spark, sf):
    """A file per line: preamble, header, a holiday, a repeated date and another date."""
    day = lambda d, layout: F.date_format(d, layout)
    first = F.to_date("l_shipdate")
    body = F.concat(F.lit(ARCHIVE), day(first, "dd-MMM-yyyy"), F.lit(",1,"), F.col("l_quantity"), F.lit("\n"),
                    day(F.date_add(first, 2), "dd-MMM-yyyy"), F.lit(",HOLIDAY,HOLIDAY\n"),
                    day(F.date_add(first, 1), "yyyy-MM-dd"), F.lit(",1,"), F.col("l_quantity"), F.lit("\r\n"),
                    day(first, "MM/dd/yyyy"), F.lit(",2,"), F.col("l_quantity") + 1, F.lit("\n"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    files = spread(table(spark, sf, "lineitem").select(*keys, "l_shipdate", "l_quantity")).select(*keys, body.alias("body"))
    rows = DL.preamble_rows(files, "body", "date", "tonne", keep=keys)
    rows = once(rows, [*keys, "line"], _date=DL.cell("header", "cells", "date"),
                _tonnes=DL.cell("header", "cells", lambda h: h.contains("tonne")))
    rows = once(rows, [*keys, "line"], date=parse_any_date("_date"), tonnes=parse_number("_tonnes"))
    return DL.last_per_date(rows.where(F.col("tonnes") > 0), keys, "date", "line")


# --- JSON ---------------------------------------------------------------------------------

@query("json_records", "event_id:i k:i kind", """result AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events
  UNION ALL SELECT event_id, user_id, 'user' FROM events WHERE event_type <> 'error')""")
def json_records(spark, sf):
    """Event properties as record arrays, users inside a status envelope."""
    events = table(spark, sf, "events")
    arrays = events.select("event_id", F.col("event_type").alias("kind"), F.concat(F.lit("["), "props", F.lit("]")).alias("body"))
    records = J.json_records(arrays, "body", ["k"], ["event_id", "kind"]).select("event_id", "k", "kind")
    status = F.when(F.col("event_type") == "error", "013").otherwise("000")
    boxed = events.select("event_id", F.to_json(F.struct(
        status.alias("status"), F.lit("ok").alias("message"),
        F.array(F.struct(F.col("user_id").cast("string").alias("k"))).alias("list"))).alias("body"))
    users = J.status_records(boxed, "body", "list", ["k"], ["event_id"]).select("event_id", "k", F.lit("user").alias("kind"))
    return records.unionByName(users)


@query("json_header_rows", "l_returnflag cty_code n:i value:n qty1:n", """result AS (
  SELECT l_returnflag, CAST(l_suppkey AS VARCHAR) AS cty_code, count(*) AS n,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value, sum(l_quantity) AS qty1
  FROM lineitem GROUP BY 1, 2
  UNION ALL SELECT l_returnflag, 'X1', count(*), 0, sum(l_linenumber) FROM lineitem GROUP BY 1)""")
def json_header_rows(spark, sf):
    """Three partner rows per payload: a trade, a quantity without value, and nothing."""
    text = lambda c: F.col(c).cast("string")
    nothing = F.lit(None).cast("string")
    body = F.to_json(F.array(
        F.array(F.lit("CTY_CODE"), F.lit("ALL_VAL_MO"), F.lit("GEN_VAL_MO"), F.lit("GEN_QY1_MO")),
        F.array(text("l_suppkey"), nothing, money("l_extendedprice").cast("string"), text("l_quantity")),
        F.array(F.lit("X1"), F.lit("0"), nothing, text("l_linenumber")),
        F.array(F.lit("9999"), F.lit("0"), F.lit("0"), F.lit("0"))))
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_suppkey", "l_extendedprice", "l_quantity", "l_linenumber")
    payloads = spread(lines).select("l_returnflag", body.alias("body"))
    rows = J.trade_records(J.header_rows(payloads, "body", ["l_returnflag"]), "CTY_CODE", ["GEN_VAL_MO", "ALL_VAL_MO"],
                           ["GEN_QY1_MO", "QTY_1_MO"], ["l_returnflag"])
    return rows.groupBy("l_returnflag", "cty_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("value")).cast("double").alias("value"), F.sum("qty1").alias("qty1"))


@query("json_parallel_arrays", "event_id:i date:d close:n adj_close:n", """result AS (
  SELECT event_id, CAST(ts - INTERVAL 5 HOUR AS DATE) AS date, value AS close, value + 1 AS adj_close FROM events)""")
def json_parallel_arrays(spark, sf):
    stamp = F.unix_timestamp(F.col("ts").cast("timestamp"))
    adj = F.array(F.struct(F.array(F.col("value") + 1, F.lit(5.0)).alias("adjclose")))
    body = F.to_json(F.struct(F.struct(F.array(F.struct(
        F.struct(F.lit(-18000).alias("gmtoffset")).alias("meta"), F.array(stamp, stamp + 86400).alias("timestamp"),
        F.struct(F.array(F.struct(F.array(F.col("value"), F.lit(None).cast("double")).alias("close"))).alias("quote"),
                 adj.alias("adjclose")).alias("indicators"))).alias("result")).alias("chart")), {"ignoreNullFields": "false"})
    return J.parallel_arrays(table(spark, sf, "events").select("event_id", body.alias("body")), "body", ["event_id"])


@query("json_date_map", "date quote rate:n", FX_DAILY, """result AS (
  SELECT strftime(date, '%Y-%m-%d') AS date, quote, rate FROM fx_daily WHERE quote IN ('A', 'N') AND rate > 0)""")
def json_date_map(spark, sf):
    rates = fx_daily(spark, sf)
    day = F.concat(F.lit('{"rates":{"'), F.col("date").cast("string"), F.lit('":{"'), F.lower("quote"), F.lit('":'),
                   F.col("rate"), F.lit(',"zzz":1.5,"n0":-1}}}'))
    return J.date_map(rates.select(day.alias("body")), "body", ["A", "N"])


# --- XML, fields, pages -------------------------------------------------------------------

@query("xml_rows", "o_orderkey:i position:i month value", """result AS (
  SELECT o_orderkey, 0 AS position, strftime(o_orderdate, '%Y-%m') AS month,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS value FROM orders
  UNION ALL SELECT o_orderkey, 2, strftime(o_orderdate, '%Y-%m'), '7' FROM orders)""")
def xml_rows(spark, sf):
    """Items of an API answer, with a totals row and an empty one that are dropped."""
    month = F.date_format("o_orderdate", "yyyy.MM")
    item = lambda a, b: F.concat(F.lit("<item><year> "), a, F.lit(" </year><expDlr>"), b, F.lit("</expDlr></item>"))
    body = F.concat(F.lit("<response><header><resultCode>00</resultCode></header><body><items>"),
                    item(month, money("o_totalprice").cast("string")), item(F.lit("총계"), F.lit("99")),
                    item(month, F.lit("7")), F.lit("<item><year></year></item></items></body></response>"))
    rows = XM.xml_rows(table(spark, sf, "orders").select("o_orderkey", body.alias("body")), "body",
                       ["body", "items", "item"], ["year", "expDlr"], ["o_orderkey"])
    return XM.drop_totals(rows, "year").select("o_orderkey", "position", F.replace("year", F.lit("."), F.lit("-")).alias("month"),
                                               F.col("expDlr").alias("value"))


@query("first_present_field", "o_orderkey:i value extra", """result AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN CAST(o_custkey AS VARCHAR) ELSE '' END
    AS value, '{"alt":"' || CASE o_orderstatus WHEN 'O' THEN CAST(o_custkey AS VARCHAR) ELSE '' END || '","main":"'
    || CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN ' ' ELSE '' END || '"}' AS extra FROM orders)""")
def first_present_field(spark, sf):
    status = F.col("o_orderstatus")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.when(status == "F", F.col("o_orderpriority")).when(status == "O", " ").otherwise("").alias("main"),
        F.when(status == "O", F.col("o_custkey").cast("string")).alias("alt"))
    return rows.select("o_orderkey", FD.first_present_field(rows, ["main", "not_there", "alt"]).alias("value"),
                       FD.extra_json(rows, ["main", "alt"]).alias("extra"))


def sql_clean(c: str) -> str:
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                         ("&apos;", "''"), ("&pound;", "£"), ("&amp;", "&")):
        c = (f"regexp_replace({c}, '<[^>]+>', ' ', 'g')" if entity == "&nbsp;" else c)
        c = f"replace({c}, '{entity}', '{char}')"
    return f"trim(regexp_replace({c}, '[\\s' || chr(160) || chr(11) || ']+', ' ', 'g'))"


@query("html_table_rows", "page_id:i position:i section cells:i digest", """raw_rows AS (
  SELECT page_id, unnest(regexp_extract_all(replace(replace(html, '<p>', '<tr><td>'), '</p>', '</td></tr>'),
      '(?is)<tr>(.*?)</tr>', 1)) AS r, generate_subscripts(regexp_extract_all(replace(replace(html, '<p>', '<tr><td>'),
      '</p>', '</td></tr>'), '(?is)<tr>(.*?)</tr>', 1), 1) - 1 AS position FROM pages), celled AS (
  SELECT page_id, position, list_transform(regexp_extract_all(r, '(?is)<td>(.*?)</td>', 1), lambda c: """ + sql_clean("c") + """)
    AS cells FROM raw_rows), labelled AS (
  SELECT *, nullif(regexp_extract(array_to_string(cells, ' '), 'The ([a-z]+)', 1), '') AS label FROM celled)""", """result AS (
  SELECT page_id, position, coalesce(last_value(label IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY position), '')
    AS section, len(cells) AS cells, md5(array_to_string(cells, '|')) AS digest FROM labelled)""")
def html_table_rows(spark, sf):
    """Page paragraphs marked up as table rows; rows naming 'The x' open a section."""
    marked = F.replace(F.replace("html", F.lit("<p>"), F.lit("<tr><td>")), F.lit("</p>"), F.lit("</td></tr>"))
    pages = table(spark, sf, "pages").select("page_id", marked.alias("html"))
    rows = PG.html_table_rows(pages, "html", ["page_id"], r"The ([a-z]+)")
    return rows.select("page_id", "position", "section", F.size("cells").alias("cells"),
                       F.md5(F.array_join("cells", "|").cast("binary")).alias("digest"))


LINK = '<a href="/([^"]*)">(.*?)</a>'


@query("html_links_with_context", "page_id:i id text context", f"""links AS (
  SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS id, unnest(regexp_extract_all(html, '{LINK}', 2)) AS t,
         unnest(list_slice(string_split_regex(html, '{LINK.replace("(", "(?:")}'), 1, len(regexp_extract_all(html, '{LINK}', 1)))) AS gap,
         generate_subscripts(regexp_extract_all(html, '{LINK}', 1), 1) AS position FROM pages), found AS (
  SELECT *, list_extract(regexp_extract_all({sql_clean('gap')}, '[A-Z][a-z]+'), -1) AS c FROM links), carried AS (
  SELECT *, coalesce(last_value(nullif(c, '') IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY position), '') AS context
  FROM found)""", f"""result AS (
  SELECT page_id, id, {sql_clean('t')} AS text, context FROM carried WHERE {sql_clean('t')} <> ''
  QUALIFY row_number() OVER (PARTITION BY page_id, id ORDER BY position) = 1)""")
def html_links_with_context(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    return PG.html_links_with_context(pages, "html", ["page_id"], LINK, 1, 2, "[A-Z][a-z]+")


@query("text_field_extract", "l_orderkey:i l_linenumber:i trade_date:d shares:n avg_price:n low programme", """result AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS trade_date, l_quantity * 1000 AS shares,
         l_extendedprice AS avg_price, '' AS low, CASE WHEN l_linestatus = 'F' THEN 'share buyback programme' ELSE '' END
         AS programme FROM lineitem)""")
def text_field_extract(spark, sf):
    """Own-share notices in two wordings, one without a programme."""
    day = F.date_format("l_shipdate", "d MMMM yyyy")
    shares = F.format_number(F.col("l_quantity") * 1000, 0)
    price = F.format_number("l_extendedprice", 2)
    table_form = F.concat(F.lit("<p>Date of purchase: "), day, F.lit("</p><p>Number of ordinary shares purchased:&nbsp;"), shares,
                          F.lit("</p> Volume weighted average price paid per share: GBp "), price,
                          F.lit(" pursuant to its share buyback programme."))
    prose = F.concat(F.lit("The Company announces that on "), day, F.lit(" it purchased. Aggregate number of own shares bought: "),
                     shares, F.lit(" Average price paid per share: pence "), price)
    notice = F.when(F.col("l_linestatus") == "F", table_form).otherwise(prose)
    rows = PG.text_field_extract(table(spark, sf, "lineitem"), notice, PG.OWN_SHARE_PATTERNS, ["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", F.try_to_date("trade_date", "d MMMM yyyy").alias("trade_date"),
                       F.col("shares").try_cast("double").alias("shares"), F.col("avg_price_gbp_pence").try_cast("double").alias("avg_price"),
                       F.col("low_pence").alias("low"), "programme")


# --- Reshape --------------------------------------------------------------------------------

GROUP_OF = {"1-URGENT": "dealer", "2-HIGH": "asset_manager", "3-MEDIUM": "leveraged_money", "4-NOT SPECIFIED": "other_reportable",
            "5-LOW": "nonreportable"}
GROUP_ROWS = ", ".join(f"('{p}', '{g}')" for p, g in GROUP_OF.items())


@query("wide_to_long_groups", "week:d trader_group long:n short:n spread:n net:n", f"""legs AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, trader_group,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS DOUBLE) AS long,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS DOUBLE) AS short,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P') AS DOUBLE) AS spread
  FROM orders JOIN (VALUES {GROUP_ROWS}) t(p, trader_group) ON o_orderpriority = p GROUP BY 1, 2)""", """result AS (
  SELECT week, trader_group, long, short, CASE WHEN trader_group <> 'nonreportable' THEN spread END AS spread,
    round(long - short, 2) AS net FROM legs WHERE long IS NOT NULL AND short IS NOT NULL)""")
def wide_to_long_groups(spark, sf):
    """Weekly records with the publisher's wide field names, numbers as text; every priority is a trader group."""
    def cell(priority, status):
        hit = (F.col("o_orderpriority") == priority) & (F.col("o_orderstatus") == status)
        return F.sum(F.when(hit, money("o_totalprice"))).cast("string")
    groups = R.report_groups("tff_fut")
    cells = [cell(p, s).alias(f) for p, g in GROUP_OF.items() for f, s in zip(groups[g], ("O", "F", "P")) if f]
    wide = table(spark, sf, "orders").groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("week")).agg(*cells)
    return R.wide_to_long_groups(wide, ["week"], groups).withColumn("net", F.round("net", 2))


MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


@query("wide_months_to_long", "item yyyymm value:n quantity1:n stage", """result AS (
  SELECT o_orderpriority AS item, strftime(o_orderdate, '%Y-%m') AS yyyymm,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value, count(*) AS quantity1,
    CASE WHEN month(any_value(o_orderdate)) <= 6 THEN 'DETAILED' WHEN month(any_value(o_orderdate)) = 7 THEN 'PROV9' ELSE '' END
      AS stage FROM orders GROUP BY 1, 2)""")
def wide_months_to_long(spark, sf):
    month = F.month("o_orderdate")
    cells = []
    for i, name in enumerate(MONTH_NAMES, start=1):
        cells += [F.coalesce(F.sum(F.when(month == i, money("o_totalprice"))), F.lit(0)).cast("string").alias(f"Value-{name}"),
                  F.count_if(month == i).cast("string").alias(f"Quantity1-{name}")]
    wide = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("item"), F.year("o_orderdate").alias("Year")).agg(*cells)
    return R.wide_months_to_long(wide, ["item"], "Year", stage_spans(F.lit("1-6月：確報、7月：輸入9桁速報")))


@query("paired_columns_to_long", "l_orderkey:i l_linenumber:i name value:n quantity:n", """result AS (
  SELECT l_orderkey, l_linenumber, 'TOTAL' AS name, l_extendedprice AS value, NULL AS quantity FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'GOODS', l_quantity, l_linenumber FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'TAX', l_tax, l_discount FROM lineitem WHERE l_tax <> 0)""")
def paired_columns_to_long(spark, sf):
    words = lambda *ws: F.array(*[F.lit(w) for w in ws])
    names = words("", "TOTAL", "GOODS", "", "TAX", "")
    kinds = words("", "金額", "数量", "金額", "数量", "金額")
    cells = F.array(F.lit("1998/01"), *[F.col(c).cast("string") for c in
                                        ("l_extendedprice", "l_linenumber", "l_quantity", "l_discount", "l_tax")])
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    return R.paired_columns_to_long(spread(lines), ["l_orderkey", "l_linenumber"], cells, names, kinds)


@query("windows_to_long", "yyyymm window is_total:b name value:n", """detail AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS yyyymm, w AS "window", o_orderpriority AS name, CAST(o_totalprice AS DECIMAL(18,2)) AS v
  FROM orders JOIN (VALUES ('D10', 10), ('D20', 20), ('FULL', 31)) t(w, last) ON day(o_orderdate) <= last)""", """result AS (
  SELECT yyyymm, "window", false AS is_total, name, CAST(sum(v) AS DOUBLE) AS value FROM detail GROUP BY 1, 2, 4
  UNION ALL SELECT yyyymm, "window", true, 'TOTAL', CAST(sum(v) AS DOUBLE) FROM detail GROUP BY 1, 2)""")
def windows_to_long(spark, sf):
    orders = table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    day = F.dayofmonth("o_orderdate")
    cells = [F.format_number(F.coalesce(F.sum(F.when(day <= last, money("o_totalprice"))), F.lit(0)), 2).alias(name)
             for name, last in (("amt1", 10), ("amt2", 20), ("amt3", 31))]
    rows = (orders.rollup("month", "o_orderpriority").agg(F.grouping("o_orderpriority").alias("g"), *cells)
            .where(F.col("month").isNotNull()))
    payload = rows.withColumn("uprId", F.when(F.col("g") == 0, F.col("month")).otherwise("")).withColumn("lwprId", F.col("month"))
    return R.windows_to_long(payload, [], {"amt1": "D10", "amt2": "D20", "amt3": "FULL"}, "uprId", "lwprId", "o_orderpriority")


@query("drop_empty_measures", "l_returnflag n:i kept_quantity:i", """result AS (
  SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_tax = 0) AS kept_quantity FROM lineitem
  WHERE l_tax IS NOT NULL AND (l_tax <> 0 OR coalesce(l_discount, 0) <> 0) GROUP BY 1)""")
def drop_empty_measures(spark, sf):
    kept = R.drop_empty_measures(table(spark, sf, "lineitem"), "l_tax", "l_discount")
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_tax") == 0).alias("kept_quantity"))
