import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from firstprint.functions.numbers import parse_number
from firstprint.functions.periods import parse_any_date, roc_month
from firstprint.operators import reshape as R
from firstprint.sources import delimited as DL, fields as FD, jsons as J, pages as PG, payloads as PL, xmls as XM


def body(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# --- Delimited ---------------------------------------------------------------------

def test_csv_by_name_and_missing_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a\n1,x\n,y\n")
    got = DL.csv_strings(spark, str(tmp_path / "a.csv"), ["a", "b", "c"])
    assert [tuple(r) for r in got.collect()] == [("x", "1", None), ("y", None, None)]
    assert DL.csv_strings(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0


def test_last_file_wins(spark, tmp_path):
    for name, value in (("2026-07.csv", 1), ("2026-08.csv", 2)):
        (tmp_path / name).write_text(f"k,v\na,{value}\n" + ("b,9\n" if value == 1 else ""))
    got = DL.multi_file_last_wins(spark, str(tmp_path / "*.csv"), ["k", "v"], ["k"])
    assert rows(got, "k", "v") == [("a", "2"), ("b", "9")]


def test_preamble_holidays_and_repeated_dates(spark):
    text = ("SPDR Gold\nDisclaimer\nDate, Ounces per Share, Total Net Assets Tonnes, Total Ounces in the Trust\n"
            "18-Nov-2004, 0.1, 8.09, 260000\n19-Nov-2004, HOLIDAY, HOLIDAY, HOLIDAY\n\n22-Nov-2004, 0.1, 57.85, 1860000\n"
            "18-Nov-2004, 0.1, 8.10, 260001\n")
    lines = DL.preamble_rows(body(spark, text, "no header here"), "body", "date", "tonne", ["id"])
    got = lines.select("id", "line", parse_any_date(DL.cell("header", "cells", "date")).alias("date"),
                       parse_number(DL.cell("header", "cells", lambda h: h.contains("tonne"))).alias("tonnes"),
                       parse_number(DL.cell("header", "cells", lambda h: h.contains("ounce") & h.contains("total"))).alias("oz"))
    got = DL.last_per_date(got.where("tonnes > 0"), ["id"], "date", "line")
    assert rows(got, "date", "tonnes", "oz") == [(dt.date(2004, 11, 18), 8.10, 260001.0), (dt.date(2004, 11, 22), 57.85, 1860000.0)]


def test_minguo_csv(spark):
    text = "﻿資料年月,公司代號,營業收入-當月營收\n11507,2330,320000000\n11507,合計,1\n"
    lines = DL.preamble_rows(body(spark, text), "body", "資料年月")
    got = lines.select(roc_month(DL.cell("header", "cells", lambda h: h.contains("資料年月"))).alias("m"),
                       DL.cell("header", "cells", lambda h: h.contains("公司代號")).alias("c"),
                       parse_number(DL.cell("header", "cells", lambda h: h.contains("當月營收"))).alias("v"))
    assert rows(got.where(F.col("c").rlike(r"^\d{4,6}$")), "m", "c", "v") == [("2026-07", "2330", 320000000.0)]


def test_payload_files_carry_their_key(spark, tmp_path):
    (tmp_path / "ecb_2026-09-05_2026-09-15.txt").write_text("x")
    got = PL.read_payloads(spark, str(tmp_path)).select("body", PL.key_from_name(r"^([a-z]+)_").alias("k")).first()
    assert tuple(got) == ("x", "ecb")


# --- JSON -----------------------------------------------------------------------------

def test_records_and_envelopes(spark):
    got = J.json_records(body(spark, '[{"a": "1", "b": 2}, {"a": null}]'), "body", ["a", "b"])
    assert sorted(got.select("position", "a", "b").collect()) == [(0, "1", "2"), (1, None, None)]
    with pytest.raises(Exception, match="unexpected response shape"):
        J.json_records(body(spark, '{"error": true}'), "body", ["a"]).collect()
    ok = '{"status": "000", "message": "", "list": [{"n": "1"}]}'
    none = '{"status": "013", "message": "no data"}'
    assert rows(J.status_records(body(spark, ok, none), "body", "list", ["n"]), "n") == [("1",)]
    with pytest.raises(Exception, match="error status"):
        J.status_records(body(spark, '{"status": "020", "message": "limit"}'), "body", "list", ["n"]).collect()


def test_header_rows_keep_every_field(spark):
    table = [["CTY_CODE", "GEN_VAL_MO", "SUMMARY_LVL", "GEN_QY1_MO"], ["5880", "1500", "DET", "3"], ["-", "2000", "DET", "0"],
             ["1220", "0", "DET", "0"], ["", "9", "DET", "1"], ["2010", "0", "DET", "4"]]
    got = J.trade_records(J.header_rows(body(spark, json.dumps(table), "[]", "[[\"A\"]]"), "body"), "CTY_CODE",
                          ["GEN_VAL_MO", "ALL_VAL_MO"], ["GEN_QY1_MO"])
    assert rows(got, "cty_code", "value", "qty1") == [("-", 2000.0, 0.0), ("2010", 0.0, 4.0), ("5880", 1500.0, 3.0)]
    extra = json.loads(got.where("cty_code = '5880'").first()["extra_json"])
    assert list(extra) == sorted(table[0]) and extra["SUMMARY_LVL"] == "DET"


def test_parallel_arrays_in_local_days(spark):
    chart = {"chart": {"result": [{"meta": {"gmtoffset": -14400}, "timestamp": [1136212200, 1136298600, 1136300000],
                                   "indicators": {"quote": [{"close": [1.00004, None, 3.0]}], "adjclose": [{"adjclose": [0.9, 1.0, None]}]}}]}}
    plain = json.loads(json.dumps(chart))
    del plain["chart"]["result"][0]["indicators"]["adjclose"]
    got = J.parallel_arrays(body(spark, json.dumps(chart), json.dumps(plain), "{}"), "body", ["id"])
    assert rows(got, "id", "date", "close", "adj_close") == [
        (0, dt.date(2006, 1, 2), 1.0, 0.9), (1, dt.date(2006, 1, 2), 1.0, 1.0), (1, dt.date(2006, 1, 3), 3.0, 3.0)]


def test_date_map(spark):
    text = '{"rates": {"2026-09-10": {"JPY": 147.5, "CHF": 0.9, "krw": 1390}, "2026-09-11": {"JPY": -1, "KRW": "x"}}}'
    assert rows(J.date_map(body(spark, text, "[]"), "body", ["JPY", "KRW"]), "date", "quote", "rate") == [
        ("2026-09-10", "JPY", 147.5), ("2026-09-10", "KRW", 1390.0)]


# --- XML ----------------------------------------------------------------------------------

XML = ("<response><header><resultCode>{}</resultCode><resultMsg>{}</resultMsg></header><body><items>"
       "<item><year>2026.06</year><expDlr> 12 </expDlr></item><item><year>총계</year><expDlr>99</expDlr></item>"
       "<item><year></year></item></items></body></response>")


def test_xml_items_totals_and_errors(spark):
    got = XM.xml_rows(body(spark, XML.format("00", "NORMAL")), "body", ["body", "items", "item"], ["year", "expDlr"])
    assert rows(got, "year", "expDlr") == [("2026.06", "12"), ("총계", "99")]
    assert rows(XM.drop_totals(got, "year"), "year") == [("2026.06",)]
    with pytest.raises(Exception, match="NOT REGISTERED"):
        XM.xml_rows(body(spark, XML.format("30", "KEY NOT REGISTERED")), "body", ["body", "items", "item"], ["year"]).collect()


def test_xml_folder(spark, tmp_path):
    (tmp_path / "p.xml").write_text("<r><info><area>Asia</area><v>5</v></info><info><area>EU</area></info></r>")
    assert rows(XM.read_xml_rows(spark, str(tmp_path), "info", "area string, v int"), "area") == [("Asia",), ("EU",)]


def test_feed_items(spark):
    feed = ("<rss><channel><title>t</title><item><title>Funds sell - Reuters</title><link>u</link>"
            "<pubDate>Mon, 21 Sep 2026 03:30:00 GMT</pubDate><source url='x'>Reuters</source></item>"
            "<item><title></title></item></channel></rss>").replace("<source url='x'>", "<source>")
    got = XM.feed_items(body(spark, feed), "body")
    assert rows(got, "title", "outlet", "published") == [("Funds sell", "Reuters", dt.date(2026, 9, 20))]


# --- Fields and pages -----------------------------------------------------------------------

def test_fields_by_candidate_name(spark):
    df = spark.createDataFrame([(" ", "x", "1")], "a string, b string, long_name string")
    r = df.select(FD.first_present_field(df, ["a", "zzz", "b"]).alias("f"), FD.first_present_field(df, ["zzz"]).alias("none"),
                  FD.extra_json(df).alias("e")).first()
    assert (r["f"], r["none"], list(json.loads(r["e"]))) == ("x", "", ["a", "b", "long_name"])
    assert FD.match_column(df, ["name"]) == "long_name" and FD.match_column(df, ["q"]) is None


def test_table_rows_carry_their_section(spark):
    page = ("<table><tr><td>產業別：半導體業</td></tr></table><table><tr><th>代號</th></tr>"
            "<tr><td>2330</td><td> 280,000 </td></tr></table><TABLE><tr><td>產業別：電機機械</td></tr><tr><td>2049</td></tr></TABLE>")
    got = PG.html_table_rows(body(spark, page), "body", ["id"])
    kept = {r["cells"][0]: r["section"] for r in got.collect() if r["cells"][0].isdigit()}
    assert kept == {"2330": "半導體業", "2049": "電機機械"}


def test_links_by_page(spark):
    page = ('<td>3 Aug 2026</td><td>4 Aug 2026</td><a href="/n/11">Own <b>Shares</b></a><a href="/n/12">Next</a><a href="/n/11">Again</a>')
    df = spark.createDataFrame([(1, page)], "page int, html string")
    got = PG.html_links_with_context(df, "html", ["page"], r'<a href="/n/(\d+)">(.*?)</a>', 1, 2, r"\d{1,2} [A-Z][a-z]{2} \d{4}")
    assert rows(got, "id", "text", "context") == [("11", "Own Shares", "4 Aug 2026"), ("12", "Next", "4 Aug 2026")]
    near = PG.html_links_with_context(df, "html", ["page"], r'<a href="/n/(\d+)">(.*?)</a>', 1, 2, r"\d{1,2} [A-Z][a-z]{2} \d{4}", reach=100)
    assert rows(near, "id", "context") == [("11", "4 Aug 2026"), ("12", "")]


def test_own_share_notice(spark):
    text = ("<p>Date of purchase: 4 August 2026</p><p>Number of ordinary shares purchased:&nbsp;1,234,567</p>"
            "<p>Highest price paid per share: GBp 501.5</p><p>Average price paid per share: 500.25</p> pursuant to its 2026 programme")
    r = PG.text_field_extract(body(spark, text), F.col("body"), PG.OWN_SHARE_PATTERNS, ["id"]).first()
    assert (r["trade_date"], r["shares"], r["high_pence"], r["avg_price_gbp_pence"], r["low_pence"], r["programme"]) == (
        "4 August 2026", "1234567", "501.5", "500.25", "", "2026 programme")


# --- Layouts -----------------------------------------------------------------------------------

def test_groups_lacking_a_leg_are_skipped(spark):
    df = spark.createDataFrame([("w", "1,000", "400", "5", "7", None)], "week string, noncomm_positions_long_all string, "
                               "noncomm_positions_short_all string, noncomm_postions_spread_all string, "
                               "comm_positions_long_all string, comm_positions_short_all string")
    got = R.wide_to_long_groups(df, ["week"], R.report_groups("legacy_fut"))
    assert rows(got, "trader_group", "net", "spread") == [("noncommercial", 600.0, 5.0)]


def test_unpublished_months_are_dropped(spark):
    df = spark.createDataFrame([("848610000", "2026", "10", "2", "0", "0", "")], "hs string, Year string, `Value-Jan` string, "
                               "`Quantity1-Jan` string, `Value-Feb` string, `Quantity1-Feb` string, `Value-Mar` string")
    got = R.wide_months_to_long(df, ["hs"], "Year")
    assert rows(got, "yyyymm", "value", "quantity1") == [("2026-01", 10.0, 2.0)]


def test_paired_columns(spark):
    df = spark.createDataFrame([(1, ["2026/07", "900", "5", "600", "-", "0"])], "id int, c array<string>")
    words = lambda *w: F.array(*[F.lit(x) for x in w])
    got = R.paired_columns_to_long(df, ["id"], F.col("c"), words("", "Total", "Chips", "", "Cars", ""),
                                   words("", "金額", "数量", "金額", "数量", "金額"))
    assert sorted((r["name"], r["value"], r["quantity"]) for r in got.collect()) == [("Chips", 600.0, 5.0), ("Total", 900.0, None)]


def test_windows_and_totals(spark):
    df = spark.createDataFrame([("", "202608", "2026", "1,000", "0"), ("202608", "x", "Chips", "400", ""), ("bad", "", "y", "1", "1")],
                               "uprId string, lwprId string, curTitle string, a1 string, a2 string")
    got = R.windows_to_long(df, [], {"a1": "D10", "a2": "D20"}, "uprId", "lwprId", "curTitle")
    assert rows(got, "yyyymm", "name", "window", "value") == [("2026-08", "Chips", "D10", 400.0), ("2026-08", "TOTAL", "D10", 1000.0)]


def test_gaps_need_both_legs(spark):
    df = spark.createDataFrame([(1.0, 3.0, 4.0), (None, 3.0, None)], "y3m double, y2y double, y10y double")
    assert [(r["gap_2s10s"], r["gap_3m10y"]) for r in R.spread_columns(df).collect()] == [(1.0, 3.0), (None, None)]
    empty = spark.createDataFrame([(0.0, None), (0.0, 2.0), (5.0, None), (None, 1.0)], "v double, q double")
    assert R.drop_empty_measures(empty, "v", "q").count() == 2
