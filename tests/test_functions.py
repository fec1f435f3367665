import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from firstprint.functions import numbers as N, periods as P, text as X


@pytest.mark.parametrize("text,expected", [
    ("1,234,567", 1234567.0), ("(5.2)", -5.2), ("不適用", None), ("-", None), ("--", None), ("", None), ("N/A", None),
    ("△3", -3.0), ("▲1,000", -1000.0), ("12.5%", 12.5), (" 7 ", 7.0), ("1d", None), ("NaN", None), ("null", None),
    ("1e3", 1000.0), (".5", 0.5), ("(△5)", None)])
def test_parse_number(values, text, expected):
    assert values({"t": text}, v=N.parse_number("t"))["v"] == expected


def test_parse_number_null(values):
    assert values({"t": None}, v=N.parse_number("t"))["v"] is None


@pytest.mark.parametrize("value,expected", [("5", "5"), ("5.0", "5"), ("5.25", "5.25"), (None, ""), ("-3", "-3")])
def test_fmt_number(values, value, expected):
    assert values({"v": value}, t=N.fmt_number(F.col("v").cast("double")))["t"] == expected


def test_minguo_months(values):
    for text in ("115/07", "11507"):
        assert values({"t": text}, m=P.roc_month("t"))["m"] == "2026-07"
    assert values({"t": "1"}, m=P.roc_month("t"))["m"] is None
    assert values({"t": "2026-07"}, m=P.to_roc_month("t"))["m"] == "115/07"


def test_month_range_is_inclusive(values):
    row = values({"a": "2025-11-01", "b": "2026-02-01"}, m=P.month_range(F.col("a").cast("date"), F.col("b").cast("date")),
                 none=P.month_range(F.col("b").cast("date"), F.col("a").cast("date")))
    assert [d.strftime("%Y-%m") for d in row["m"]] == ["2025-11", "2025-12", "2026-01", "2026-02"]
    assert row["none"] == []


@pytest.mark.parametrize("label,window", [
    ("2026.08.01 ~ 2026.08.10", "D10"), ("1일~20일", "D20"), ("2026.08.01 ~ 2026.08.31", "FULL"),
    ("2026.02.01 ~ 2026.02.28", "FULL"), ("no range", ""), ("1 ~ 15", "")])
def test_classify_window(values, label, window):
    assert values({"t": label}, w=P.classify_window("t"))["w"] == window


@pytest.mark.parametrize("label,read,expected", [
    ("Aug.1~Aug.10", "2026-08-15", ("2026-08", "D10")), ("Jun.1~Jun.30", "2026-07-01", ("2026-06", "FULL")),
    ("Dec.1~Dec.31", "2027-01-02", ("2026-12", "FULL")), ("nonsense", "2026-08-15", ("", ""))])
def test_english_window(values, label, read, expected):
    row = values({"t": label, "d": read}, w=P.english_window("t", F.col("d").cast("date")))["w"]
    assert (row["month"], row["window"]) == expected


def test_find_month_looks_at_the_label_first(values):
    row = values({"a": "flash", "b": "as of 20260810", "c": "2025-01"}, m=P.find_month("a", "b", "c"), none=P.find_month("a"))
    assert row["m"] == "2026-08" and row["none"] == ""


def test_stage_spans(values):
    title = "2026年7月分 統計品別表 (輸入 1-6月：確報、7月：輸入9桁速報)"
    spans = values({"t": title}, s=P.stage_spans("t"))["s"]
    assert {s["month"]: s["stage"] for s in spans} == {**{m: "DETAILED" for m in range(1, 7)}, 7: "PROV9"}
    again = values({"t": "(1-3月：速報、2月：確定)"}, s=P.stage_spans("t"))["s"]
    assert {s["month"]: s["stage"] for s in again} == {1: "PROV9", 2: "FIXED", 3: "PROV9"}


def test_stage_spans_read_a_title_once(spark):
    """A title drawn anew at every reading agrees with itself only if it is read once, not again for each of its months."""
    drawn = F.concat((F.floor(F.rand(3) * 11) + 1).cast("string"), F.lit("月：確報、12月：速報"))
    got = [r["s"] for r in spark.range(40).select(P.stage_spans(drawn).alias("s")).collect()]
    assert len({tuple(s["month"] for s in spans) for spans in got}) > 3
    assert all([s["stage"] for s in spans] == ["DETAILED", "PROV9"] and spans[1]["month"] == 12 for spans in got)


def test_stage_spans_that_overlap(spark):
    """Against a plain reading: each month once, with its last stage, where its last span puts it."""
    words = {"速報": "PROV9", "確報": "DETAILED", "確々報": "REVISED", "確定": "FIXED", "未定": ""}
    rng = random.Random(5)
    titles, expected = [], []
    for _ in range(60):
        spans = [(rng.randint(0, 13), rng.randint(0, 13), rng.choice(list(words))) for _ in range(rng.randint(0, 6))]
        titles.append("統計 (輸入 " + "、".join(f"{a}{rng.choice('-～')}{b}月：{word}" for a, b, word in spans) + ")")
        held = {}
        for a, b, word in spans:
            for month in range(a, b + 1) if words[word] else ():
                held.pop(month, None)
                held[month] = words[word]
        expected.append(list(held.items()))
    rows = spark.createDataFrame(list(enumerate(titles)), "i int, t string").select("i", P.stage_spans("t").alias("s")).collect()
    assert [[tuple(s) for s in r["s"]] for r in sorted(rows)] == expected


@pytest.mark.parametrize("text,expected", [
    ("46235", dt.date(2026, 8, 1)), ("18-Nov-2004", dt.date(2004, 11, 18)), ("18-NOV-04", dt.date(2004, 11, 18)),
    ("1-Jan-99", dt.date(1999, 1, 1)), ("2026-08-04", dt.date(2026, 8, 4)), ("08/04/2026", dt.date(2026, 8, 4)),
    ("25/12/2026", dt.date(2026, 12, 25)), ("HOLIDAY", None), ("2026-13-40", None)])
def test_parse_any_date(values, text, expected):
    assert values({"t": text}, d=P.parse_any_date("t"))["d"] == expected


@pytest.mark.parametrize("text,expected", [
    ("2026-08-04 15:00", dt.date(2026, 8, 4)), ("20260804", dt.date(2026, 8, 4)), ("4 Aug 2026, 7:00 AM", dt.date(2026, 8, 4)),
    ("soon", None), (None, None)])
def test_document_date(values, text, expected):
    assert values({"t": text}, d=P.document_date("t"))["d"] == expected


def test_mail_time_becomes_the_local_day(values):
    row = values({"t": "Mon, 21 Sep 2026 03:30:00 GMT"}, d=P.local_date(P.rfc822_timestamp("t")))
    assert row["d"] == dt.date(2026, 9, 20)


def test_week_labels_put_the_weekend_in_the_next_friday(values):
    row = values({"d": "2020-01-11"}, f=P.friday_label(F.col("d").cast("date")), e=P.week_ending_sunday(F.col("d").cast("date")),
                 s=P.week_start_sunday(F.col("d").cast("date")))
    assert (row["f"], row["e"], row["s"]) == (dt.date(2020, 1, 17), dt.date(2020, 1, 12), dt.date(2020, 1, 5))


def test_business_days_match_a_count(spark):
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(20)]
    pairs = [(a, b) for a in days for b in days]
    got = spark.createDataFrame(pairs, "a date, b date").select("a", "b", P.business_days_between("a", "b").alias("n")).collect()
    for a, b, n in got:
        assert n == sum(1 for i in range(1, (b - a).days + 1) if (a + dt.timedelta(days=i)).weekday() < 5)


def test_story_key_ignores_punctuation(values):
    row = values({"a": "Hedge funds SELL, again!", "b": "hedge funds sell again"}, a=X.story_key("a"), b=X.story_key("b"))
    assert row["a"] == row["b"] and len(row["a"]) == 16


@pytest.mark.parametrize("title,source,expected", [
    ("A - B - Reuters", "Reuters", ("A - B", "Reuters")), ("A - B - Reuters", "", ("A - B", "Reuters")),
    ("A - Reuters", "FT", ("A - Reuters", "FT")), ("Plain", "", ("Plain", ""))])
def test_split_suffix(values, title, source, expected):
    row = values({"t": title, "s": source}, r=X.split_suffix("t", F.col("s")))["r"]
    assert tuple(row) == expected


def test_whole_words_and_direction(values):
    tags = {"bank": {"gs": ["Goldman"], "ms": ["AT&T (x)"]}, "direction": {"buy": ["buying"], "sell": ["selling"]},
            "topic": {"crowd": ["crowded"]}, "extreme": ["record"]}
    row = values({"t": "GOLDMAN: record buying", "u": "Goldmans recorded buying and selling", "v": "x AT&T (x) y"},
                 t=X.headline_tags("t", tags), u=X.headline_tags("u", tags), v=X.headline_tags("v", tags))
    assert tuple(row["t"]) == ("gs", "buy", "", "yes")
    assert tuple(row["u"]) == ("", "mixed", "", "")
    assert row["v"]["banks"] == "ms"


def test_relevance(values):
    row = values({"t": "Prime brokerage flows", "o": "Blog", "p": "FT"},
                 a=X.is_relevant("t", "p", ["prime brokerage"], ["Blog"]), b=X.is_relevant("t", "o", ["prime brokerage"], ["Blog"]),
                 c=X.is_relevant("t", "p", ["broker"], []))
    assert (row["a"], row["b"], row["c"]) == (True, False, False)


def test_topics_keep_cjk_case_and_fold_ascii(values):
    topics = {"results": ["決算短信", "Results"], "buyback": ["自己株式"]}
    row = values({"t": "interim RESULTS", "u": "自己株式の取得"}, t=X.topic_tags("t", topics), u=X.topic_tags("u", topics),
                 n=X.needs_reading(X.topic_tags("t", topics), F.array(F.lit("results"))))
    assert (row["t"], row["u"], row["n"]) == (["results"], ["buyback"], "yes")


def test_gloss_takes_the_most_specific_pattern(values):
    row = values({"a": "2026年 四半期決算短信", "b": "決算短信", "c": "Results"}, a=X.ordered_gloss("a"), b=X.ordered_gloss("b"),
                 c=X.ordered_gloss("c"))
    assert row["a"].startswith("quarterly earnings release (") and row["b"].startswith("earnings release (")
    assert row["c"] == "Results"


def test_markup_and_links(values):
    row = values({"h": "<p>A&amp;B &nbsp; <b>C</b>\n&lt;x&gt;</p>", "u": "https://a/rd.php?https://b/c.pdf", "c": "8517620090"},
                 t=X.clean_text("h"), u=X.unwrap_redirect("u"), d=X.dotted_code("c"))
    assert (row["t"], row["u"], row["d"]) == ("A&B C <x>", "https://b/c.pdf", "8517.62.00.90")
