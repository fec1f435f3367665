import datetime as dt

from pyspark.sql import functions as F

from firstprint.functions.fixed_values import EASTER_SUNDAYS
from firstprint.operators import calendar as C, filings as FL, news as N

BANDS = [(0.5, "quiet"), (1.5, "normal"), (2.5, "loud"), (None, "very loud")]


def test_one_story_in_two_searches_and_a_silent_week(spark):
    rows = [("s1", "a", dt.date(2026, 9, 7)), ("s1", "b", dt.date(2026, 9, 8)), ("s2", "a", dt.date(2026, 9, 21)), ("s3", "a", None)]
    df = spark.createDataFrame(rows, "story string, query string, day date")
    got = N.weekly_distinct_counts(df, "day", "query", "story", ["a", "b"], dt.date(2026, 10, 1)).orderBy("week_ending").collect()
    assert [(r["total"], r["a"], r["b"]) for r in got] == [(1, 1, 1), (0, 0, 0), (1, 1, 0), (0, 0, 0)]
    assert N.weekly_distinct_counts(df.where("day is null"), "day", "query", "story", ["a"]).count() == 0


def test_loudness(spark):
    def last(counts):
        rows = [("t", dt.date(2026, 1, 4) + dt.timedelta(days=7 * i), n) for i, n in enumerate(counts)]
        df = spark.createDataFrame(rows, "k string, w date, n int")
        return N.loudness_band(df, ["k"], "w", "n", BANDS).orderBy(F.desc("w")).first()
    r = last([4] * 12 + [12])
    assert (r["ratio"], r["label"]) == (3.0, "very loud")
    assert last([4, 4, 4, 5])["label"] == "building a baseline"
    assert (last([0] * 5 + [0])["label"], last([0] * 5 + [2])["label"]) == ("about normal", "very loud")
    assert last([100] * 3 + [4] * 12 + [4])["baseline"] == 4.0


def test_notable_order(spark):
    rows = [("s1", dt.date(2026, 9, 1), "", "", 1), ("s2", dt.date(2026, 9, 2), "", "gs", 2), ("s3", dt.date(2026, 9, 1), "yes", "", 3),
            ("s4", dt.date(2026, 9, 3), "", "", 4), ("s1", dt.date(2026, 9, 9), "yes", "gs", 5), ("old", dt.date(2026, 8, 1), "yes", "", 6)]
    df = spark.createDataFrame(rows, "story string, day date, extreme string, banks string, n int")
    got = N.notable(df, "day", "story", dt.date(2026, 9, 1), "extreme", "banks", "n", []).collect()
    assert [r["story"] for r in got] == ["s3", "s2", "s4", "s1"]


def test_entities_match_whole_words_only(spark):
    titles = ["Shift4 Payments soars", "FOUR seasons", "shift4paymentsx", "AT&T beats", "トヨタ自動車が増益", "Hon Hai, again"]
    news = spark.createDataFrame(list(enumerate(titles)), "story int, title string")
    ents = spark.createDataFrame([("f", "Shift4 Payments", ["Shift 4"], "FOUR"), ("t", "AT&T", None, "T"), ("y", "トヨタ", [], None),
                                  ("h", "Hon Hai", [], "HH")], "e string, name string, aliases array<string>, symbol string")
    phrases = N.entity_phrases(ents, "e", "name", "aliases", "symbol")
    got = N.phrase_entity_match(news, "story", "title", phrases, "e", "phrase")
    assert sorted(map(tuple, got.collect())) == [(0, "f"), (1, "f"), (3, "t"), (4, "y"), (5, "h")]


def test_names_by_automaton_and_by_join_agree(spark):
    texts = ["Hon Hai, hon  hai; HON HAI", None, "", "x" * 50_000 + " AT&T " + "y" * 50_000, "ⅷ AT&T's (AT&T)", "atatata", "a ta", "İsAT&T İ ta"]
    news = spark.createDataFrame([(i % 7, t, "x") for i, t in enumerate(texts)], "story int, title string, phrase string")
    ents = spark.createDataFrame([("h", "Hon Hai"), ("h", "hon hai"), ("t", "AT&T"), ("u", "at&t"), (None, "AT&T"), ("v", None), ("w", ""),
                                  ("w", "  "), ("x", "ta"), ("y", "atata"), ("z", "a.")], "e string, phrase string")
    way = lambda **bounds: sorted(map(tuple, N.phrase_entity_match(news, "story", "title", ents, "e", "phrase", **bounds).collect()))
    assert way() == way(most_rows=3) == way(most_bytes=20)
    assert way() == [(0, "h"), (0, "x"), (3, "t"), (3, "u"), (4, "t"), (4, "u"), (6, "x")]
    assert N.phrase_entity_match(news, "story", "title", ents.limit(0), "e", "phrase").count() == 0


def test_watched_filer_or_subject(spark):
    docs = spark.createDataFrame([("d1", "7220", "", ""), ("d2", "9999", "E1", "E02"), ("d3", "1", "", None)],
                                 "doc string, sec string, filer string, subject string")
    watch = spark.createDataFrame([("7220", "Musashi", "E01"), ("6501", "Hitachi", "E02"), ("5016", "JX", "")],
                                  "code string, name string, entity_id string")
    got = FL.entity_any_id(docs, "doc", "sec", ["filer", "subject"], watch)
    assert sorted((r["doc"], r["entity_name"]) for r in got.collect()) == [("d1", "Musashi"), ("d2", "Hitachi")]


def test_freshness_and_pace(spark):
    df = spark.createDataFrame([("2026-09-20",), ("20260901",), ("?",)], "t string")
    assert [r["f"] for r in df.select(FL.freshness("t", F.lit(dt.date(2026, 9, 25))).alias("f")).collect()] == ["news", "history", "news"]
    trades = spark.createDataFrame([("c", dt.date(2026, 9, d), 100.0 * d, 50.0) for d in range(1, 8)], "c string, d date, s double, p double")
    r = FL.last_n_vwap(trades, ["c"], "d", "s", "p", F.lit(dt.date(2026, 9, 11))).first()
    assert (r["days"], r["shares"], r["spend"], r["avg_pence"], r["gap_days"], r["watch"]) == (5, 2500.0, 1250.0, 50.0, 4, True)


# --- Calendar -------------------------------------------------------------------------------

def cal(spark, first=dt.date(2025, 1, 1), last=dt.date(2028, 12, 31)):
    return C.trading_calendar(spark, first, last)


def test_holidays_of_2026(spark):
    r = spark.range(1).select(F.array_sort(C.holidays_of(F.lit(2026))).alias("h")).first()["h"]
    assert [d.isoformat()[5:] for d in r] == ["01-01", "01-19", "02-16", "04-03", "05-25", "06-19", "07-03", "09-07", "11-26", "12-25"]
    saturday = spark.range(1).select(C.holidays_of(F.lit(2028)).alias("h")).first()["h"]
    assert all((d.month, d.day) not in ((1, 1), (12, 31)) for d in saturday)  # 1 January 2028 is a Saturday


def test_easter_equals_the_published_dates(spark):
    got = spark.range(1990, 2031).select(C.easter(F.col("id").cast("int")).alias("d")).orderBy("d").collect()
    assert [r["d"].isoformat() for r in got] == EASTER_SUNDAYS


def test_trading_days(spark):
    days = cal(spark).where("day between '2026-09-24' and '2026-09-30'").collect()
    assert min(r["day"] for r in days if r["is_trading"] and r["from_month_end"] <= 5) == dt.date(2026, 9, 24)
    ask = spark.createDataFrame([(dt.date(2026, 7, 2),)], "d date")
    assert C.add_trading_days(ask, "d", cal(spark), 1, "n").first()["n"] == dt.date(2026, 7, 6)  # over a holiday and a weekend


def test_event_calendar(spark):
    got = {(r["kind"], r["start"]) for r in C.event_calendar(cal(spark), dt.date(2026, 9, 1), 120).collect()}
    assert {("13f", dt.date(2026, 11, 16)), ("expiry", dt.date(2026, 12, 18)), ("rebalance_quarter", dt.date(2026, 9, 24)),
            ("trend_monitor", dt.date(2026, 11, 19))} <= got
    listed = C.event_calendar(cal(spark), dt.date(2026, 9, 1), 60, published=[dt.date(2026, 9, 9)], rate_decisions=[dt.date(2026, 9, 16)])
    kinds = sorted((r["kind"], r["start"].isoformat()) for r in listed.collect() if r["kind"] in ("short_interest", "rate_decision"))
    assert kinds == [("rate_decision", "2026-09-16"), ("short_interest", "2026-09-09")]
