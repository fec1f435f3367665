import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from firstprint.functions.periods import week_ending_sunday
from firstprint.operators import asof, diff as D, flows as P, fx, growth as G, ranks, series as S, releases
from firstprint.operators.quantiles import exact_median

D0 = dt.date(2015, 1, 6)


def weekly(spark, nets, oi=1000.0, gaps=None, name="s"):
    dates, day = [], D0
    for i in range(len(nets)):
        dates.append(day)
        day += dt.timedelta(days=gaps[i] if gaps and i < len(gaps) else 7)
    rows = [(name, d, None if n is None else float(n), oi) for d, n in zip(dates, nets)]
    return spark.createDataFrame(rows, "series string, report_date date, net double, open_interest double")


def column(df, name, order="report_date"):
    return [r[name] for r in df.orderBy(order).select(name).collect()]


# --- Growth -------------------------------------------------------------------------

def test_year_ago_growth_needs_the_same_key_and_a_base(spark):
    rows = [("D10", dt.date(2025, 8, 1), 10e6), ("D10", dt.date(2026, 8, 1), 11e6), ("D20", dt.date(2026, 8, 1), 5.0),
            ("Z", dt.date(2025, 1, 1), 0.0), ("Z", dt.date(2026, 1, 1), 4.0)]
    got = {(r["w"], r["period"]): r["yoy_pct"] for r in
           G.yoy_self_join(spark.createDataFrame(rows, "w string, period date, value double"), ["w"]).collect()}
    assert got[("D10", dt.date(2026, 8, 1))] == pytest.approx(10.0)
    assert got[("D20", dt.date(2026, 8, 1))] is None and got[("Z", dt.date(2026, 1, 1))] is None


def test_group_growth_and_breadth(spark):
    rows = [("m", 2.1, 2.1), ("m", 2.5, 2.0), ("m", 9.9, 0.0), ("m", 9.9, None)]
    r = G.group_growth_breadth(spark.createDataFrame(rows, "month string, now double, ago double"), ["month"], "now", "ago").first()
    assert (r["n_members"], r["breadth_pct"]) == (2, 50.0)
    assert r["agg_yoy_pct"] == pytest.approx((4.6 / 4.1 - 1) * 100) and r["median_yoy_pct"] == pytest.approx(12.5)


@pytest.mark.parametrize("kind", ["distinct", "ties", "one value", "small"])
def test_exact_median_equals_brute_force(spark, kind):
    rng = random.Random(7)
    groups = {"distinct": [rng.random() for _ in range(30001)], "one value": [3.0] * 5000,
              "ties": [0.0] * 10000 + [rng.random() - 0.5 for _ in range(20000)], "small": [4.0, 1.0, 3.0, 2.0]}
    v = groups[kind]
    r = exact_median(spark.createDataFrame([("g", x) for x in v], "g string, v double"), ["g"], "v", accuracy=500).first()
    assert r["n"] == len(v) and r["median"] == statistics.median(v)


def test_stage_pick_ties_and_unknown_stages(spark):
    rows = [("k", "DETAILED", 1, 9.5), ("k", "PROV9", 2, 9.4), ("t", "PROV9", 1, 1.0), ("t", "PROV9", 2, 2.0), ("f", "FIXED", 1, 7.0),
            ("f", "PROV9", 2, 8.0)]
    df = spark.createDataFrame(rows, "k string, stage string, arrival int, value double")
    two = {"PROV9": 1, "DETAILED": 2}
    last = {r["k"]: r["value"] for r in G.stage_priority_pick(df, ["k"], "stage", two, ["value"]).collect()}
    first = {r["k"]: r["value"] for r in G.stage_priority_pick(df, ["k"], "stage", two, ["value"], ties="first").collect()}
    from firstprint.functions.fixed_values import STAGE_RANKS
    full = {r["k"]: r["value"] for r in G.stage_priority_pick(df, ["k"], "stage", STAGE_RANKS, ["value"]).collect()}
    assert (last["k"], last["t"], first["t"]) == (9.5, 2.0, 1.0)
    assert last["f"] == 8.0 and full["f"] == 7.0  # with two ranks a fixed row is unranked


def test_detail_level_and_share(spark):
    rows = [("DET", "JP", 300.0), ("CGP", "EU", 500.0), (None, "XX", 10.0)]
    df = spark.createDataFrame(rows, "level string, origin string, value double").withColumn("code", F.lit("c"))
    assert {r["origin"] for r in G.detail_level(df, "level").collect()} == {"JP", "XX"}
    assert G.detail_level(df.where("level = 'CGP'"), "level").count() == 1
    totals = spark.createDataFrame([("c", 900.0)], "code string, total double")
    got = {r["origin"]: r["share_pct"] for r in G.share_of_total(df, totals, ["code"], "value", "total").collect()}
    assert got["JP"] == pytest.approx(100 / 3)


def test_prefixes_may_overlap(spark):
    df = spark.createDataFrame([("848610",), ("854141",), ("99",)], "code string")
    got = sorted((r["code"], r["prefix"]) for r in G.prefix_assign(df, "code", ["8486", "84", "854141"]).collect())
    assert got == [("848610", "84"), ("848610", "8486"), ("854141", "854141")]


def test_latest_and_previous_order_windows(spark):
    rows = [("x", dt.date(2026, 7, 1), "MONTH", 1.0), ("x", dt.date(2026, 8, 1), "D10", 2.0), ("x", dt.date(2026, 8, 1), "D20", 3.0)]
    r = G.latest_and_previous(spark.createDataFrame(rows, "item string, period date, window string, value double"), ["item"],
                              "period", "window", ["value"]).first()
    assert (r["window"], r["value"], r["prev_window"], r["prev_value"]) == ("D20", 3.0, "D10", 2.0)


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = G.top_n_per_group(df, ["k"], [F.desc("v")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# --- Ranks and flows ---------------------------------------------------------------------

def brute_rank(values, i, least):
    past = [v for v in values[:i] if v is not None]
    if values[i] is None or len(past) < least:
        return None
    return 100.0 * sum(1 for v in past if v < values[i]) / len(past)


def test_expanding_rank_equals_brute_force(spark):
    rng = random.Random(3)
    values = [None if rng.random() < 0.1 else float(rng.randint(0, 40)) for _ in range(700)]
    got = column(ranks.expanding_rank(weekly(spark, values), ["series"], "report_date", "net", "r", 52), "r")
    assert got == [pytest.approx(v) if v is not None else None for v in (brute_rank(values, i, 52) for i in range(len(values)))]


def test_expanding_rank_of_many_series_with_ties_and_gaps(spark):
    rng = random.Random(9)
    lengths = {None: 40, "a": 1, "b": 257, "c": 64, "d": 3}
    values = {k: [None if rng.random() < 0.2 else float(rng.randint(-3, 3)) for _ in range(n)] for k, n in lengths.items()}
    values["d"] = [None] * 3
    rows = [(k, i, v, f"x{i}") for k, vs in values.items() for i, v in enumerate(vs)]
    rng.shuffle(rows)
    got = ranks.expanding_rank(spark.createDataFrame(rows, "series string, d int, net double, rest string"), ["series"], "d", "net", "r", 2)
    assert got.columns == ["series", "d", "net", "rest", "r"]
    for r in got.collect():
        assert r["r"] == pytest.approx(brute_rank(values[r["series"]], r["d"], 2)) and r["rest"] == f"x{r['d']}"
    none = spark.createDataFrame([], "series string, d int, net double")
    assert ranks.expanding_rank(none, ["series"], "d", "net", "r", 1).count() == 0


def test_expanding_rank_never_looks_ahead(spark):
    rng = random.Random(4)
    values = [rng.random() for _ in range(300)]
    whole = column(ranks.expanding_rank(weekly(spark, values), ["series"], "report_date", "net", "r", 52), "r")
    part = column(ranks.expanding_rank(weekly(spark, values[:200]), ["series"], "report_date", "net", "r", 52), "r")
    assert whole[:200] == part


def test_a_series_of_any_length_is_ranked(spark):
    values = [float((i * 7919) % 1009) for i in range(5000)]
    rows = [("a", i, v) for i, v in enumerate(values)]
    got = ranks.expanding_rank(spark.createDataFrame(rows, "series string, d int, net double"), ["series"], "d", "net", "r", 1)
    got = {r["d"]: r["r"] for r in got.collect()}
    for i in (1, 511, 512, 4095, 4096, 4999):
        assert got[i] == pytest.approx(100.0 * sum(v < values[i] for v in values[:i]) / i)


def test_rolling_rank_counts_valid_rows_only(spark):
    values = [float(i % 7) for i in range(60)]
    df = weekly(spark, values).withColumn("open_interest", F.when(F.col("net") == 3, 0.0).otherwise(F.col("open_interest")))
    got = column(ranks.rolling_rank(df, ["series"], "report_date", "net", "r", 10, 5, valid=F.col("open_interest") != 0), "r")
    past, want = [], []
    for v in values:
        if v == 3:
            want.append(None)
            continue
        w = past[-10:]
        want.append(100.0 * sum(x < v for x in w) / len(w) if len(w) >= 5 else None)
        past.append(v)
    assert got == want


def test_gap_guard(spark):
    nets = column(P.gap_guarded_delta(weekly(spark, [400, 500, 450]), ["series"], "report_date", "net", "c"), "c")
    assert nets == [None, 100.0, -50.0]
    far = column(P.gap_guarded_delta(weekly(spark, [10, 20], gaps=[14]), ["series"], "report_date", "net", "c"), "c")
    near = column(P.gap_guarded_delta(weekly(spark, [10, 40, 30], gaps=[6, 8]), ["series"], "report_date", "net", "c"), "c")
    assert far == [None, None] and near == [None, 30.0, -10.0]


def test_unusual_move_and_extreme_net(spark):
    nets = [float(i) for i in range(61)] + [160.0]
    last = P.positioning_flows(weekly(spark, nets), ["series"]).orderBy(F.desc("report_date")).first()
    assert last["move_rank_pct"] == 100.0 and last["flag"] == "unusual_move extreme_net"
    assert last["net_pct_oi"] == pytest.approx(16.0)


def test_flows_do_not_depend_on_row_order(spark):
    rng = random.Random(5)
    df = weekly(spark, [rng.randint(0, 99) for _ in range(150)])
    plain = P.positioning_flows(df, ["series"]).orderBy("report_date").collect()
    mixed = P.positioning_flows(df.orderBy(F.rand(1)).repartition(7), ["series"]).orderBy("report_date").collect()
    assert plain == mixed


def test_four_week_change_guard_and_turn(spark):
    df = weekly(spark, [1, 2, 3, 4, 9, 11], oi=2.0)
    moved = P.gap_guarded_delta(df, ["series"], "report_date", "net", "net_change")
    assert column(P.build_signals(moved, ["series"]), "chg4") == [None] * 4 + [4.0, 4.5]
    cases = [(10.0, 1.0, 1.0), (90.0, -1.0, -1.0), (50.0, 1.0, 0.0), (10.0, -1.0, 0.0), (None, 1.0, None)]
    rows = spark.createDataFrame(cases, "crowd double, chg double, want double")
    assert all(r["t"] == r["want"] for r in rows.withColumn("t", P.turn_signal(F.col("crowd"), F.col("chg"))).collect())


@pytest.mark.parametrize("today,expected", [
    (dt.date(2026, 9, 21), dt.date(2026, 9, 15)), (dt.date(2026, 9, 22), dt.date(2026, 9, 15)),
    (dt.date(2026, 9, 25), dt.date(2026, 9, 15)), (dt.date(2026, 9, 26), dt.date(2026, 9, 22))])
def test_expected_report_week(spark, today, expected):
    assert spark.range(1).select(P.expected_report_date(F.lit(today)).alias("d")).first()["d"] == expected


# --- As-of ---------------------------------------------------------------------------------

def test_asof_forward_and_its_limit(spark):
    obs = spark.createDataFrame([(dt.date(2026, 1, 5), 1.0), (dt.date(2026, 1, 20), 2.0)], "date date, v double")
    left = spark.createDataFrame([(dt.date(2026, 1, d),) for d in (1, 5, 6, 12, 13, 21)], "day date")
    rows = asof.asof_forward(left, asof.forward_lookup(obs, [], "date", "v"), [], "day", "o").orderBy("day").collect()
    assert [r["o_value"] for r in rows] == [1.0, 1.0, None, None, 2.0, None]


def test_forward_return(spark):
    obs = spark.createDataFrame([(dt.date(2026, 1, 5) + dt.timedelta(days=i), 100.0 + i) for i in range(0, 40)], "date date, v double")
    left = spark.createDataFrame([(dt.date(2026, 1, 6),)], "report_date date")
    got = {(r["entry_lag"], r["horizon"]): r["fwd_return"] for r in
           asof.forward_return(left, obs, [], "report_date", "date", "v", [6, 3], [1, 4]).collect()}
    assert got[(6, 1)] == pytest.approx(math.log(114 / 107)) and got[(3, 4)] == pytest.approx(math.log(132 / 104))


def test_a_grid_tries_every_cell_of_a_series(spark):
    day = lambda i: dt.date(2026, 1, 5) + dt.timedelta(days=i)
    obs = spark.createDataFrame([(t, day(i), base + i) for t, base in (("x", 100.0), ("y", 50.0)) for i in range(40)], "t string, date date, v double")
    left = spark.createDataFrame([("a", day(1)), ("b", day(1)), ("c", day(1))], "series string, report_date date")
    cells = spark.createDataFrame([("a", "x", 6, 1), ("a", "x", 6, 4), ("a", "y", 3, 1), ("b", "y", 3, 2), ("b", "z", 3, 2)],
                                  "series string, t string, entry_lag int, horizon int")
    got = {(r["series"], r["t"], r["entry_lag"], r["horizon"]): r["fwd_return"] for r in
           asof.grid_returns(left, cells, obs, ["series"], ["t"], "report_date", "date", "v").collect()}
    assert got == {("a", "x", 6, 1): pytest.approx(math.log(114 / 107)), ("a", "x", 6, 4): pytest.approx(math.log(135 / 107)),
                   ("a", "y", 3, 1): pytest.approx(math.log(61 / 54)), ("b", "y", 3, 2): pytest.approx(math.log(68 / 54))}


def test_asof_backward(spark):
    df = weekly(spark, list(range(60)))
    r = asof.asof_backward(df, ["series"], "report_date", "net").first()
    assert (r["latest_value"], r["earlier_value"]) == (59.0, 7.0)


def test_overlap_join_equals_brute_force(spark):
    rng = random.Random(9)
    def spans(n, longest):
        out = []
        for i in range(n):
            a = D0 + dt.timedelta(days=rng.randint(0, 400))
            out.append((i, a, a + dt.timedelta(days=rng.randint(0, longest))))
        return out
    a, b = spans(60, 200), spans(40, 5)
    got = asof.overlap_join(spark.createDataFrame(a, "i int, a date, b date"), spark.createDataFrame(b, "j int, c date, d date"),
                            ("a", "b"), ("c", "d")).select("i", "j").collect()
    assert sorted(map(tuple, got)) == sorted((i, j) for i, x, y in a for j, u, v in b if x <= v and u <= y)


# --- Exchange rates ----------------------------------------------------------------------

def test_window_means(spark):
    rows = [(dt.date(2026, 9, 1), 140.0), (dt.date(2026, 9, 10), 142.0), (dt.date(2026, 9, 17), 150.0), (dt.date(2026, 9, 28), 160.0)]
    got = {r["window"]: r["rate"] for r in fx.window_mean(spark.createDataFrame(rows, "date date, rate double"), [], "date", "rate").collect()}
    assert got == {"D10": 141.0, "D20": 144.0, "MONTH": 148.0}


def test_lagged_week_covers_whole_weeks(spark):
    days = [(dt.date(2025, 8, 25), 147.0), (dt.date(2025, 8, 27), 147.8), (dt.date(2025, 9, 8), 160.0), (dt.date(2025, 9, 9), 161.0)]
    got = {r["day"]: r["rate"] for r in fx.lagged_week_rates(spark.createDataFrame(days, "date date, rate double"), [], "date", "rate").collect()}
    assert all(got[dt.date(2025, 9, d)] == pytest.approx(147.4) for d in range(7, 14))
    assert got[dt.date(2025, 9, 21)] == pytest.approx(160.5) and dt.date(2025, 9, 14) not in got


def test_fx_restatement(spark):
    rows = spark.createDataFrame([(dt.date(2026, 7, 1), "MONTH", 490000.0, 350000.0, 40.0)],
                                 "period date, window string, value double, value_year_ago double, yoy_pct double")
    means = spark.createDataFrame([(dt.date(2026, 7, 1), "MONTH", 154.0), (dt.date(2025, 7, 1), "MONTH", 140.0)],
                                  "period date, window string, rate double")
    r = fx.window_fx_restate(rows, means, scale=1000.0).first()
    assert round(r["value_usd"]) == 3181818
    assert (round(r["yoy_pct_usd"], 2), round(r["fx_effect_pt"], 2)) == (27.27, 12.73)
    lone = fx.window_fx_restate(rows, means.limit(0)).first()
    assert lone["value_usd"] is None and lone["fx_effect_pt"] is None


def test_cross_rate_drops_days_without_both_legs(spark):
    rows = [("d1", "USD", 1.1), ("d1", "JPY", 165.0), ("d2", "JPY", 166.0), ("d3", "USD", 1.2), ("d3", "KRW", -1.0)]
    got = fx.cross_rate(spark.createDataFrame(rows, "date string, ccy string, v double"), "date", "ccy", "v", ["JPY", "KRW"]).collect()
    assert [(r["date"], r["quote"], round(r["rate_per_usd"], 6)) for r in got] == [("d1", "JPY", 150.0)]


# --- Diff and flags ------------------------------------------------------------------------

def test_snapshot_diff_baseline_new_revised(spark):
    schema = "source string, k string, value double"
    before = spark.createDataFrame([("us", "a", 1.0), ("us", "b", 2.0), ("us", "gone", 3.0)], schema)
    after = spark.createDataFrame([("us", "a", 1.0), ("us", "b", 2.5), ("us", "c", 1.0), ("jp", "a", 1.0)], schema)
    diff = D.snapshot_diff(before, after, ["source", "k"], "value")
    assert sorted((r["source"], r["k"], r["change"]) for r in diff.collect()) == [
        ("jp", "a", "baseline"), ("us", "b", "revised"), ("us", "c", "new")]
    counts = D.change_counts(diff, ["source"])
    assert [tuple(r) for r in counts.collect()] == [("us", 1, 1)] and tuple(D.change_totals(counts).first()) == (1, 1, 1)


def test_flags_need_material_origins(spark):
    rows = [("-", 26.0, 100.0, None, None), ("JP", 60.0, 6000.0, 6.0, 12.0), ("SMALL", 90.0, 100.0, 50.0, 50.0),
            ("THIN", 90.0, 9000.0, 1.0, 2.0), ("CALM", 40.0, 9000.0, 30.0, 29.0)]
    df = spark.createDataFrame(rows, "origin string, yoy double, value double, share double, prior double")
    got = D.intel_flags(df, F.col("yoy"), F.col("value"), F.col("origin") != "-", F.col("share"), F.col("prior"), F.lit(False))
    assert sorted((r["origin"], r["kind"]) for r in got.collect()) == [("-", "yoy"), ("JP", "share"), ("JP", "yoy")]


def test_flags_of_several_sources_in_order(spark):
    m = dt.date(2026, 7, 1)
    rows = [("us", m, "8542", "-", -9.0, 30.0, None, None, None, False), ("us", m, "8542", "JP", 9000.0, 70.0, None, 30.0, 20.0, None),
            ("japan", m, "Total", None, 5.0, None, 40.0, None, None, False), ("japan", m, "Total again", None, 5.0, 40.0, None, None, None, True),
            ("japan", m, "Cars", None, -80.0, -26.0, 90.0, None, None, False), ("japan", m, "Calm", None, 99.0, 3.0, 90.0, None, None, False),
            ("other", m, "x", "-", None, 25.0, None, None, None, False), ("japan", m, "None", None, 1.0, None, None, None, None, False)]
    df = spark.createDataFrame(rows, "source string, period date, code string, origin string, value double, yoy_pct double, "
                               "yoy_published double, share_pct double, prior_share double, repeats boolean")
    got = D.ranked_flags(df, ["japan", "us"], "origin").orderBy("source_order", "period", "place").collect()
    assert [(r["source"], r["place"], r["code"], r["kind"], r["detail"]) for r in got] == [
        ("japan", 1, "Cars", "yoy", -26.0), ("japan", 2, "Total", "yoy", 40.0), ("us", 1, "8542", "yoy", 70.0), ("us", 2, "8542", "share", 10.0),
        ("us", 3, "8542", "yoy", 30.0), ("other", 1, "x", "yoy", 25.0)]
    assert D.ranked_flags(df.limit(0), ["japan"], "origin").count() == 0


def test_share_of_a_total_that_is_a_row(spark):
    rows = [("c", "JP", 300.0), ("c", "-", 900.0), ("c", None, 90.0), ("d", "JP", 1.0), ("e", "JP", 1.0), ("e", "-", 0.0), (None, "-", 8.0), (None, "JP", 2.0)]
    df = spark.createDataFrame(rows, "code string, origin string, value double")
    got = {(r["code"], r["origin"]): r["share_pct"] for r in G.share_of_total_row(df, ["code"], "origin", "value").collect()}
    assert got == {("c", "JP"): pytest.approx(100 / 3), ("c", None): 10.0, ("d", "JP"): None, ("e", "JP"): None, (None, "JP"): 25.0}


def test_currency_points_worth_a_word(spark):
    df = spark.createDataFrame([(8.0, 5.0), (8.0, 5.1), (-1.0, 9.0), (None, 1.0), (1.0, None)], "y double, u double")
    got = df.select(G.currency_points(F.col("y"), F.col("u")).alias("p")).collect()
    assert [r["p"] for r in got] == [3.0, None, None, None, None]


def test_headline_predicates(spark):
    rows = [("E:Grand Total", "press_release", True), ("E:AREA Grand Total", "press_release", False), ("x", "estat_hs:PROV9", True),
            ("I:Semiconductors etc", "press_release", True), ("y", "press_release", False), ("TOTAL", "timeseries:world_total", False)]
    df = spark.createDataFrame(rows, "item string, source string, want boolean")
    got = df.withColumn("h", D.total_headline(F.col("item"), F.col("source"), ["semiconductors"])).collect()
    assert all(r["h"] == r["want"] for r in got)


# --- Weekly readings ---------------------------------------------------------------------

def daily(spark, values, start=dt.date(2020, 1, 6)):
    return spark.createDataFrame([("s", start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)], "s string, d date, v double")


def test_weekly_last_is_labelled_friday(spark):
    got = S.weekly_last(daily(spark, range(7)), ["s"], "d", "v").orderBy("friday").collect()
    assert [(r["friday"], r["v"]) for r in got] == [(dt.date(2020, 1, 10), 4.0), (dt.date(2020, 1, 17), 6.0)]


def test_sign_streak(spark):
    r = S.sign_streak(daily(spark, [-0.5, -0.1, 0.2, 0.4], dt.date(2024, 8, 30)), ["s"], "d", "v").first()
    assert (r["positive"], r["since"]) == (True, dt.date(2024, 9, 1))


def test_series_summary(spark):
    df = daily(spark, [i // 7 for i in range(7 * 70)], dt.date(2020, 1, 4))  # one value per Saturday-to-Friday week
    r = S.series_summary(df, ["s"], "d", "v").first()
    assert (r["value"], r["change_4w"], r["change_52w"], r["rank_pct"], r["move4_rank_pct"]) == (69.0, 4.0, 52.0, 100.0, 0.0)
    assert len(r["chart"]) == 70 and S.series_summary(df.limit(7 * 10), ["s"], "d", "v").first()["rank_pct"] is None


def test_whole_percent_ranks_round_half_to_even(spark):
    values = [1.0] * 1 + [9.0] * 199 + [5.0]
    r = S.weekly_history(daily(spark, [v for v in values for _ in range(7)], dt.date(2020, 1, 4)), ["s"], "d", "v")
    assert r.select(S.history_rank().alias("r")).first()["r"] == 0.0  # 0.5 rounds to 0


def test_week_ending(spark):
    r = spark.range(1).select(week_ending_sunday(F.lit(dt.date(2026, 9, 21))).alias("d")).first()
    assert r["d"] == dt.date(2026, 9, 27)


@pytest.mark.parametrize("backward,gap", [(False, None), (False, 3), (True, None), (True, 3)])
def test_asof_sweep_equals_brute_force(spark, backward, gap):
    rng = random.Random(12)
    day = lambda i: D0 + dt.timedelta(days=i)
    obs = [(rng.choice("ab"), day(rng.randint(0, 60)), float(rng.randint(0, 9))) for _ in range(25)] + [("a", None, 1.0)]
    left = [(i, rng.choice("abc"), day(rng.randint(-5, 70))) for i in range(80)] + [(80 + i, "a", day(30)) for i in range(40)] + [(200, "a", None)]
    got = asof.asof_sweep(spark.createDataFrame(left, "i int, k string, day date"), spark.createDataFrame(obs, "k string, d date, v double"),
                          ["k"], "day", "d", "v", "p", backward, gap).collect()
    assert len(got) == len(left)
    for r in got:
        ahead = [(d, v) for k, d, v in obs if k == r["k"] and d and r["day"] and (d <= r["day"] if backward else d >= r["day"])]
        best = max(d for d, _ in ahead) if ahead and backward else min(d for d, _ in ahead) if ahead else None
        if best is None or (gap is not None and abs((best - r["day"]).days) > gap):
            assert r["p_date"] is None and r["p_value"] is None
        else:
            assert (r["p_date"], r["p_value"]) == (best, min(v for d, v in ahead if d == best))


def test_overlap_counts_equal_brute_force(spark):
    rng = random.Random(13)
    day = lambda i: D0 + dt.timedelta(days=i)
    spans = [(rng.choice(["x", "y", None]), day(a := rng.randint(0, 90)), day(a + rng.randint(-2, 30))) for _ in range(200)] + [("x", day(1), None)]
    events = [(i, day(a := rng.randint(-10, 100)), day(a + rng.randint(0, 12))) for i in range(40)]
    got = asof.overlap_counts(spark.createDataFrame(events, "e int, s date, t date"), spark.createDataFrame(spans, "k string, a date, b date"),
                              ("s", "t"), ("a", "b"), ["k"]).collect()
    want = {}
    for e, s, t in events:
        for k, a, b in spans:
            if b and a <= b and a <= t and b >= s:
                want[(k, e)] = want.get((k, e), 0) + 1
    assert {(r["k"], r["e"]): r["n"] for r in got} == want


# --- Growth tables -------------------------------------------------------------------------

def test_several_grains_from_one_scan(spark):
    rows = spark.createDataFrame([(1, "a", "x", 2.0), (1, "a", "y", 3.0), (1, None, "x", 5.0), (2, "a", "x", 7.0)], "p int, k string, m string, v double")
    got = releases.grain_sums(rows, {"fine": ["p", "k"], "coarse": ["p"], "other": ["m"]}, v=F.sum("v"))
    assert sorted((r["grain"], r["p"], r["k"] or "-", r["m"], r["v"]) for r in got.collect() if r["grain"] != "other") == [
        ("coarse", 1, "-", None, 10.0), ("coarse", 2, "-", None, 7.0), ("fine", 1, "-", None, 5.0), ("fine", 1, "a", None, 5.0), ("fine", 2, "a", None, 7.0)]
    assert {r["m"]: r["v"] for r in got.where("grain = 'other'").collect()} == {"x": 14.0, "y": 3.0}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_partners_share_the_total_of_their_code(spark):
    m = lambda y: dt.date(y, 5, 1)
    rows = [(m(2025), "E", "8542", "1", "One", 1000.0, 2.0), (m(2026), "E", "8542", "1", "One", 1500.0, 3.0), (m(2026), "E", "8542", "2", "Two", 4500.0, 1.0)]
    df = spark.createDataFrame(rows, "period date, imex string, code string, cty string, name string, v double, q double")
    got = {(r["period"].year, r["cty"]): r for r in releases.partner_table(df, ["imex", "code"], "cty", "name", F.col("v"), F.col("q"), "EA").collect()}
    one, total = got[(2026, "1")], got[(2026, "-")]
    assert (one["value"], one["value_year_ago"], one["yoy_pct"], one["share_of_code_pct"], one["qty1"], one["unit1"]) == (1.5, 1.0, 50.0, 25.0, 3.0, "EA")
    assert (total["name"], total["value"], total["yoy_pct"], total["share_of_code_pct"], total["qty1"]) == ("ALL COUNTRIES", 6.0, 500.0, 100.0, None)
    assert got[(2026, "2")]["yoy_pct"] is None and len(got) == 5


def test_press_stages_collapse_and_rates_restate(spark):
    m = lambda y: dt.date(y, 5, 1)
    press = spark.createDataFrame([(m(2026), "MONTH_DP", "E:x", 120.0, 9.0, 1), (m(2026), "MONTH_PROV", "E:x", 110.0, 8.0, 2), (m(2026), "D10", "E:x", 30.0, 7.0, 1),
                                   (m(2025), "MONTH_PROV", "E:x", 100.0, 6.0, 1)],
                                  "period date, stage string, item string, value double, published double, arrival int")
    series = spark.createDataFrame([(m(2026), "s", "E:y", 5.0)], "period date, series string, item string, value double")
    codes = spark.createDataFrame([(m(2026), "PROV9", "E:HS1", 4.0), (m(2026), "DETAILED", "E:HS1", 3.0), (m(2025), "PROV9", "E:HS1", 2.0)],
                                  "period date, stage string, item string, value double")
    rate = lambda now, ago: spark.createDataFrame([("J", m(2026), "MONTH", now), ("J", m(2025), "MONTH", ago)], "quote string, period date, window string, rate double")
    got = {(r["source"], r["period"].year, r["period_type"]): r for r in releases.customs_table(
        press, series, codes, rate(150.0, 120.0), rate(160.0, 120.0), ["J"], {"MONTH_PROV": 1, "MONTH_DP": 2}, {"PROV9": 1, "DETAILED": 2}).collect()}
    month = got[("press_release", 2026, "MONTH")]
    assert (month["value"], month["published"], month["value_year_ago"], month["value_usd"]) == (120.0, 9.0, 100.0, 800.0)
    assert month["yoy_pct"] == pytest.approx(20.0) and month["yoy_pct_usd"] == pytest.approx(-4.0)
    assert month["fx_effect_pt"] == pytest.approx(24.0) and month["yoy_pct_customs"] == pytest.approx(-10.0)
    assert got[("press_release", 2026, "D10")]["value_usd"] is None and got[("estat_hs:DETAILED", 2026, "MONTH")]["yoy_pct"] == pytest.approx(50.0)
    assert len(got) == 6
