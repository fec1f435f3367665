import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firstprint.operators import screen as S, stats
from firstprint.operators.ranks import average_rank

D0 = dt.date(2010, 1, 5)


def cells(spark, xs, ys, name="c", horizon=2):
    rows = [(name, horizon, D0 + dt.timedelta(days=7 * i), float(x), float(y)) for i, (x, y) in enumerate(zip(xs, ys))]
    return spark.createDataFrame(rows, "c string, horizon int, d date, x double, y double")


def avg_ranks(v):
    order = sorted(v)
    return np.array([order.index(x) + 1 + (order.count(x) - 1) / 2 for x in v])


def reference_t(x, y, lag):
    z = lambda r: (r - r.mean()) / r.std()
    zx, zy = z(avg_ranks(x)), z(avg_ranks(y))
    rho = (zx * zy).mean()
    u = zx * (zy - rho * zx)
    s = (u * u).mean() + sum(2 * (1 - k / (lag + 1)) * (u[k:] * u[:-k]).sum() / len(u) for k in range(1, lag + 1))
    return rho, rho / np.sqrt(s / len(u))


def test_ties_share_their_rank(spark):
    df = spark.createDataFrame([("k", v) for v in (10.0, 20.0, 20.0, 30.0)], "k string, v double")
    assert sorted(r["r"] for r in df.withColumn("r", average_rank(["k"], "v")).collect()) == [1.0, 2.5, 2.5, 4.0]


@pytest.mark.parametrize("lag", [1, 4])
def test_rho_and_robust_t(spark, lag):
    rng = random.Random(lag)
    x = [rng.randint(0, 30) for _ in range(200)]
    y = [a + rng.gauss(0, 20) for a in x]
    r = stats.newey_west_t(cells(spark, x, y, horizon=lag), ["c", "horizon"], "d", "x", "y", "horizon").first()
    rho, t = reference_t(x, y, lag)
    assert r["rho"] == pytest.approx(rho) and r["t_nw"] == pytest.approx(t)


def test_small_and_constant_cells(spark):
    small = stats.newey_west_t(cells(spark, range(20), range(20)), ["c", "horizon"], "d", "x", "y", "horizon").first()
    flat = stats.newey_west_t(cells(spark, [1] * 40, range(40)), ["c", "horizon"], "d", "x", "y", "horizon").first()
    assert (small["rho"], small["t_nw"]) == (None, None) and (flat["rho"], flat["t_nw"]) == (0.0, None)


def test_quintiles_use_the_past_only(spark):
    rng = random.Random(2)
    x = [rng.random() for _ in range(260)]
    df = cells(spark, x, [a * 2 for a in x])
    r = stats.quintile_spread(df, ["c", "horizon"], "d", "x", "y").first()
    top, bottom = [], []
    for i, v in enumerate(x):
        if i >= 104:
            rank = 100.0 * sum(p < v for p in x[:i]) / i
            (top if rank >= 80 else bottom if rank < 20 else []).append(2 * v)
    assert (r["top_n"], r["bottom_n"]) == (len(top), len(bottom))
    assert r["top_minus_bottom_pct"] == pytest.approx((np.mean(top) - np.mean(bottom)) * 100)


def test_halves_must_agree(spark):
    rng = random.Random(8)
    x = [rng.random() for _ in range(200)]
    same = [a + rng.gauss(0, 0.3) for a in x]
    split = D0 + dt.timedelta(days=700)
    flipped = same[:100] + [-v for v in same[100:]]
    args = (["c", "horizon"], "d", split, "x", "y", "horizon")
    yes = stats.split_half_consistency(cells(spark, x, same), *args).first()
    no = stats.split_half_consistency(cells(spark, x, flipped), *args).first()
    assert yes["consistent"] == "yes" and no["consistent"] == "" and no["rho_half2"] < 0 < no["rho_half1"]


def test_ols_recovers_known_slopes_and_hac_t(spark):
    rng = np.random.default_rng(5)
    a, b, c = rng.normal(size=(3, 240))
    y = 1 + 2 * a - 0.5 * b + rng.normal(scale=0.01, size=240)
    rows = [("k", 3, D0 + dt.timedelta(days=7 * i), *map(float, v)) for i, v in enumerate(zip(y, a, b, c))]
    df = spark.createDataFrame(rows, "k string, h int, d date, y double, a double, b double, c double")
    r = stats.ols_hac(df, ["k", "h"], "d", "y", ["a", "b", "c"], "h").first()
    z = lambda v: (v - v.mean()) / v.std()
    X = np.column_stack([np.ones(240), z(a), z(b), z(c)])
    inv = np.linalg.inv(X.T @ X)
    beta = inv @ X.T @ z(y)
    u = X * (z(y) - X @ beta)[:, None]
    s = u.T @ u
    for k in range(1, 4):
        g = u[k:].T @ u[:-k]
        s += (1 - k / 4) * (g + g.T)
    t = beta / np.sqrt(np.diag(inv @ s @ inv))
    assert r["coef_signal"] == pytest.approx(beta[1]) and r["coef_signal"] * y.std() / a.std() == pytest.approx(2.0, abs=0.01)
    assert [r["t_signal"], r["t_past_flow"], r["t_past_price"]] == pytest.approx(list(t[1:]), rel=1e-6)
    assert stats.ols_hac(df.limit(99), ["k", "h"], "d", "y", ["a", "b", "c"], "h").count() == 0


# --- Screening --------------------------------------------------------------------------

@pytest.mark.parametrize("k", [2, 3, 5])
def test_ols_of_any_number_of_regressors(spark, k):
    rng, n = np.random.default_rng(k), 160
    x = rng.normal(size=(k, n))
    x[-1] += 0.8 * x[0]
    y = x.T @ np.arange(1, k + 1) + rng.normal(size=n)
    names = [f"x{i}" for i in range(k)]
    schema = "k string, h int, d date, y double, " + ", ".join(f"{c} double" for c in names)
    row = lambda name, i, values: (name, 2, D0 + dt.timedelta(days=7 * i), float(y[i]), *map(float, values))
    rows = [row("good", i, x[:, i]) for i in range(n)]
    rows += [row("double", i, [*x[:-1, i], 2 * x[0, i]]) for i in range(n)] + [row("still", i, [*x[:-1, i], 7.0]) for i in range(n)]
    rows += [row("short", i, x[:, i]) for i in range(99)]
    got = {r["k"]: r for r in stats.ols_hac_cells(spark.createDataFrame(rows, schema), ["k", "h"], "d", "y", names, "h").collect()}
    assert set(got) == {"good", "double", "still"}
    for bad in ("double", "still"):
        assert got[bad]["n"] == n and all(got[bad][f"{w}_{c}"] is None for w in ("coef", "t") for c in names)
    z = lambda v: (v - v.mean()) / v.std()
    X = np.column_stack([np.ones(n), *map(z, x)])
    inv = np.linalg.inv(X.T @ X)
    beta = inv @ X.T @ z(y)
    u = X * (z(y) - X @ beta)[:, None]
    s = u.T @ u
    for lag in (1, 2):
        g = u[lag:].T @ u[:-lag]
        s += (1 - lag / 3) * (g + g.T)
    t = beta / np.sqrt(np.diag(inv @ s @ inv))
    assert [got["good"][f"coef_{c}"] for c in names] == pytest.approx(list(beta[1:]))
    assert [got["good"][f"t_{c}"] for c in names] == pytest.approx(list(t[1:]), rel=1e-6)


def test_liquidity_gate(spark):
    df = spark.createDataFrame([("n", D0 + dt.timedelta(days=i), v) for i, v in ((0, 100.0), (5, 300.0), (29, 500.0), (100, 20.0))], "n string, d date, v double")
    got = S.liquidity_gate(df, "n", "d", "v", 100.0, days=90).orderBy("d").collect()
    assert [(r["adv"], r["capacity"], r["passes"]) for r in got] == [(100.0, 50.0, False), (200.0, 100.0, False), (300.0, 150.0, True), (260.0, 130.0, True)]


def test_funnel_keeps_the_first_failure(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 0, 0), ("c", 1, 0), ("d", 1, None)], "n string, x int, y int")
    tests = {"ruin": F.col("x") == 1, "return": F.col("y") == 1}
    out = S.screen_funnel(df, tests)
    assert {r["n"]: r["first_fail"] for r in out.collect()} == {"a": None, "b": "ruin", "c": "return", "d": "return"}
    assert {r["stage"]: r["survivors"] for r in S.funnel_counts(out, list(tests)).collect()} == {"ruin": 3, "return": 1}
    before = S.screen_funnel(df.withColumn("y", F.lit(0)), tests)
    assert [r["n"] for r in S.newly_passing(before, out, "n").collect()] == ["a"]


def test_three_year_return_needs_consecutive_years(spark):
    rows = [("a", y, 15.0, 120.0, 20.0) for y in (2020, 2021, 2022)] + [("b", y, 15.0, 100.0, 0.0) for y in (2019, 2021, 2022)] + [("c", 2022, 1.0, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "n string, y int, p double, k double, b double")
    got = {(r["n"], r["y"]): (r["return_3y"], r["passes"]) for r in S.three_year_return(df, "n", "y", "p", "k", "b").collect()}
    assert got[("a", 2022)] == (15.0, True) and got[("b", 2022)] == (None, None) and got[("c", 2022)] == (None, None)


def test_price_bands_and_scores(spark):
    df = spark.createDataFrame([("a", 6.0, 20.0, 9.0), ("b", 6.0, 7.0, 9.0), ("c", 1.0, 30.0, 30.0)], "n string, f double, g double, o double")
    got = {r["n"]: (r["estimated_return"], r["price_band"]) for r in df.select("n", *S.price_test_bands(F.col("f"), F.col("g"), F.col("o"))).collect()}
    assert got == {"a": (15.0, "pass"), "b": (13.0, "second list"), "c": (13.0, "second list")}
    top = S.rank_score_topk(df, "n", {"f": (F.col("f"), 0.0, 10.0), "g": (F.col("g"), 30.0, 0.0)}, 2).collect()
    assert [(r["n"], round(r["score"], 3)) for r in top] == [("b", 13.667), ("a", 9.333)]


def test_brier_bands(spark):
    df = spark.createDataFrame([("q", 0.72, 1), ("q", 0.78, 0), ("q", 1.0, 1)], "q string, p double, o int")
    got = {r["band"]: r for r in S.brier_calibration(df, ["q"], "p", "o").collect()}
    assert got[0.7]["n"] == 2 and got[0.7]["brier"] == pytest.approx((0.28 ** 2 + 0.78 ** 2) / 2) and got[0.7]["overconfident"]
    assert got[0.9]["brier"] == 0.0


def test_recognition_clock_and_outcomes(spark):
    d = lambda n: dt.date(2026, 1, 1) + dt.timedelta(days=n)
    rows = [("a", d(0), "x"), ("a", d(5), "t3"), ("a", d(9), "t6"), ("a", d(7), "t3"), ("b", d(3), "x"), ("c", d(1), "t6"), ("c", d(2), "x"), (None, d(1), "x")]
    events = spark.createDataFrame(rows, "k string, day date, what string")
    has = lambda w: F.col("what") == w
    stones = S.first_dates(events, "k", "day", {"t0": has("x"), "t1": has("x"), "t3": has("t3"), "t4": has("none"), "t6": has("t6")})
    assert {r["k"]: (r["t0"], r["t3"], r["t4"]) for r in stones.collect()}["a"] == (d(0), d(5), None)
    priced = stones.withColumns({"p0": F.lit(100.0), "p3": F.when(F.col("k") == "a", 110.0), "p6": F.lit(121.0)})
    got = {r["k"]: r for r in S.recognition_clock(priced, {"t0": "p0", "t3": "p3", "t6": "p6"}).collect()}
    a = got["a"]
    assert (a["lead_days"], a["confirmation_days"], a["early"]) == (5, None, True)
    assert a["rerating_done"] == pytest.approx(0.5) and a["gap_left"] == pytest.approx(a["move_before"])
    assert got["b"]["early"] and got["b"]["move_before"] is None and got["b"]["lead_days"] is None
    ends = {r["milestone"]: (r["reached"], r["failed"]) for r in S.stage_outcomes(stones, ["t0", "t3", "t4"], "t6").collect()}
    assert ends == {"t0": (4, 3), "t3": (1, 0)}  # c was rerated before its evidence came
    assert S.recognition_clock(priced.limit(0), {"t0": "p0", "t3": "p3", "t6": "p6"}).count() == 0


def test_genealogy_follows_long_chains_and_hot_sources(spark):
    chain = [("t", "p", f"c{i}", f"c{i - 1}" if i else None) for i in range(300)]
    copies = [("t", "q", f"x{i}", "press") for i in range(500)]  # the release itself is not recorded
    df = spark.createDataFrame(chain + copies, "t string, p string, c string, up string")
    roots = {r["c"]: r["root"] for r in S.root_sources(df, "c", "up").collect()}
    assert len(roots) == 800 and roots["c299"] == "c0" and roots["c0"] == "c0" and roots["x7"] == "press"
    full = df.withColumn("prim", F.col("c") == "c0").withColumn("res", F.lit(True))
    r = S.evidence_genealogy(full, "t", "c", "up", "prim", "res", "p").first()
    assert (r["raw_sources"], r["distinct_roots"], r["primary_sources"], r["corroborated_points"], r["unresolved"]) == (800, 2, 1, 0, 0)


@pytest.mark.parametrize("links", [[("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a")]])
def test_a_cycle_of_claims_raises(spark, links):
    with pytest.raises(ValueError, match="cycle"):
        S.root_sources(spark.createDataFrame(links, "c string, up string"), "c", "up")


def test_scorecard_gate_is_not_summed(spark):
    names = list(S.PILLAR_WEIGHTS)
    df = spark.createDataFrame([("v", "Veto", False), ("c", "Cap", False), ("p", "Pass", False), ("o", "Pass", True)], "n string, gate string, o boolean")
    for name in names:
        df = df.withColumn(name, F.lit(8.0))
    got = {r["n"]: (r["score"], r["decision"]) for r in S.weighted_scorecard(df, "gate", ["o"]).collect()}
    assert {n: d for n, (_, d) in got.items()} == {"v": "rejected", "c": "capped", "p": "may advance", "o": "blocked"}
    assert all(s == pytest.approx(8.0) for s, _ in got.values())


def test_lapsed_windows_and_stale_entries(spark):
    d = lambda n: D0 + dt.timedelta(days=n)
    windows = spark.createDataFrame([("a", d(0), d(10)), ("b", d(0), d(10)), ("c", d(0), d(90))], "k string, s date, e date")
    decisions = spark.createDataFrame([("a", d(10)), ("b", d(11))], "k string, t date")
    assert [r["k"] for r in S.window_lapse(windows, decisions, "k", "s", "e", "t", F.lit(d(50))).collect()] == ["b"]
    assert [r["k"] for r in S.stale_entries(windows, "e", F.lit(d(200))).collect()] == ["a", "b"]


def test_exposure_opens_funds(spark):
    hold = spark.createDataFrame([("x", "ETF", 100.0), ("x", "A", 100.0)], "acc string, asset string, v double")
    parts = spark.createDataFrame([("ETF", "A", 0.6), ("ETF", "B", 0.4)], "asset string, m string, w double")
    drivers = spark.createDataFrame([("A", "ai"), ("B", "oil")], "asset string, drv string")
    caps = spark.createDataFrame([("ai", 50.0)], "drv string, cap double")
    got = {r["drv"]: (r["exposure"], r["over_cap"]) for r in
           S.exposure_lookthrough(hold, parts, drivers, caps, "acc", "asset", "v", "m", "w", "drv", "cap").collect()}
    assert got == {"ai": (160.0, True), "oil": (40.0, False)}
    unknown = S.exposure_lookthrough(hold, parts, drivers.where("drv = 'ai'"), caps, "acc", "asset", "v", "m", "w", "drv", "cap")
    assert {r["drv"]: r["exposure"] for r in unknown.collect()} == {"ai": 160.0, "unmapped": 40.0}


def test_point_in_time(spark):
    rows = [("a", dt.date(2026, 1, 1), 1.0), ("a", dt.date(2026, 3, 1), 2.0), ("a", dt.date(2026, 6, 1), 3.0), ("b", dt.date(2026, 4, 10), 9.0)]
    df = spark.createDataFrame(rows, "k string, t date, v double")
    assert [tuple(r) for r in S.point_in_time_packet(df, ["k"], "t", dt.date(2026, 4, 1), ["v"]).collect()] == [("a", dt.date(2026, 3, 1), 2.0)]
    later = S.reveal_increments(df, "t", dt.date(2026, 4, 1), 30)
    assert {(r["k"], r["increment"]) for r in later.collect()} == {("b", 1), ("a", 3)}


def test_one_flat_quarter_is_noise(spark):
    df = spark.createDataFrame([("n", i, float(v)) for i, v in enumerate((1, 2, 2, 3, 3, 2))], "n string, q int, v double")
    assert [r["flat_signal"] for r in S.flat_run(df, "n", "q", "v").orderBy("q").collect()] == [False, False, False, False, False, True]
