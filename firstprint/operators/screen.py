"""Screening funnel, forecast scoring and record-keeping rules as table jobs."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from firstprint.operators.growth import latest_of_key
from firstprint.session import materialize

PILLAR_WEIGHTS = {"claim_reality": 15, "control_capture": 15, "duration": 10,
                  "financial_translation": 15, "mispricing": 15, "valuation_payoff": 20,
                  "implementability": 10}


def liquidity_gate(daily: DataFrame, name: str, date: str, dollar_volume: str, intended,
                   days: int = 90, share: float = 0.10, build_days: int = 5, least_days: int = 30) -> DataFrame:
    """Average dollar volume over each name's trailing days, and the capacity it gives.

    The trailing frame is in calendar days and the input has one row per name
    and day, so a frame never holds more than `days` rows. A name passes from
    `least_days` calendar days after its first one on.
    """
    w = (Window.partitionBy(name).orderBy(F.unix_date(F.col(date)))
         .rangeBetween(-(days - 1), 0))
    capacity = F.col("adv") * share * build_days
    mean = F.sum(dollar_volume).over(w).cast("double") / F.count(dollar_volume).over(w)
    known = F.date_diff(F.col(date), F.min(date).over(Window.partitionBy(name).orderBy(date))) + 1 >= least_days
    return (daily.withColumn("adv", mean).withColumn("capacity", capacity)
            .withColumn("passes", known & (F.col("capacity") >= intended)))


def universe_dedup(listings: DataFrame, issuer: str, kind: str, value: str, floor: float,
                   prefer: list, ordinary: str = "ordinary") -> DataFrame:
    """Ordinary shares above a value floor, one listing per issuer."""
    kept = listings.where((F.col(kind) == ordinary) & (F.col(value) >= floor))
    return latest_of_key(kept, [issuer], prefer, [c for c in listings.columns if c != issuer])


def screen_funnel(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """First failing test per name in the given order; NULL for survivors."""
    fails = [F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in tests.items()]
    return df.withColumn("first_fail", F.coalesce(*fails))


def funnel_counts(screened: DataFrame, tests: list[str]) -> DataFrame:
    """Names left after each stage, in stage order."""
    stage_of = reduce(lambda acc, item: F.when(F.col("first_fail") == item[1], item[0]).otherwise(acc),
                      list(enumerate(tests, start=1)), F.lit(len(tests) + 1))
    left = screened.agg(*[F.count_if(stage_of > i).alias(name) for i, name in enumerate(tests, start=1)])
    return left.unpivot([], tests, "stage", "survivors")


def newly_passing(previous: DataFrame, current: DataFrame, name: str) -> DataFrame:
    """Names that failed or were absent before and survive now."""
    before = previous.where(F.col("first_fail").isNull()).select(name)
    return current.where(F.col("first_fail").isNull()).join(before, name, "left_anti")


def three_year_return(df: DataFrame, name: str, year: str, profit: str, capital: str,
                      not_in_service: str, bar: float = 12.0) -> DataFrame:
    """Three-year mean return on capital in service; NULL without three clean years."""
    in_service = F.col(capital) - F.col(not_in_service)
    yearly = 100.0 * F.when(in_service > 0, F.col(profit) / in_service)
    w = Window.partitionBy(name).orderBy(year)
    three = w.rowsBetween(-2, 0)
    complete = (F.count("_r").over(three) == 3) & (F.col(year) - F.lag(year, 2).over(w) == 2)
    return (df.withColumn("_r", yearly)
            .withColumn("return_3y", F.when(complete, F.avg("_r").over(three)))
            .withColumn("passes", F.col("return_3y") >= bar).drop("_r"))


def rank_score_topk(df: DataFrame, name: str, scores: dict[str, tuple[Column, float, float]],
                    k: int = 40) -> DataFrame:
    """0-10 degree scores between a worst and a best value, summed; the top k.

    Scores come from fixed anchors, so ranking needs no global ordering pass
    but the final top-k, which keeps k rows per task.
    """
    def degree(c, worst, best):
        share = (c - F.lit(worst)) / F.lit(best - worst)
        return F.greatest(F.lit(0.0), F.least(F.lit(10.0), 10.0 * share))

    scored = df.withColumns({f"score_{n}": degree(c, lo, hi) for n, (c, lo, hi) in scores.items()})
    total = reduce(lambda a, b: a + b, [F.col(f"score_{n}") for n in scores])
    return scored.withColumn("score", total).orderBy(F.desc("score"), F.asc(name)).limit(k)


def price_test_bands(fcf_yield: Column, growth: Column, own_growth: Column) -> list[Column]:
    """Estimated yearly return and the list it puts a name on."""
    estimate = fcf_yield + F.least(growth, own_growth, F.lit(12.0))
    band = F.when(estimate >= 15, "pass").when(estimate >= 10, "second list").otherwise("fail")
    return [estimate.alias("estimated_return"), band.alias("price_band")]


def brier_calibration(forecasts: DataFrame, keys: list[str], p: str, outcome: str,
                      width: float = 0.1) -> DataFrame:
    """Brier score and stated versus realised frequency per probability band."""
    band = F.least(F.floor(F.col(p) / width), F.lit(round(1 / width) - 1)) * width
    return (forecasts.groupBy(*keys, F.round(band, 2).alias("band"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(F.pow(F.col(p) - F.col(outcome), 2)).alias("brier"),
                 F.avg(p).alias("stated"), F.avg(F.col(outcome).cast("double")).alias("realised"))
            .withColumn("overconfident", F.col("stated") > F.col("realised")))


# --- Evidence genealogy ---------------------------------------------------------------

def root_sources(claims: DataFrame, claim: str, parent: str) -> DataFrame:
    """(claim, root): each claim's earliest source, following parents.

    Only claims that are somebody's parent can be inside a chain, so pointer
    doubling runs on the distinct parents: a source copied a billion times is
    one row there. Each round halves the remaining depth and is written to the
    shared folder, which cuts the lineage and lets a lost executor resume.
    A parent that is not itself recorded is a root. A cycle raises: rounds that
    still move when their reach exceeds the number of nodes, or an end that has
    a parent.
    """
    has_parent = F.col(parent).isNotNull() & (F.col(parent) != F.col(claim))
    links, _ = materialize(claims.select(F.col(claim).alias("node"), F.when(has_parent, F.col(parent)).alias("up")),
                           "genealogy")
    inner = links.where("up is not null").select(F.col("up").alias("node")).distinct()
    chain = inner.join(links, "node", "left").select("node", F.coalesce("up", "node").alias("root"),
                                                     F.col("up").isNotNull().alias("moved"))
    moved = [F.count_if("moved").alias("moved"), F.count(F.lit(1)).alias("nodes")]
    reach = 1
    while True:
        chain, seen = materialize(chain, "genealogy", *moved)
        if not seen["moved"]:
            break
        if reach > 4 * (seen["nodes"] + 1):  # no chain without a cycle is longer than its nodes and their last parent
            raise ValueError("root_sources: parent links form a cycle")
        reach *= 2
        hop = chain.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        chain = (chain.join(hop, "root", "left")
                 .select("node", F.coalesce("_next", "root").alias("root"),
                         (F.coalesce("_next", "root") != F.col("root")).alias("moved")))
    # A cycle whose length is a power of two ends up pointing at itself.
    ends = chain.where(F.col("root") == F.col("node")).select("node")
    if not ends.join(links.where("up is not null"), "node", "left_semi").isEmpty():
        raise ValueError("root_sources: parent links form a cycle")
    roots = chain.select(F.col("node").alias("_up"), F.col("root").alias("_root"))
    return (claims.withColumn("_up", F.when(has_parent, F.col(parent))).join(roots, "_up", "left")
            .withColumn("root", F.coalesce("_root", claim)).drop("_up", "_root"))


def evidence_genealogy(claims: DataFrame, thesis: str, claim: str, parent: str, primary: str,
                       resolved: str, point: str) -> DataFrame:
    """Per thesis: raw sources, distinct roots, primary, corroborated, unresolved.

    A point is corroborated when claims with different roots support it.
    """
    traced = root_sources(claims, claim, parent)
    per_root = traced.groupBy(thesis, point, "root").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(primary)).alias("_p"),
        F.count_if(~F.col(resolved)).alias("_u"))
    points = per_root.groupBy(thesis, point).agg(F.count(F.lit(1)).alias("_roots"))
    backed = points.groupBy(thesis).agg(F.count_if(F.col("_roots") >= 2).alias("corroborated_points"))
    roots = (per_root.groupBy(thesis, "root")
             .agg(F.sum("_n").alias("_n"), F.sum("_p").alias("_p"), F.sum("_u").alias("_u"))
             .groupBy(thesis).agg(F.sum("_n").alias("raw_sources"), F.count(F.lit(1)).alias("distinct_roots"),
                                  F.sum("_p").alias("primary_sources"), F.sum("_u").alias("unresolved")))
    return roots.join(backed, thesis)


# --- Scorecard, windows, exposure -------------------------------------------------------

def weighted_scorecard(df: DataFrame, gate: str, overrides: list[str],
                       weights: dict[str, int] = PILLAR_WEIGHTS) -> DataFrame:
    """Weighted score, and a decision the gate and the overrides can block."""
    score = reduce(lambda a, b: a + b, [F.col(c) * w / 100.0 for c, w in weights.items()])
    blocked = reduce(lambda a, b: a | b, [F.col(c) for c in overrides], F.lit(False))
    decision = (F.when(F.col(gate) == "Veto", "rejected").when(blocked, "blocked")
                .when(F.col(gate) == "Cap", "capped").otherwise("may advance"))
    return df.withColumn("score", score).withColumn("decision", decision)


def window_lapse(windows: DataFrame, decisions: DataFrame, key: str, start: str, end: str,
                 decided: str, today) -> DataFrame:
    """Dated windows that ended without a recorded decision inside them."""
    over = windows.where(F.col(end) < today)
    inside = (over.join(decisions.select(key, F.col(decided).alias("_d")), key)
              .where(F.col("_d").between(F.col(start), F.col(end)))
              .select(key, start, end).distinct())
    return over.join(inside, [key, start, end], "left_anti")


def stale_entries(entries: DataFrame, confirmed: str, today, months: int = 6) -> DataFrame:
    """Entries not reconfirmed for more than two quarters."""
    return entries.where(F.add_months(F.col(confirmed), months) < today)


UNMAPPED = "unmapped"


def exposure_lookthrough(holdings: DataFrame, constituents: DataFrame, drivers: DataFrame,
                         caps: DataFrame, account: str, asset: str, value: str, member: str,
                         weight: str, driver: str, cap: str) -> DataFrame:
    """Exposure per account and driver with funds opened up, against the caps.

    Holdings are summed per (account, asset) first. A fund is replaced by its
    constituents, anything else stands for itself. Assets without a driver are
    shown under UNMAPPED.
    """
    held = holdings.groupBy(account, asset).agg(F.sum(value).alias("_v"))
    opened = (held.join(constituents, asset, "left")
              .select(account, F.coalesce(F.col(member), F.col(asset)).alias("_a"),
                      (F.col("_v") * F.coalesce(F.col(weight), F.lit(Decimal(1)))).alias("_v")))
    mapped = (opened.join(drivers.select(F.col(asset).alias("_a"), driver), "_a", "left")
              .withColumn(driver, F.coalesce(driver, F.lit(UNMAPPED))))
    exposure = mapped.groupBy(account, driver).agg(F.sum("_v").cast("double").alias("exposure"))
    totals = held.groupBy(account).agg(F.sum("_v").cast("double").alias("_t"))
    return (exposure.join(totals, account).join(caps, driver, "left")
            .withColumn("exposure_pct", 100.0 * F.try_divide(F.col("exposure"), F.col("_t")))
            .withColumn("over_cap", F.coalesce(F.col("exposure_pct") > F.col(cap), F.lit(False))).drop("_t"))


# --- Point in time ------------------------------------------------------------------------

def point_in_time_packet(records: DataFrame, keys: list[str], known_at: str, cutoff,
                         columns: list[str], ties: list[str] = ()) -> DataFrame:
    """Latest version of each record among those known by the cutoff."""
    known = records.where(F.col(known_at) <= cutoff)
    return latest_of_key(known, keys, [F.col(known_at), *[F.col(t) for t in ties]], [known_at, *columns])


def reveal_increments(records: DataFrame, known_at: str, cutoff, days: int) -> DataFrame:
    """Later records in chronological steps: 1 is the first `days` after the cutoff."""
    since = F.date_diff(F.to_date(F.col(known_at)), F.lit(cutoff).cast("date"))
    return (records.where(F.col(known_at) > cutoff)
            .withColumn("increment", (F.floor((since - 1) / days) + 1).cast("bigint")))


def milestone_dates(events: DataFrame, key: str, milestone: str, date: str, names: list[str]) -> DataFrame:
    """First date of each milestone, one row per key."""
    return events.groupBy(key).agg(*[F.min(F.when(F.col(milestone) == m, F.col(date))).alias(m) for m in names])


def lead_times(rows: DataFrame, first: str, recognised: str, price_first: str, price_recognised: str,
               price_rerated: str) -> DataFrame:
    """Lead time, price move before recognition, and the rerating already done by then."""
    before = F.ln(F.col(price_recognised) / F.col(price_first))
    whole = F.ln(F.col(price_rerated) / F.col(price_first))
    return (rows.withColumn("lead_days", F.date_diff(F.col(recognised), F.col(first)))
            .withColumn("move_before", before).withColumn("rerating_done", F.try_divide(before, whole)))


def first_dates(df: DataFrame, key: str, date: str, conditions: dict[str, Column]) -> DataFrame:
    """Date of the first row that meets each condition, one row per key; NULL where none does."""
    return df.groupBy(key).agg(*[F.min(F.when(met, F.col(date))).alias(name) for name, met in conditions.items()])


def recognition_clock(rows: DataFrame, prices: dict[str, str], evidence: str = "t0", monetised: str = "t1",
                      recognised: str = "t3", revised: str = "t4", rerated: str = "t6") -> DataFrame:
    """How early an idea was and what is left of it, from its milestones and the prices at three of them.

    `prices` names the price columns of evidence, recognition and rerating. Days from evidence to recognition and from first
    revenue to revised estimates, log move before recognition, share of the whole move done by then and what was left. An
    idea was early if nobody had recognised it, or only after its evidence; NULL while there is no evidence. A milestone
    that has not come, or has no price, leaves what needs it NULL.
    """
    at = lambda name: F.col(prices[name])
    move = lambda a, b: F.ln(F.try_divide(at(b), at(a)))
    return rows.withColumns({
        "lead_days": F.date_diff(recognised, evidence), "confirmation_days": F.date_diff(revised, monetised),
        "move_before": move(evidence, recognised), "rerating_done": F.try_divide(move(evidence, recognised), move(evidence, rerated)),
        "gap_left": move(recognised, rerated),
        "early": F.when(F.col(evidence).isNotNull(), F.col(recognised).isNull() | (F.col(recognised) > F.col(evidence)))})


def stage_outcomes(stones: DataFrame, names: list[str], success: str) -> DataFrame:
    """Per milestone: ideas that reached it, those that never came to `success` on that day or later, and their share."""
    stages = F.explode(F.array(*[F.struct(F.lit(n).alias("milestone"), F.col(n).alias("day")) for n in names])).alias("_s")
    reached = stones.select(F.col(success).alias("_end"), stages).where(F.col("_s.day").isNotNull())
    failed = F.count_if(F.col("_end").isNull() | (F.col("_end") < F.col("_s.day")))
    return (reached.groupBy(F.col("_s.milestone").alias("milestone")).agg(F.count(F.lit(1)).alias("reached"), failed.alias("failed"))
            .withColumn("false_positive_pct", 100.0 * F.col("failed") / F.col("reached")))


def flat_run(df: DataFrame, key: str, order: str, value: str, out: str = "flat_signal") -> DataFrame:
    """True when the value failed to grow at this report and at the one before."""
    w = Window.partitionBy(key).orderBy(order)
    flat = F.col(value) <= F.lag(value).over(w)
    return (df.withColumn("_flat", flat)
            .withColumn(out, F.coalesce(F.col("_flat") & F.lag("_flat").over(w), F.lit(False))).drop("_flat"))
