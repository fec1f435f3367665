"""As-of lookups as equality joins on a day key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def forward_lookup(obs: DataFrame, by: list[str], date: str, value: str, day: str = "day",
                   max_gap: int = 7) -> DataFrame:
    """For every day, the first observation on or after it within `max_gap` days.

    Each observation answers for itself and the few days before it, so the
    lookup is unique per (by, day) and later joins are plain equality joins.
    """
    offsets = F.array(*[F.lit(k) for k in range(max_gap + 1)])
    return (obs.select(*by, F.col(date), F.col(value), F.explode(offsets).alias("_k"))
            .groupBy(*by, F.date_sub(F.col(date), F.col("_k")).alias(day))
            .agg(F.min(F.struct(F.col(date).alias("d"), F.col(value).alias("v"))).alias("_o"))
            .select(*by, day, F.col("_o.d").alias("obs_date"), F.col("_o.v").alias("obs_value")))


def asof_forward(left: DataFrame, lookup: DataFrame, by: list[str], day, prefix: str,
                 how: str = "left") -> DataFrame:
    """Attach `{prefix}_date` and `{prefix}_value` for the day given."""
    right = lookup.select(*by, F.col("day").alias("_day"),
                          F.col("obs_date").alias(f"{prefix}_date"),
                          F.col("obs_value").alias(f"{prefix}_value"))
    day = F.col(day) if isinstance(day, str) else day
    return left.withColumn("_day", day).join(right, [*by, "_day"], how).drop("_day")


def forward_return(left: DataFrame, obs: DataFrame, by: list[str], date: str, obs_date: str,
                   obs_value: str, entry_lags: list[int], horizons: list[int]) -> DataFrame:
    """Log change from the entry observation to the one h weeks after it.

    One row per (left row, entry lag, horizon) with both ends present.
    """
    lags = F.explode(F.array(*[F.lit(n) for n in entry_lags]))
    weeks = F.array(*[F.lit(h) for h in horizons])
    return _returns(left.withColumn("entry_lag", lags).withColumn("_weeks", weeks), obs, by, date, obs_date, obs_value)


def grid_returns(left: DataFrame, cells: DataFrame, obs: DataFrame, series: list[str], by: list[str], date: str,
                 obs_date: str, obs_value: str) -> DataFrame:
    """The same for a grid that is a table: `cells` has, per series (columns `series`), the targets (columns `by`, the keys
    of `obs`), entry lags and horizons to try. A series without cells has no rows."""
    ways = cells.groupBy(*series, *by, "entry_lag").agg(F.collect_set("horizon").alias("_weeks"))  # a cell's few horizons
    return _returns(left.join(ways, series), obs, by, date, obs_date, obs_value)


def _returns(left: DataFrame, obs: DataFrame, by: list[str], date: str, obs_date: str, obs_value: str) -> DataFrame:
    lookup = forward_lookup(obs, by, obs_date, obs_value)
    entry = asof_forward(left, lookup, by, F.date_add(F.col(date), F.col("entry_lag")), "entry", "inner")
    each = entry.withColumn("horizon", F.explode("_weeks")).drop("_weeks")
    both = asof_forward(each, lookup, by, F.date_add(F.col("entry_date"), F.col("horizon") * 7), "exit", "inner")
    return both.withColumn("fwd_return", F.ln(F.col("exit_value") / F.col("entry_value")))


def multi_asof_controls(left: DataFrame, flow: DataFrame, price: DataFrame, by: list[str],
                        date: str, obs_date: str, obs_value: str, horizons: list[int],
                        entry_lag: int = 6, past_days: int = 28) -> DataFrame:
    """Forward flow beside the past flow and past price move known at entry.

    Flows, prices and left rows share the keys `by`. A row missing any of the five observations is dropped.
    """
    flows = forward_lookup(flow, by, obs_date, obs_value)
    prices = forward_lookup(price, by, obs_date, obs_value)
    past = F.date_sub(F.col("entry_date"), F.lit(past_days))
    out = asof_forward(left, flows, by, F.date_add(F.col(date), entry_lag), "entry", "inner")
    out = asof_forward(out, flows, by, past, "past", "inner")
    out = asof_forward(out, prices, by, "entry_date", "price_now", "inner")
    out = asof_forward(out, prices, by, past, "price_past", "inner")
    out = out.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    out = asof_forward(out, flows, by, F.date_add(F.col("entry_date"), F.col("horizon") * 7),
                       "exit", "inner")
    return (out.withColumn("y", F.ln(F.col("exit_value") / F.col("entry_value")))
            .withColumn("past_flow", F.ln(F.col("entry_value") / F.col("past_value")))
            .withColumn("past_price", F.ln(F.col("price_now_value") / F.col("price_past_value"))))


def asof_sweep(left: DataFrame, obs: DataFrame, by: list[str], day: str, obs_date: str, obs_value: str, prefix: str,
               backward: bool = False, max_gap: int | None = None) -> DataFrame:
    """Attach `{prefix}_date` and `{prefix}_value`: the next observation on or after the day, or with `backward` the last one on
    or before it, however far away, or NULL if it is more than `max_gap` days off.

    Both sides are cut to one row per key and day and laid on one line, which a single ordered scan per key fills in; no
    observation is copied. A key's line is as long as the calendar however many rows a day has, and the rows meet their
    day's answer in an equality join, where Spark splits a hot day. Of several observations of a day the smallest value counts.
    """
    seen = obs.where(F.col(obs_date).isNotNull()).groupBy(*by, F.col(obs_date).alias("_day")).agg(F.min(obs_value).alias("_v"))
    found = F.struct(F.col("_day").alias("date"), F.col("_v").alias("value"))
    asked = left.select(*by, F.col(day).alias("_day")).where("_day is not null").distinct()
    line = seen.select(*by, "_day", found.alias("_o")).unionByName(asked, allowMissingColumns=True)
    # The observation of a day comes before the question about that day, whichever way the scan runs.
    along = Window.partitionBy(*by).orderBy(F.asc("_day") if backward else F.desc("_day"), F.col("_o").isNull())
    answer = F.last("_o", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    answers = line.withColumn("_a", answer).where("_o is null")
    if max_gap is not None:
        answers = answers.withColumn("_a", F.when(F.abs(F.date_diff("_a.date", "_day")) <= max_gap, F.col("_a")))
    answers = answers.select(*by, "_day", F.col("_a.date").alias(f"{prefix}_date"), F.col("_a.value").alias(f"{prefix}_value"))
    return left.withColumn("_day", F.col(day)).join(answers, [*by, "_day"], "left").drop("_day")


def asof_backward(df: DataFrame, series: list[str], date: str, value: str, days: int = 364) -> DataFrame:
    """Per series: the last observation at least `days` before its latest one."""
    latest = df.groupBy(*series).agg(F.max(date).alias("latest_date"),
                                     F.max_by(value, date).alias("latest_value"))
    cutoff = F.date_sub(F.col("latest_date"), F.lit(days))
    earlier = (df.join(latest.select(*series, "latest_date"), series)
               .where(F.col(date) <= cutoff).groupBy(*series)
               .agg(F.max(date).alias("earlier_date"), F.max_by(value, date).alias("earlier_value")))
    return latest.join(earlier, series, "left")


def interval_overlap(events: DataFrame, start: str, end: str, first, last) -> DataFrame:
    """Events whose interval meets [first, last]."""
    return events.where((F.col(end) >= first) & (F.col(start) <= last))


def overlap_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str],
                 right_span: tuple[str, str], bucket_days: int = 32) -> DataFrame:
    """Pairs of intervals that meet, joined on shared time buckets.

    A pair sharing several buckets is kept in the first one only, so nothing is
    emitted twice and no all-pairs join is needed.
    """
    def bucketed(df, span, name):
        lo, hi = (F.floor(F.unix_date(F.col(c)) / bucket_days) for c in span)
        return df.withColumn(name, lo).withColumn("_bucket", F.explode(F.sequence(lo, hi)))

    pairs = bucketed(left, left_span, "_lb").join(bucketed(right, right_span, "_rb"), "_bucket")
    meets = ((F.col(left_span[0]) <= F.col(right_span[1]))
             & (F.col(right_span[0]) <= F.col(left_span[1])))
    return (pairs.where(meets & (F.col("_bucket") == F.greatest("_lb", "_rb")))
            .drop("_bucket", "_lb", "_rb"))


def overlap_counts(events: DataFrame, spans: DataFrame, event_span: tuple[str, str], span: tuple[str, str], by: list[str],
                   name: str = "n") -> DataFrame:
    """How many spans of each key meet each event (both ends included), for the keys where any do: no pair is formed.

    An endpoint sweep: the spans that meet an event are those begun by its end less those ended before its start. Spans are
    reduced to the starts and ends of each (key, day) before the shuffle, so a key's line is as long as the calendar and the
    events. Spans that end before they start, or lack an end, meet nothing. The keys should be few: each event is asked for
    every key.
    """
    begin, end = (F.col(c) for c in span)
    at = lambda day, mark, value: [F.lit("day"), day, F.lit(mark), value]
    ends = F.array(F.named_struct(*at(begin, "_s", F.lit(1)), F.lit("_e"), F.lit(0)),
                   F.named_struct(*at(end, "_s", F.lit(0)), F.lit("_e"), F.lit(1)))
    marks = spans.where(begin <= end).select(*by, F.inline(ends)).groupBy(*by, "day").agg(F.sum("_s").alias("_s"), F.sum("_e").alias("_e"))
    keys = marks.select(F.collect_set(F.struct(*by))).scalar() if by else None
    first, last = (F.col(c) for c in event_span)
    asks = F.array(F.named_struct(*at(last, "_till", F.lit(True))), F.named_struct(*at(F.date_sub(first, 1), "_till", F.lit(False))))
    asked = events.where(first <= last).select(F.struct("*").alias("_event"), asks.alias("_asks"), *([F.explode(keys).alias("_key")] if by else []))
    asked = asked.select(*[F.col(f"_key.{b}").alias(b) for b in by], "_event", F.inline("_asks"))
    line = marks.unionByName(asked, allowMissingColumns=True)
    upto = Window.partitionBy(*by).orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = line.withColumns({"_begun": F.sum("_s").over(upto), "_ended": F.sum("_e").over(upto)}).where("_event is not null")
    met = F.max(F.when(F.col("_till"), F.coalesce("_begun", F.lit(0)))) - F.max(F.when(~F.col("_till"), F.coalesce("_ended", F.lit(0))))
    return sums.groupBy(*by, "_event").agg(met.alias(name)).where(F.col(name) > 0).select(*by, "_event.*", name)
