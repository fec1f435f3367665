"""Year-ago growth, breadth, stage picking, shares and group rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from firstprint.functions.numbers import pct_change
from firstprint.operators.quantiles import exact_median


def with_earlier(df: DataFrame, keys: list[str], period: str, value: str, months: int,
                 out: str) -> DataFrame:
    """Each row beside the same key's value `months` calendar months earlier.

    A calendar match, not a row lag: a missing month never shifts the base.
    Every row is sent to its own period and to the later one it is the base of,
    and the two meet in one aggregate, so the input is computed once where a
    self-join computes it twice. The input has one row per key and period.
    """
    spots = F.array(F.struct(F.col(period).alias("at"), F.lit(True).alias("own")),
                    F.struct(F.add_months(F.col(period), months).alias("at"), F.lit(False).alias("own")))
    own = F.col("_spot.own")
    others = [c for c in df.columns if c not in (*keys, period)]
    met = df.withColumn("_spot", F.explode(spots)).groupBy(*keys, F.col("_spot.at").alias(period)).agg(
        F.bool_or(own).alias("_own"), *[F.max(F.when(own, F.col(c))).alias(c) for c in others],
        F.max(F.when(~own, F.col(value))).alias(out))
    return met.where("_own").select(*df.columns, out)


def yoy_self_join(df: DataFrame, keys: list[str], period: str = "period", value: str = "value",
                  months: int = 12) -> DataFrame:
    """Value beside the same key's value `months` earlier, and the growth."""
    return (with_earlier(df, keys, period, value, months, f"{value}_year_ago")
            .withColumn("yoy_pct", pct_change(value, f"{value}_year_ago")))


def latest_of_key(df: DataFrame, keys: list[str], order: list, columns: list[str]) -> DataFrame:
    """One row per key: the one with the largest order tuple.

    An aggregate, so copies of a hot key collapse before the shuffle.
    """
    pick = F.max_by(F.struct(*columns), F.struct(*order)).alias("_pick")
    return df.groupBy(*keys).agg(pick).select(*keys, "_pick.*")


def stage_priority_pick(df: DataFrame, keys: list[str], stage: str, ranks: dict[str, int],
                        columns: list[str], arrival: str = "arrival",
                        ties: str = "last") -> DataFrame:
    """The row of the strongest release stage per key.

    Equal stages go to the later arrival (`ties="last"`) or the earlier one.
    A stage outside `ranks` is weaker than all of them.
    """
    rank = F.coalesce(*[F.when(F.col(stage) == name, F.lit(r)) for name, r in ranks.items()],
                      F.lit(0))
    tie = F.col(arrival) if ties == "last" else -F.col(arrival)
    return latest_of_key(df, keys, [rank.alias("r"), tie.alias("t")], columns)


def group_membership(df: DataFrame, membership: DataFrame, member: str, group: str = "group",
                     all_label: str | None = "all_listed") -> DataFrame:
    """One row per (row, group it belongs to), plus the all-members group.

    Groups of a member travel as one short array, so the facts are read once.
    """
    groups = membership.groupBy(member).agg(F.collect_set(group).alias("_groups"))
    named = F.coalesce(F.col("_groups"), F.array().cast("array<string>"))
    if all_label:
        named = F.array_append(named, F.lit(all_label))
    return df.join(groups, member, "left").withColumn(group, F.explode(named)).drop("_groups")


def group_growth_breadth(df: DataFrame, keys: list[str], now: str, ago: str) -> DataFrame:
    """Aggregate growth, exact median member growth and breadth per key.

    Only members with a positive year-ago figure count.
    """
    pairs = (df.where((F.col(ago) > 0) & F.col(now).isNotNull())
             .withColumn("_yoy", pct_change(F.col(now).cast("double"), F.col(ago).cast("double"))))
    totals = [F.sum(now).cast("double").alias("sum_now"), F.sum(ago).cast("double").alias("sum_year_ago"),
              F.avg(F.when(F.col("_yoy") > 0, 100.0).otherwise(0.0)).alias("breadth_pct")]
    return (exact_median(pairs, keys, "_yoy", also=totals)
            .withColumnsRenamed({"n": "n_members", "median": "median_yoy_pct"})
            .withColumn("agg_yoy_pct", pct_change("sum_now", "sum_year_ago")))


def prefix_assign(df: DataFrame, code: str, prefixes: list[str], prefix: str = "prefix") -> DataFrame:
    """Each row once per configured prefix its code starts with.

    The code is cut to the few configured lengths and matched by equality, so
    the dictionary can grow without a nested-loop join.
    """
    spark = df.sparkSession
    lengths = sorted({len(p) for p in prefixes})
    table = spark.createDataFrame([(p,) for p in sorted(set(prefixes))], f"{prefix} string")
    cuts = F.array_distinct(F.array(*[F.substring(F.col(code), 1, n) for n in lengths]))
    return df.withColumn(prefix, F.explode(cuts)).join(table, prefix)


def prefix_sum(df: DataFrame, keys: list[str], code: str, prefixes: list[str], value: str) -> DataFrame:
    """Sum per key and prefix; codes are added up before they are fanned out."""
    by_code = df.groupBy(*keys, code).agg(F.sum(value).alias("_sum"))
    return (prefix_assign(by_code, code, prefixes).groupBy(*keys, "prefix")
            .agg(F.sum("_sum").cast("double").alias(value)))


def share_of_total(rows: DataFrame, totals: DataFrame, keys: list[str], value: str,
                   total: str) -> DataFrame:
    """Part of the published total, which need not be the sum of the parts."""
    share = 100.0 * F.try_divide(F.col(value), F.col(total))
    return (rows.join(totals.select(*keys, total), keys, "left").withColumn("share_pct", share))


def share_of_total_row(rows: DataFrame, keys: list[str], member: str, value: str, total_member: str = "-",
                       total: str = "total") -> DataFrame:
    """The same where the published total is a row among the parts, named `total_member`.

    Parts find it by one window over the rows of their key, so parts and totals are computed and shuffled once. A key has one
    row per member. Without a total row, or with a zero one, the share is NULL; the total row itself is left out.
    """
    stored = F.max(F.when(F.col(member) == total_member, F.col(value))).over(Window.partitionBy(*keys))
    return (rows.withColumn(total, stored).where(~F.col(member).eqNullSafe(F.lit(total_member)))
            .withColumn("share_pct", 100.0 * F.try_divide(F.col(value), F.col(total))))


def prior_period_share(df: DataFrame, keys: list[str], period: str, share: str) -> DataFrame:
    """Share now beside the share one calendar month earlier."""
    return (with_earlier(df, keys, period, share, 1, f"{share}_prior")
            .withColumn("share_move_pt", F.col(share) - F.col(f"{share}_prior")))


def top_n_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """First n rows per key; each task keeps its own n before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def newest_period(df: DataFrame, keys: list[str], period: str) -> DataFrame:
    """Rows of each source's newest period only."""
    latest = df.groupBy(*keys).agg(F.max(period).alias(period))
    return df.join(latest, [*keys, period], "left_semi")


def latest_and_previous(df: DataFrame, keys: list[str], period: str, window: str,
                        columns: list[str]) -> DataFrame:
    """Newest two prints per source in (month, window) order, on one row."""
    order = (F.when(F.col(window) == "D10", 0).when(F.col(window) == "D20", 1)
             .when(F.col(window) == "MONTH", 2).otherwise(3))
    two = top_n_per_group(df.withColumn("_w", order), keys,
                          [F.desc(period), F.desc("_w"), *[F.desc(c) for c in columns]], 2)
    fields = [period, window, *columns]
    return two.groupBy(*keys).agg(
        *[F.max(F.when(F.col("rank") == 1, F.col(c))).alias(c) for c in fields],
        *[F.max(F.when(F.col("rank") == 2, F.col(c))).alias(f"prev_{c}") for c in fields])


def currency_points(yoy: Column, yoy_usd: Column, at_least: float = 3.0) -> Column:
    """Points of growth that are only a weaker currency, where they are worth a word."""
    return F.when(yoy - yoy_usd >= at_least, yoy - yoy_usd)


def detail_level(df: DataFrame, level: str, detail: str = "DET") -> DataFrame:
    """Only detail rows (and unlabelled ones) if any row is labelled detail."""
    has_detail = df.where(F.col(level) == detail).select(F.lit(1)).exists()
    blank = F.coalesce(F.col(level), F.lit("")) == ""
    return df.where(~has_detail | blank | (F.col(level) == detail))


def preferred_variant(df: DataFrame, variant: str, preferred: str = "en") -> DataFrame:
    """Rows of the preferred language if there are any, else of the first one."""
    c = F.col(variant)
    chosen = df.select(F.min_by(c, F.struct((c != preferred), c))).scalar()
    return df.where(c == chosen)


def tagged_union(**tables: DataFrame) -> DataFrame:
    """Tables stacked under one header with the name each came from."""
    out = None
    for name, df in tables.items():
        tagged = df.withColumn("source", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
