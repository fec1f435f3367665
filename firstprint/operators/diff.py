"""Snapshot differences, change counts and flags on new rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from firstprint.operators.growth import top_n_per_group

FLAG_YOY_PCT = 25.0
FLAG_ORIGIN_YOY_PCT = 50.0
FLAG_SHARE_PT = 5.0
MIN_SHARE_PCT = 5.0
MIN_VALUE_K = 5000.0


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: list[str], value: str,
                  source: str = "source") -> DataFrame:
    """New and revised rows of the current snapshot.

    Missing keys are equal to missing ones. A source with no previous rows is a baseline: nothing in it is news. Keys
    that disappeared are ignored. Values compare typed and null-safely.
    """
    before = previous.select(*[F.col(k).alias(f"_is_{k}") for k in keys], F.col(value).alias("previous_value"), F.lit(True).alias("_had"))
    known = previous.select(F.col(source).alias("_source")).distinct().withColumn("_known", F.lit(True))
    same = reduce(lambda a, b: a & b, [current[k].eqNullSafe(before[f"_is_{k}"]) for k in keys])
    had = F.col("_had").isNotNull()
    status = (F.when(F.col("_known").isNull(), "baseline").when(~had, "new")
              .when(~F.col(value).eqNullSafe(F.col("previous_value")), "revised"))
    joined = current.join(before, same, "left").join(known, current[source].eqNullSafe(known["_source"]), "left")
    return (joined.withColumn("change", status).where(F.col("change").isNotNull())
            .drop("_had", "_known", "_source", *[f"_is_{k}" for k in keys]))


def change_counts(diff: DataFrame, keys: list[str]) -> DataFrame:
    """New and revised rows per source, period and window."""
    return (diff.where(F.col("change") != "baseline").groupBy(*keys)
            .agg(F.count_if(F.col("change") == "new").alias("n_new"),
                 F.count_if(F.col("change") == "revised").alias("n_revised")))


def change_totals(counts: DataFrame) -> DataFrame:
    """One line: print groups, new rows, revised rows."""
    return counts.agg(F.count(F.lit(1)).alias("n_groups"),
                      F.coalesce(F.sum("n_new"), F.lit(0)).alias("n_new"),
                      F.coalesce(F.sum("n_revised"), F.lit(0)).alias("n_revised"))


# --- Headline predicates ----------------------------------------------------------

def total_headline(item: Column, source: Column, items_of_interest: list[str]) -> Column:
    """Totals, code sums and listed items; duplicated totals never."""
    duplicate = (source == "timeseries:world_total") | F.endswith(item, F.lit("AREA Grand Total"))
    listed = F.lit(False)
    for tag in items_of_interest:
        listed = listed | F.lower(item).contains(tag.lower())
    total = F.upper(item).contains("TOTAL") | item.contains("総額")
    return F.startswith(source, F.lit("estat_hs")) | (~duplicate & (total | listed))


def token_headline(item: Column, tokens: list[str]) -> Column:
    hit = F.lit(False)
    for token in tokens:
        hit = hit | F.upper(item).contains(token.upper())
    return hit


def origin_headline(df: DataFrame, group: list[str], origin: str, value: str, total_code: str = "-",
                    n: int = 6, codes: list[str] | None = None, code: str = "code") -> DataFrame:
    """Total rows, and the n largest origins of each group (of the listed codes)."""
    parts = df.where(F.col(origin) != total_code)
    if codes is not None:
        parts = parts.where(F.col(code).isin(codes))
    top = top_n_per_group(parts, group, [F.desc(F.coalesce(F.col(value), F.lit(0.0))), F.asc(origin)], n)
    return df.where(F.col(origin) == total_code).unionByName(top.drop("rank"))


# --- Flags --------------------------------------------------------------------------

def intel_flags(rows: DataFrame, yoy: Column, value: Column, is_origin: Column, share: Column,
                prior_share: Column, duplicate: Column) -> DataFrame:
    """Threshold crossings among new headline rows, one row per flag.

    Origin rows must be material (share now or before, and value) and need a
    bigger move; duplicates of another series are skipped.
    """
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    material = ~is_origin | ((F.greatest(zero(share), zero(prior_share)) >= MIN_SHARE_PCT)
                             & (zero(value) >= MIN_VALUE_K))
    bar = F.when(is_origin, FLAG_ORIGIN_YOY_PCT).otherwise(FLAG_YOY_PCT)
    moved = F.when(F.abs(yoy) >= bar, F.struct(F.lit("yoy").alias("kind"), yoy.alias("detail")))
    shifted = F.when(is_origin & (F.abs(share - prior_share) >= FLAG_SHARE_PT),
                     F.struct(F.lit("share").alias("kind"), (share - prior_share).alias("detail")))
    return (rows.where(material & ~duplicate)
            .withColumn("_f", F.explode(F.array_compact(F.array(moved, shifted))))
            .withColumn("kind", F.col("_f.kind")).withColumn("detail", F.col("_f.detail")).drop("_f"))


def ranked_flags(rows: DataFrame, sources: list[str], origin: str, total_code: str = "-") -> DataFrame:
    """Flags among new headline rows of several sources, in reading order.

    Rows have source, period, code, `origin`, value, yoy_pct, yoy_published, share_pct, prior_share and repeats: growth that
    was published stands in where a store has no year-ago value, and a series that only repeats another one is skipped, so a
    move is flagged once. Only rows of an origin (any but `total_code`, and not NULL) need be material. `source_order` is the
    place of the source in `sources`, `place` counts within (source, period) by size of value, largest first; a flag for
    growth comes before one for a share.
    """
    is_origin = F.coalesce(F.col(origin), F.lit(total_code)) != total_code
    flags = intel_flags(rows, F.coalesce("yoy_pct", "yoy_published"), F.col("value"), is_origin, F.col("share_pct"), F.col("prior_share"),
                        F.coalesce(F.col("repeats"), F.lit(False)))
    order = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source"))
    size = F.abs(F.coalesce(F.col("value"), F.lit(0.0)))
    nth = Window.partitionBy("source", "period").orderBy(F.desc(size), "code", origin, F.desc("kind"))
    return (flags.withColumn("source_order", F.when(order > 0, order).otherwise(len(sources) + 1))
            .withColumn("place", F.row_number().over(nth)))
