"""Wide published layouts to long rows, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firstprint.functions.fixed_values import GROUP_FIELDS, MONTH_ABBREVIATIONS
from firstprint.functions.numbers import parse_number
from firstprint.functions.staging import once


def _field(df: DataFrame, name: str | None) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def wide_to_long_groups(df: DataFrame, keep: list, groups: dict[str, tuple]) -> DataFrame:
    """One row per trader group of a record; a group lacking a leg is skipped."""
    rows = [F.struct(F.lit(group).alias("trader_group"),
                     *[parse_number(_field(df, f)).alias(name)
                       for f, name in zip(fields, ("long", "short", "spread"))])
            for group, fields in groups.items()]
    out = df.select(*keep, F.explode(F.array(*rows)).alias("_g")).select("*", "_g.*").drop("_g")
    return (out.where(F.col("long").isNotNull() & F.col("short").isNotNull())
            .withColumn("net", F.col("long") - F.col("short")))


def report_groups(report: str) -> dict[str, tuple]:
    """Trader groups of a report, by the family its name starts with."""
    return GROUP_FIELDS.get(report.split("_", 1)[0], {})


def wide_months_to_long(df: DataFrame, keep: list, year: str, stages: Column | None = None,
                        measures: tuple[str, ...] = ("Value", "Quantity1", "Quantity2")) -> DataFrame:
    """Value-Jan .. Value-Dec style columns as one row per published month.

    A month is unpublished when its value is blank, or all its measures are zero.
    `stages` may be an array of (month, stage).
    """
    by_name = {c.strip().lower(): c for c in df.columns}
    rows = []
    for number, name in enumerate(MONTH_ABBREVIATIONS, start=1):
        if f"{measures[0]}-{name}".lower() not in by_name:
            continue
        cells = [parse_number(_field(df, by_name.get(f"{m}-{name}".lower()))).alias(m.lower())
                 for m in measures]
        rows.append(F.struct(F.lit(number).alias("month"), *cells))
    out = df.select(*keep, year, *([stages.alias("_stages")] if stages is not None else []),
                    F.explode(F.array(*rows)).alias("_m")).select("*", "_m.*").drop("_m")
    first, *rest = [m.lower() for m in measures]
    empty = F.col(first) == 0
    for m in rest:
        empty = empty & (F.coalesce(F.col(m), F.lit(0.0)) == 0)
    out = out.where(F.col(first).isNotNull() & ~empty)
    if stages is not None:
        hit = F.filter("_stages", lambda s: s["month"] == F.col("month"))
        out = out.withColumn("stage", F.coalesce(F.get(hit, F.lit(0))["stage"], F.lit(""))).drop("_stages")
    return out.withColumn("yyyymm", F.concat_ws("-", F.col(year).cast("string"),
                                                F.lpad(F.col("month").cast("string"), 2, "0")))


def paired_columns_to_long(df: DataFrame, keep: list, cells: Column, names: Column, kinds: Column,
                           quantity: str = "数量") -> DataFrame:
    """(name, value, quantity) rows from data rows and their header rows.

    A column of the quantity kind carries the pair's name and is followed by
    its value column; any other named column is a value on its own. Zero and
    blank values are unpublished.
    """
    staged = once(df, keep, _c=cells, _n=names, _k=kinds)
    shifted = F.array_append(F.slice("_c", 2, F.size("_c")), F.lit(None).cast("string"))
    columns = F.arrays_zip(F.col("_n").alias("name"), F.col("_k").alias("kind"), F.col("_c").alias("cell"),
                           shifted.alias("after"))
    paired = F.coalesce(F.col("_z.kind") == quantity, F.lit(False))
    named = (staged.select(*keep, F.posexplode(columns).alias("position", "_z"))
             .where((F.col("position") > 0) & (F.col("_z.name") != "")))
    out = once(named, [*keep, "position"], name=F.col("_z.name"),
               value=parse_number(F.when(paired, F.col("_z.after")).otherwise(F.col("_z.cell"))),
               quantity=F.when(paired, parse_number(F.col("_z.cell"))))
    return out.where(F.col("value") != 0)


def windows_to_long(df: DataFrame, keep: list, windows: dict[str, str], parent: str, own: str,
                    name: str) -> DataFrame:
    """Cumulative window columns as rows; a row without a parent is a total.

    Zero means the window is not published yet.
    """
    blank = F.trim(F.coalesce(F.col(parent).cast("string"), F.lit(""))) == ""
    month = F.trim(F.when(blank, F.col(own)).otherwise(F.col(parent)))
    rows = [F.struct(F.lit(window).alias("window"),
                     F.replace(F.col(c).cast("string"), F.lit(","), F.lit("")).try_cast("double").alias("value"))
            for c, window in windows.items()]
    label = F.when(blank, "TOTAL").otherwise(F.trim(F.col(name)))
    return (df.where(month.rlike(r"^\d{6}$") & (F.coalesce(label, F.lit("")) != ""))
            .select(*keep, F.concat_ws("-", F.substring(month, 1, 4), F.substring(month, 5, 2)).alias("yyyymm"),
                    blank.alias("is_total"), label.alias("name"), F.explode(F.array(*rows)).alias("_w"))
            .select("*", "_w.*").drop("_w").where(F.col("value") != 0))


def spread_columns(df: DataFrame) -> DataFrame:
    """Yield gaps; NULL unless both legs exist."""
    return (df.withColumn("gap_2s10s", F.col("y10y") - F.col("y2y"))
            .withColumn("gap_3m10y", F.col("y10y") - F.col("y3m")))


def drop_empty_measures(df: DataFrame, value: str, quantity: str | None = None) -> DataFrame:
    """Rows with a value, or with a quantity beside a zero value."""
    kept = F.col(value) != 0
    if quantity:
        kept = kept | (F.coalesce(F.col(quantity), F.lit(0.0)) != 0)
    return df.where(F.col(value).isNotNull() & kept)
