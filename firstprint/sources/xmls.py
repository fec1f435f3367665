"""XML payloads: repeated elements to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firstprint.functions.periods import local_date, rfc822_timestamp
from firstprint.functions.text import split_suffix


def read_xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Rows of one repeated element over a folder of XML files."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def xml_rows(df: DataFrame, body: str, path: list[str], fields: list[str],
             keep: list[str] = ()) -> DataFrame:
    """Rows of the element at `path` below the root, its leaves as strings.

    An error envelope raises, and so does a payload that is not XML; a blank one has no rows. Records whose leaves are all blank are dropped.
    """
    leaf = ", ".join(f"`{f}`: string" for f in fields)
    inner = f"array<struct<{leaf}>>"
    for tag in reversed(path[1:]):
        inner = f"struct<`{tag}`: {inner}>"
    schema = f"header struct<resultCode: string, resultMsg: string>, `{path[0]}` {inner}, _unread string"
    parsed = F.from_xml(F.col(body), schema, {"columnNameOfCorruptRecord": "_unread"})
    staged = df.select(*keep, F.when(F.trim(body) != "", parsed).alias("_x"))
    code = F.col("_x.header.resultCode")
    bad = code.isNotNull() & ~code.isin("00", "0000", "INFO-0", "NORMAL SERVICE.")
    items = F.col("_x." + ".".join(f"`{t}`" for t in path))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("API error "), code, F.lit(": "),
                                                 F.coalesce(F.col("_x.header.resultMsg"), F.lit("")))))
    checked = checked.when(F.col("_x._unread").isNotNull(), F.raise_error(
        F.concat(F.lit("not XML: "), F.left(F.col("_x._unread"), F.lit(300)))))
    rows = staged.select(*keep, F.posexplode(checked.otherwise(items)).alias("position", "_r"))
    trimmed = [F.trim(F.coalesce(F.col(f"_r.`{f}`"), F.lit(""))).alias(f) for f in fields]
    out = rows.select(*keep, "position", *trimmed)
    return out.where(F.concat(*[F.col(f"`{f}`") for f in fields]) != "")


def drop_totals(df: DataFrame, column: str, mark: str = "총") -> DataFrame:
    """Rows whose period is blank or a totals label carry no period."""
    return df.where((F.col(column) != "") & ~F.startswith(F.col(column), F.lit(mark)))


def feed_items(df: DataFrame, body: str, keep: list[str] = (), zone: str = "America/New_York") -> DataFrame:
    """Feed items: title and outlet split, the day in the given zone."""
    items = xml_rows(df, body, ["channel", "item"], ["title", "source", "link", "pubDate"], keep)
    split = items.withColumn("_s", split_suffix(F.trim("title"), F.col("source")))
    day: Column = local_date(rfc822_timestamp("pubDate"), zone)
    return (split.select(*keep, "position", F.col("_s.title").alias("title"),
                         F.col("_s.outlet").alias("outlet"), "link", day.alias("published"))
            .where(F.col("title") != ""))
