"""Delimited text: plain header files, monthly file sets and preambled files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from firstprint.functions.staging import once
from firstprint.operators.growth import latest_of_key


def csv_strings(spark: SparkSession, path: str, header: list[str], encoding: str = "UTF-8") -> DataFrame:
    """A header CSV as strings, blanks as NULL; a missing file is an empty table.

    The header names the columns wanted; the file may have them in any order.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    try:
        found = _by_name(spark, path, header, encoding)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
    return found.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in header])


def _by_name(spark: SparkSession, path: str, header: list[str], encoding: str = "UTF-8") -> DataFrame:
    """The named columns of all files, with `_path` and `_position` (the order of rows in a file).

    Every file has its own header line, whatever the order of its columns: files are read together by header. Cells may
    hold commas, line ends and doubled quotes; a file is therefore read by one task.
    """
    lines = spark.read.option("encoding", encoding).option("wholetext", False).text(path)
    first = (lines.where("_metadata.file_block_start = 0")
             .select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"))
             .groupBy("path").agg(F.min_by("value", "at").alias("value")))
    sets = first.groupBy("value").agg(F.collect_list("path").alias("paths")).collect()  # file names, by kind of header
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, "_path"]] + [T.StructField("_position", T.LongType())])
    out = None
    for row in sorted(sets, key=lambda r: r["value"]):
        df = (spark.read.option("header", True).option("encoding", encoding).option("multiLine", True)
              .option("escape", '"').csv(row["paths"]))
        named = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in header]
        df = df.select(*named, F.input_file_name().alias("_path"), F.monotonically_increasing_id().alias("_position"))
        out = df if out is None else out.unionByName(df)
    return spark.createDataFrame([], schema) if out is None else out


def multi_file_last_wins(spark: SparkSession, glob: str, header: list[str], keys: list[str]) -> DataFrame:
    """Rows of all files of a set, columns by name; per key the last file by path wins, and in it the last row."""
    return last_file_wins(_by_name(spark, glob, header), keys, "_path", "_position")


def last_file_wins(df: DataFrame, keys: list[str], path: str, position: str | None = None) -> DataFrame:
    columns = [c for c in df.columns if c not in (*keys, path, position)]
    order = [F.col(path)] + ([F.col(position)] if position else [])
    return latest_of_key(df, keys, order, columns)


def preamble_rows(df: DataFrame, body: str, header_start: str, header_word: str | None = None,
                  keep: list[str] = ()) -> DataFrame:
    """Lines below the real header as (line number, name -> cell) rows.

    The header is the first line starting with `header_start` (and holding
    `header_word`), whatever stands above it; files without one give no rows.
    """
    lines = F.split(F.regexp_replace(F.col(body), "\r", ""), "\n")

    def cells(line):
        """Cells of one line; quoted ones may hold commas and doubled quotes."""
        found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',(\s*"(?:[^"]|"")*"\s*(?=,|$)|[^,]*)'), F.lit(1))
        quoted = F.transform(found, lambda c: F.trim(F.replace(F.regexp_replace(F.trim(c), '^"|"$', ""), F.lit('""'), F.lit('"'))))
        return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.transform(F.split(line, ","), lambda c: F.trim(c)))

    def is_header(line):
        low = F.lower(F.ltrim(F.regexp_replace(line, '^[﻿"]+', "")))
        ok = F.startswith(low, F.lit(header_start))
        return ok & low.contains(header_word) if header_word else ok

    staged = once(df, keep, _l=lines)
    staged = once(staged, [*keep, "_l"], _at=F.array_position(F.transform("_l", is_header), True).cast("int"))
    head = F.transform(cells(F.regexp_replace(F.get("_l", F.col("_at") - 1), "\ufeff", "")), F.lower)
    staged = staged.where(F.col("_at") > 0).select(
        *keep, head.alias("header"), F.slice("_l", F.col("_at") + 1, F.size("_l")).alias("_rows"))
    rows = staged.select(*keep, "header", F.posexplode("_rows").alias("line", "_line"))
    return rows.where(F.trim("_line") != "").select(*keep, "line", "header", cells(F.col("_line")).alias("cells"))


def cell(header: str | Column, cells: str | Column, wanted, position_only: bool = False) -> Column:
    """Cell under the first header that fits a name test; NULL when none does."""
    head = F.col(header) if isinstance(header, str) else header
    body = F.col(cells) if isinstance(cells, str) else cells
    test = wanted if callable(wanted) else (lambda h: h == wanted)
    at = F.array_position(F.transform(head, test), True)
    return F.when(at > 0, F.get(body, (at - 1).cast("int")))


def last_per_date(df: DataFrame, keys: list[str], date: str, line: str) -> DataFrame:
    """Of repeated dates the last line stands."""
    columns = [c for c in df.columns if c not in (*keys, date, line)]
    return latest_of_key(df.where(F.col(date).isNotNull()), [*keys, date], [F.col(line)], columns)
