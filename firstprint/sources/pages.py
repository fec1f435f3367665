"""Scraped pages: table rows, links with their context, numbers in notices."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from firstprint.functions.staging import once
from firstprint.functions.text import clean_text


def html_table_rows(df: DataFrame, html: str, keep: list[str], label_pattern: str = r"產業別[:：]\s*(\S+)") -> DataFrame:
    """Every table row as an array of cell texts, with the last section label seen.

    The label is carried forward inside the page's own row: no shuffle.
    """
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))

    def cells(row):
        found = F.regexp_extract_all(row, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), F.lit(1))
        return F.transform(found, clean_text)

    staged = once(df, keep, _rows=F.transform(rows, cells))
    labels = F.transform("_rows", lambda r: F.regexp_extract(F.array_join(r, " "), label_pattern, 1))
    carried = F.aggregate(
        labels, F.array().cast("array<string>"),
        lambda acc, x: F.array_append(acc, F.when(x != "", x).otherwise(
            F.coalesce(F.get(acc, F.size(acc) - 1), F.lit("")))))
    zipped = F.arrays_zip(carried.alias("section"), F.col("_rows").alias("cells"))
    return (staged.select(*keep, F.posexplode(zipped).alias("position", "_z"))
            .select(*keep, "position", "_z.section", "_z.cells"))


def html_links_with_context(df: DataFrame, html: str, keep: list[str], link_pattern: str,
                            id_group: int, text_group: int, context_pattern: str,
                            reach: int | None = None) -> DataFrame:
    """Links matching a pattern, with the nearest context text before each.

    The page is cut at its links, so a link's context is the last match in the
    text since the page start (or in the last `reach` characters before it).
    The first link of each id stands.
    """
    links = F.regexp_extract_all(F.col(html), F.lit(link_pattern), F.lit(0))
    pick = lambda g: F.regexp_extract_all(F.col(html), F.lit(link_pattern), F.lit(g))
    gaps = F.split(F.col(html), link_pattern, -1)
    staged = once(df, keep, _l=links, _i=pick(id_group), _t=pick(text_group), _g=gaps)

    def context(gap, before):
        found = F.regexp_extract_all(clean_text(gap), F.lit(context_pattern), F.lit(0))
        return F.when(F.size(found) > 0, F.element_at(found, -1)).otherwise(before)

    # Without `reach` the last context seen is carried on; with it only the
    # link's own stretch of text is read.
    seen = F.aggregate(
        F.slice("_g", 1, F.size("_l")), F.array().cast("array<string>"),
        lambda acc, g: F.array_append(acc, context(
            g if reach is None else F.right(g, F.lit(reach)),
            F.coalesce(F.get(acc, F.size(acc) - 1), F.lit("")) if reach is None else F.lit(""))))
    zipped = F.arrays_zip(F.col("_i").alias("id"), F.col("_t").alias("text"), seen.alias("context"))
    rows = (staged.select(*keep, F.posexplode(zipped).alias("position", "_z"))
            .select(*keep, "position", "_z.id", F.col("_z.text").alias("_t"), "_z.context"))
    rows = once(rows, [*keep, "position", "id", "context"], text=clean_text(F.col("_t"))).where(F.col("text") != "")
    return (rows.groupBy(*keep, "id").agg(F.min(F.struct("position", "text", "context")).alias("_f"))
            .select(*keep, "id", "_f.*"))


class Said(NamedTuple):
    """A wording and what stands behind it: a 'date', a 'number', a 'large number', a number 'past the colon' of a phrase that
    names `also`, or a 'phrase' that ends in `also`. With kind 'date before' the date and the word `also` stand before it."""
    wording: str
    kind: str
    also: str = ""


_CURRENCIES = ["gbp", "gbx", "pence"]


def _near(text: Column, low: Column, said: Said) -> Column:
    """The words behind the first place of a wording (or before it); a phrase is one word. NULL if the wording is not there."""
    place = F.locate(said.wording.lower(), low)
    if said.kind == "date before":
        return F.when(place > 0, F.split(F.trim(F.substring(text, F.greatest(place - 40, F.lit(1)), F.least(place - 1, F.lit(40)))), r"\s+"))
    behind = F.substring(text, place + len(said.wording), F.lit(160))
    words = F.array(behind) if said.kind == "phrase" else F.split(F.ltrim(behind, F.lit(" :")), r"[\s:]+")
    if said.kind == "past the colon":
        words = F.when(F.contains(F.lower(F.substring_index(behind, ":", 1)), F.lit(said.also)),
                       F.split(F.trim(F.element_at(F.split(behind, ":", 2), 2)), r"\s+"))
    return F.when(place > 0, words)


def _value(words: Column, said: Said) -> Column:
    """What stands there, if it fits; else NULL."""
    if said.kind == "date before":
        day, month, year = (F.get(words, F.size(words) - n) for n in (3, 2, 1))
        good = (F.lower(F.get(words, F.size(words) - 4)) == said.also) & _date_like(day, month, year)
        return F.when(good, F.concat_ws(" ", day, month, year))
    if said.kind == "phrase":
        text = F.get(words, F.lit(0))
        end = F.locate(said.also, F.lower(text))
        return F.when(end.between(1, 82), F.trim(F.substring(text, F.lit(1), end - 1 + len(said.also))))
    if said.kind == "date":
        day, month, year = (F.get(words, F.lit(n)) for n in range(3))
        year = F.substring(year, 1, 4)
        return F.when(_date_like(day, month, year), F.concat_ws(" ", day, month, year))
    if said.kind == "large number":
        return F.get(F.filter(F.transform(words, _leading_number), lambda n: F.length(n) >= 7), F.lit(0))
    first = F.get(words, F.lit(0))
    return _leading_number(F.when(F.lower(first).isin(_CURRENCIES), F.get(words, F.lit(1))).otherwise(first))


def _date_like(day: Column, month: Column, year: Column) -> Column:
    return day.rlike("^[0-9]{1,2}$") & month.rlike(r"^\w+$") & year.rlike("^[0-9]{4}$")


def _leading_number(word: Column) -> Column:
    """The number a word begins with, without a full stop that ends a sentence; NULL if it begins with something else."""
    return F.nullif(F.rtrim(F.regexp_extract(word, "^[0-9][0-9,.]*", 0), F.lit(".,")), F.lit(""))


def text_field_extract(df: DataFrame, text: Column, fields: dict[str, list[Said]], keep: list[str]) -> DataFrame:
    """Fields of a notice, each by the first of its wordings that the text has with a fitting value.

    The text is cleaned once for all fields, and what stands at a wording is looked up once. Thousands commas go; a field no
    wording gives stays blank.
    """
    said = list(dict.fromkeys(s for listed in fields.values() for s in listed))
    rows = once(df, keep, _text=clean_text(text))
    rows = once(rows, [*keep, "_text"], _low=F.lower("_text"))
    rows = once(rows, keep, **{f"_near{i}": _near(F.col("_text"), F.col("_low"), s) for i, s in enumerate(said)})

    def value(listed):
        found = F.coalesce(*[_value(F.col(f"_near{said.index(s)}"), s) for s in listed])
        return F.coalesce(F.trim(F.replace(found, F.lit(","), F.lit(""))), F.lit(""))

    return rows.select(*keep, *[value(listed).alias(name) for name, listed in fields.items()])


# The wordings of own-share transaction notices.
OWN_SHARE_PATTERNS = {
    "trade_date": [Said("Date of transaction", "date"), Said("Date of purchase", "date"), Said("it purchased", "date before", "on")],
    "shares": [Said("Number of shares purchased", "number"), Said("Number of ordinary shares purchased", "number"),
               Said("Number of shares repurchased", "number"), Said("Number of ordinary shares repurchased", "number"),
               Said("Aggregate number of", "past the colon", "shares")],
    "avg_price_gbp_pence": [Said("Average price paid per share", "number")],
    "low_pence": [Said("Lowest price paid per share", "number")],
    "high_pence": [Said("Highest price paid per share", "number")],
    "shares_in_issue": [Said("ordinary shares in issue will be", "number"), Said("shares in issue", "large number")],
    "programme": [Said("pursuant to its", "phrase", "programme"), Said("pursuant to the", "phrase", "programme")],
}
