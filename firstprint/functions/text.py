"""Headline and filing-title expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from .fixed_values import TITLE_GLOSSES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- Story identity ------------------------------------------------------------

def normal_title(title) -> Column:
    """Lower-case letters and digits, single-spaced."""
    return F.trim(F.regexp_replace(F.lower(_col(title)), "[^a-z0-9]+", " "))


def story_key(title) -> Column:
    """Sixteen hex digits naming a story whatever its punctuation."""
    return F.substring(F.sha1(normal_title(title).cast("binary")), 1, 16)


def split_suffix(title, source) -> Column:
    """('title', 'outlet'): the ' - Outlet' ending split off a feed title."""
    t, s = _col(title), F.coalesce(_col(source), F.lit(""))
    tail = F.concat(F.lit(" - "), s)
    known = (s != "") & F.endswith(t, tail)
    cut = r"(?s)^(.*) - (.*)$"
    guess = (s == "") & t.contains(" - ")
    return F.struct(
        F.trim(F.when(known, F.left(t, F.length(t) - F.length(tail)))
               .when(guess, F.regexp_extract(t, cut, 1)).otherwise(t)).alias("title"),
        F.trim(F.when(guess, F.regexp_extract(t, cut, 2)).otherwise(s)).alias("outlet"))


# --- Whole-word phrases ----------------------------------------------------------

def whole_word_pattern(phrases: Iterable[str]) -> str:
    """One pattern matching any phrase with no letter or digit on either side."""
    body = "|".join(_quote(p) for p in phrases)
    return rf"(?iu)(?<![A-Za-z0-9])(?:{body})(?![A-Za-z0-9])"


def _quote(phrase: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}\-&#~])", r"\\\1", phrase)


def has_phrase(text, phrases: Iterable[str]) -> Column:
    listed = [p for p in phrases if p]
    return _col(text).rlike(whole_word_pattern(listed)) if listed else F.lit(False)


def labels_hit(text, categories: Mapping[str, Iterable[str]]) -> Column:
    """Labels, in dictionary order, with any phrase in the text."""
    marks = [F.when(has_phrase(text, words), F.lit(label)) for label, words in categories.items()]
    return F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")


def single_or_mixed(labels: Column) -> Column:
    """The only label, 'mixed' when there are several, '' when there is none."""
    return (F.when(F.size(labels) == 1, labels[0]).when(F.size(labels) > 1, "mixed").otherwise(""))


def headline_tags(title, tags: Mapping) -> Column:
    """('banks', 'direction', 'topics', 'extreme') of a headline."""
    return F.struct(
        F.array_join(labels_hit(title, tags["bank"]), ";").alias("banks"),
        single_or_mixed(labels_hit(title, tags["direction"])).alias("direction"),
        F.array_join(labels_hit(title, tags["topic"]), ";").alias("topics"),
        F.when(has_phrase(title, tags["extreme"]), "yes").otherwise("").alias("extreme"))


def is_relevant(title, outlet, required: Iterable[str], excluded_outlets: Iterable[str]) -> Column:
    excluded = list(excluded_outlets)
    kept = ~F.coalesce(_col(outlet), F.lit("")).isin(excluded) if excluded else F.lit(True)
    return kept & has_phrase(title, required)


# --- Topics and glosses ------------------------------------------------------------

def topic_tags(text, topics: Mapping[str, Iterable[str]]) -> Column:
    """Topics with any pattern inside the text; only ASCII patterns ignore case."""
    c, low = _col(text), F.lower(_col(text))

    def inside(pattern: str) -> Column:
        exact = c.contains(pattern)
        return (exact | low.contains(pattern.lower())) if pattern.isascii() else exact

    marks = []
    for topic, patterns in topics.items():
        hit = F.lit(False)
        for pattern in patterns:
            hit = hit | inside(pattern)
        marks.append(F.when(hit, F.lit(topic)))
    return F.array_compact(F.array(*marks))


def needs_reading(topics, priority: Column) -> Column:
    return F.when(F.arrays_overlap(_col(topics), priority), "yes").otherwise("")


def ordered_gloss(title, glosses=TITLE_GLOSSES) -> Column:
    """'English name (title)' by the first pattern found; plain ASCII as it is."""
    t = _col(title)
    named = F.coalesce(*[F.when(t.contains(pattern), F.concat(F.lit(f"{gloss} ("), t, F.lit(")")))
                         for pattern, gloss in glosses], t)
    return F.when(t.rlike(r"^\p{ASCII}*$"), t).otherwise(named)


# --- Markup ----------------------------------------------------------------------

def unescape(text) -> Column:
    """The character entities the scraped pages use, ampersand last."""
    out = _col(text)
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                         ("&#39;", "'"), ("&apos;", "'"), ("&pound;", "£"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def clean_text(fragment) -> Column:
    """Text of an HTML fragment: tags out, entities back, spaces squeezed."""
    bare = unescape(F.regexp_replace(_col(fragment), r"<[^>]+>", " "))
    return F.trim(F.regexp_replace(bare, r"[\s ]+", " "))


def unwrap_redirect(url, marker: str = "rd.php?") -> Column:
    """Target of a redirect link; other links as they are."""
    u = _col(url)
    at = F.instr(u, marker)
    return F.when(at > 0, F.substr(u, at + len(marker))).otherwise(u)


def dotted_code(code) -> Column:
    """Tariff code with its dots: '8517620090' as '8517.62.00.90'."""
    c = F.replace(_col(code), F.lit("."), F.lit(""))
    parts = [F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2), F.substring(c, 9, 2)]
    return F.concat_ws(".", *[F.when(p != "", p) for p in parts])
