"""Months, weeks, published windows and business days as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .fixed_values import MONTH_ABBREVIATIONS, STAGE_WORDS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- Months -------------------------------------------------------------------

def roc_month(text) -> Column:
    """'115/07', '11507' or '115-7' style Minguo month as '2026-07'."""
    digits = F.regexp_replace(_col(text), r"\D", "")
    year = F.left(digits, F.length(digits) - 2)
    month = F.right(digits, F.lit(2))
    iso = F.concat_ws("-", F.lpad((year.try_cast("int") + 1911).cast("string"), 4, "0"), month)
    return F.when(F.length(digits) >= 4, iso)


def to_roc_month(month) -> Column:
    """'2026-07' as '115/07'."""
    year = F.substring(_col(month), 1, 4).cast("int") - 1911
    return F.concat_ws("/", year.cast("string"), F.substring(_col(month), 6, 2))


def month_range(start, end) -> Column:
    """Inclusive array of month starts; empty when the end is before the start."""
    first, last = F.trunc(_col(start), "month"), F.trunc(_col(end), "month")
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>"))


def year_ago(month) -> Column:
    return F.add_months(_col(month), -12)


def month_text(date) -> Column:
    return F.date_format(_col(date), "yyyy-MM")


def iso(date) -> Column:
    return F.date_format(_col(date), "yyyy-MM-dd")


# --- Published windows ----------------------------------------------------------
#
# Labels are read token by token: numbers, words, and every other sign by itself. White space only separates.

_RANGE_SIGNS, _DATE_SIGNS = ["-", "–", "∼", "~"], [".", "/"]


def tokens(text) -> Column:
    """The numbers, words and single signs of a text, in order; none for a null."""
    found = F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(r"[0-9]+|\p{L}+|\S"), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _is_number(token: Column) -> Column:
    return F.substring(token, 1, 1).between("0", "9")


def _fold(text, start: dict[str, Column], step) -> Column:
    """The state after all tokens of a text; `step(state, token)` gives the fields of the next state."""
    names = list(start)
    return F.aggregate(tokens(text), F.struct(*[start[n].alias(n) for n in names]),
                       lambda state, token: F.struct(*[c.alias(n) for n, c in zip(names, step(state, token))]))


def _window_of_day(day: Column, full: str) -> Column:
    return (F.when(day == 10, "D10").when(day == 20, "D20").when(day >= 28, full).otherwise(""))


def classify_window(label, full: str = "FULL") -> Column:
    """Window named by the last day of a range label; '' when it names none.

    A range sign opens the end of the range. Numbers joined by date signs go on with it, and the last of them is its day,
    which a day mark may follow. Anything else means that the label does not end in a date.
    """
    def step(state, token):
        opens, joint, number = token.isin(_RANGE_SIGNS), token.isin(_DATE_SIGNS), _is_number(token)
        goes_on = F.when(number, (state["day"] == "") | state["joined"]).when(joint, (state["day"] != "") & ~state["joined"]).otherwise(token == "일")
        return (opens | (state["open"] & goes_on), ~opens & joint,
                F.when(opens, "").when(number, token).otherwise(state["day"]))

    end = _fold(label, {"open": F.lit(False), "joined": F.lit(False), "day": F.lit("")}, step)
    is_day = end["open"] & ~end["joined"] & F.length(end["day"]).between(1, 2)
    return F.when(is_day, _window_of_day(end["day"].try_cast("int"), full)).otherwise("")


def english_window(label, retrieved, full: str = "FULL") -> Column:
    """('month', 'window') of a label such as 'Aug.1~Aug.10', which has no year.

    The year is the retrieval year, or the one before when the label's month is
    still ahead of the retrieval month. A word before a number is a month; the
    first number behind the range sign is the last day, and ends the label.
    """
    def step(state, token):
        read = state["last"] != ""
        number, word = _is_number(token), F.length(token).between(3, 9) & token.rlike("^[A-Za-z]+$")
        ranged = state["ranged"] | (token.isin(_RANGE_SIGNS) & (state["first"] != ""))
        return (F.when(~read & word, F.lower(F.substring(token, 1, 3))).otherwise(state["name"]),
                F.when(~state["ranged"] & number & (state["name"] != ""), token).otherwise(state["first"]), ranged,
                F.when(~read & state["ranged"] & number, token).otherwise(state["last"]))

    blank = F.lit("")
    end = _fold(label, {"name": blank, "first": blank, "ranged": F.lit(False), "last": blank}, step)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTH_ABBREVIATIONS]), end["name"])
    year = F.year(_col(retrieved)) - F.when(month > F.month(_col(retrieved)), 1).otherwise(0)
    known = (month > 0) & (end["last"] != "")
    return F.struct(
        F.when(known, F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0")))
        .otherwise("").alias("month"),
        F.when(known, _window_of_day(end["last"].try_cast("int"), full)).otherwise("").alias("window"))


def find_month(*texts) -> Column:
    """First month from 2000 on that is written in any of the texts, looked at in order.

    A month is a number that begins with its four-digit year and two-digit month, or the year alone and, behind a date sign
    or a hyphen, a number that begins with the month.
    """
    def months(text):
        words = tokens(text)

        def of(token, i):
            apart = (F.length(token) == 4) & F.get(words, i + 1).isin([*_DATE_SIGNS, "-"])
            month = F.when(F.length(token) >= 6, F.substring(token, 5, 2)).when(apart, F.substring(F.get(words, i + 2), 1, 2))
            good = _is_number(token) & F.startswith(token, F.lit("20")) & (F.length(month) == 2) & month.try_cast("int").between(1, 12)
            return F.when(good, F.concat_ws("-", F.substring(token, 1, 4), month))

        return F.get(F.array_compact(F.transform(words, of)), F.lit(0))

    return F.coalesce(*[months(t) for t in texts], F.lit(""))


def stage_word(text) -> Column:
    """Strongest release stage a text names; '' when it names none."""
    return F.coalesce(*[F.when(F.contains(_col(text), F.lit(word)), stage)
                        for word, stage in STAGE_WORDS], F.lit(""))


def stage_spans(title) -> Column:
    """Array of (month, stage) from spans such as '1-6月：確報、7月：9桁速報'.

    Commas and closing brackets end a span, a colon parts its months from its stage. The months end in the word for month,
    behind one number or two with a range sign between them. Where two spans name the same month the later one in the title
    stands.
    """
    spans = F.split(F.translate(F.coalesce(_col(title), F.lit("")), "、）)：", ",,,:"), ",")
    spans = F.filter(spans, lambda span: F.contains(span, F.lit(":")))
    # Each step is a transform of its own, so that what the next one mentions twice is worked out once.
    cut = F.transform(spans, lambda span: F.named_struct(
        F.lit("months"), F.substring_index(span, ":", 1), F.lit("label"), F.substr(span, F.locate(":", span) + 1)))
    read = F.transform(cut, lambda x: F.named_struct(
        F.lit("back"), F.reverse(F.regexp_extract_all(x["months"], F.lit(r"[0-9]+|\S"), F.lit(0))),
        F.lit("stage"), stage_word(x["label"])))
    read = F.filter(read, lambda x: x["stage"] != "")

    def ends(x):
        from_end = lambda n: F.get(x["back"], F.lit(n - 1))
        number = lambda token: F.when(F.length(token) <= 2, token.try_cast("int"))
        return F.named_struct(F.lit("last"), F.when(from_end(1) == "月", number(from_end(2))),
                              F.lit("first"), F.when(from_end(3).isin("～", "-"), number(from_end(4))), F.lit("stage"), x["stage"])

    def put_before(held, x):
        first = F.coalesce(x["first"], x["last"])
        listed = F.when(first <= x["last"], F.sequence(first, x["last"])).otherwise(F.array().cast("array<int>"))
        fresh = F.array_except(listed, held["month"])
        return F.flatten(F.array(F.transform(fresh, lambda m: F.named_struct(F.lit("month"), m, F.lit("stage"), x["stage"])), held))

    # A month appears where its last span puts it. The spans are taken from the last to the first, and each puts the months
    # that no later one has before those held, a hundred at most: nothing is worked out again for every month of a title.
    return F.aggregate(F.reverse(F.transform(read, ends)), F.array().cast("array<struct<month:int,stage:string>>"), put_before)


# --- Weeks ------------------------------------------------------------------------

def week_ending_sunday(date) -> Column:
    """Sunday that closes the date's Monday-to-Sunday week."""
    return F.date_add(_col(date), 6 - F.weekday(_col(date)))


def week_start_sunday(date) -> Column:
    """Sunday that opens the date's Sunday-to-Saturday week."""
    return F.date_sub(_col(date), F.pmod(F.weekday(_col(date)) + 1, F.lit(7)))


def friday_label(date) -> Column:
    """Friday on or after the date, so a weekend belongs to the next Friday."""
    return F.date_add(_col(date), F.pmod(4 - F.weekday(_col(date)), F.lit(7)))


def _weekdays_through(date: Column) -> Column:
    """Weekdays from a fixed Monday through the date, in closed form."""
    days = F.unix_date(date) + 3
    return F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)) + 1, F.lit(5))


def business_days_between(after, through) -> Column:
    """Weekdays strictly after the first date, up to and including the second."""
    a, b = _col(after), _col(through)
    return F.when(b > a, _weekdays_through(b) - _weekdays_through(a)).otherwise(F.lit(0)).cast("bigint")


# --- Dates ------------------------------------------------------------------------

def parse_any_date(text) -> Column:
    """Date from the layouts fund archives use, tried in a fixed order."""
    t = F.trim(_col(text))
    serial = F.when(t.rlike(r"^\d{5}(\.0+)?$"),
                    F.date_add(F.lit("1899-12-30").cast("date"),
                               F.regexp_extract(t, r"^(\d{5})", 1).try_cast("int")))
    layouts = [(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
               (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy"),
               (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
               (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
               (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy")]
    named = [_title_month(t), _title_month(t), t, t, t]
    tries = [F.when(t.rlike(shape), F.try_to_date(c, layout)) for c, (shape, layout) in zip(named, layouts)]
    # Two-digit years 69 to 99 belong to the last century.
    tries[1] = F.when(F.year(tries[1]) >= 2069, F.add_months(tries[1], -1200)).otherwise(tries[1])
    return F.coalesce(serial, *tries)


def document_date(text) -> Column:
    """Date at the head of a filing stamp: ISO, compact or '4 Aug 2026'."""
    t = F.trim(_col(text))
    dmy = F.regexp_extract(t, r"^(\d{1,2} [A-Z][a-z]{2} \d{4})", 1)
    return F.coalesce(
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")),
        F.when(t.rlike(r"^\d{8}"), F.try_to_date(F.substring(t, 1, 8), "yyyyMMdd")),
        F.when(dmy != "", F.try_to_date(dmy, "d MMM yyyy")))


def _title_month(t: Column) -> Column:
    """'01-AUG-2026' as '01-Aug-2026', the only case the parser accepts."""
    return F.concat(F.regexp_extract(t, r"^([^A-Za-z]*)", 1),
                    F.initcap(F.regexp_extract(t, r"^[^A-Za-z]*([A-Za-z]*)", 1)),
                    F.regexp_extract(t, r"^[^A-Za-z]*[A-Za-z]*(.*)$", 1))


def local_date(utc_timestamp, zone: str = "America/New_York") -> Column:
    """Calendar date of a UTC time in another zone."""
    return F.to_date(F.from_utc_timestamp(_col(utc_timestamp), zone))


def rfc822_timestamp(text) -> Column:
    """UTC timestamp of 'Mon, 21 Sep 2026 03:30:00 GMT' or '... +0900'."""
    body = F.regexp_replace(F.trim(_col(text)), r"^[A-Za-z]{3},\s*", "")
    body = F.regexp_replace(body, r"\s(GMT|UTC|UT|Z)$", " +0000")
    return F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss xx"))
