"""JSON payload shapes. Each parser works inside the payload's own row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firstprint.sources.fields import first_present_key, map_json
from firstprint.functions.numbers import parse_number
from firstprint.functions.staging import once


def json_records(df: DataFrame, body: str, fields: list[str], keep: list[str] = ()) -> DataFrame:
    """Array of flat objects to rows; any other shape is an error, not zero rows."""
    record = ", ".join(f"`{f}` string" for f in fields)
    is_list = F.startswith(F.ltrim(F.col(body)), F.lit("["))
    parsed = F.from_json(F.col(body), f"array<struct<{record.replace('` string', '`: string')}>>")
    checked = F.when(is_list & parsed.isNotNull(), parsed).otherwise(_fail("unexpected response shape: ", body))
    return df.select(*keep, F.posexplode(checked).alias("position", "_r")).select(*keep, "position", "_r.*")


def _fail(message: str, body: str) -> Column:
    return F.raise_error(F.concat(F.lit(message), F.left(F.col(body), F.lit(300))))


def status_records(df: DataFrame, body: str, list_field: str, fields: list[str], keep: list[str] = (),
                   ok: str = "000", empty: str = "013") -> DataFrame:
    """Records inside a status envelope; 'no data' is empty, other codes raise."""
    record = ", ".join(f"`{f}`: string" for f in fields)
    parsed = F.from_json(F.col(body), f"struct<status: string, message: string, `{list_field}`: array<struct<{record}>>>")
    staged = df.select(*keep, F.col(body), parsed.alias("_p"))
    none = F.array().cast(f"array<struct<{record}>>")
    rows = (F.when(F.col("_p.status") == ok, F.coalesce(F.col(f"_p.{list_field}"), none))
            .when(F.col("_p.status") == empty, none).otherwise(_fail("error status: ", body)))
    return staged.select(*keep, F.posexplode(rows).alias("position", "_r")).select(*keep, "position", "_r.*")


def header_rows(df: DataFrame, body: str, keep: list[str] = ()) -> DataFrame:
    """Array of arrays whose first row is the header, as rows of a field map.

    Of columns with the same name the last one stands.
    """
    table = F.from_json(F.col(body), "array<array<string>>")
    staged = once(df, keep, _t=table)
    head = F.get("_t", F.lit(0))

    def last_of_name(names):
        """The places whose name does not come again."""
        return F.filter(F.sequence(F.lit(0), F.greatest(F.size(names), F.lit(1)) - 1), lambda i: (i < F.size(names)) & ~F.array_contains(
            F.slice(names, i + 2, F.size(names)), F.get(names, i)))

    # The header is read once for a payload; only a row that is shorter has to look for itself.
    staged = once(staged, [*keep, "_t"], _head=head)
    staged = once(staged, [*keep, "_t", "_head"], _places=last_of_name(F.col("_head")))
    staged = once(staged, [*keep, "_t", "_head", "_places"], _names=F.transform("_places", lambda i: F.get("_head", i)))

    def as_map(row):
        values = lambda places: F.transform(places, lambda i: F.coalesce(F.get(row, i), F.lit("")))
        short = last_of_name(F.slice("_head", 1, F.size(row)))
        return F.when(F.size(row) >= F.size("_head"), F.map_from_arrays("_names", values(F.col("_places")))).otherwise(
            F.map_from_arrays(F.transform(short, lambda i: F.get("_head", i)), values(short)))

    body_rows = F.transform(F.slice("_t", 2, F.size("_t")), as_map)
    return staged.select(*keep, F.posexplode(body_rows).alias("position", "fields"))


def trade_records(rows: DataFrame, code: str, value: list[str], quantity: list[str],
                  keep: list[str] = ()) -> DataFrame:
    """Partner rows of a header-row payload; rows without a trade carry nothing.

    extra_json holds the whole record; a query that does not use it does not build it.
    """
    f = F.col("fields")
    out = once(rows, [*keep, "position", "fields"], cty_code=first_present_key(f, [code]),
               _value=first_present_key(f, value), _qty1=first_present_key(f, quantity))
    out = once(out, [*keep, "position", "fields", "cty_code"], value=parse_number(F.col("_value")), qty1=parse_number(F.col("_qty1")))
    out = out.select(*keep, "position", "cty_code", "value", "qty1", map_json(f).alias("extra_json"))
    traded = (F.col("value") != 0) | (F.coalesce(F.col("qty1"), F.lit(0.0)) != 0)
    return out.where((F.col("cty_code") != "") & F.col("value").isNotNull() & traded)


def parallel_arrays(df: DataFrame, body: str, keep: list[str] = ()) -> DataFrame:
    """Chart payload: stamps zipped with closes, in the exchange's local date.

    A day without a close is dropped; adjusted closes default to plain ones.
    """
    schema = ("chart struct<result: array<struct<meta: struct<gmtoffset: bigint>, timestamp: array<bigint>, "
              "indicators: struct<quote: array<struct<close: array<double>>>, "
              "adjclose: array<struct<adjclose: array<double>>>>>>>")
    first = F.get(F.from_json(F.col(body), schema)["chart"]["result"], F.lit(0))
    staged = once(df, keep, _c=first)
    close = F.get(F.col("_c.indicators.quote"), F.lit(0))["close"]
    adjusted = F.coalesce(F.get(F.col("_c.indicators.adjclose"), F.lit(0))["adjclose"], close)
    zipped = F.arrays_zip(F.col("_c.timestamp").alias("ts"), close.alias("close"), adjusted.alias("adj"))
    shift = F.coalesce(F.col("_c.meta.gmtoffset"), F.lit(0))
    rows = staged.select(*keep, shift.alias("_o"), F.explode(zipped).alias("_z"))
    both = F.col("_z.ts").isNotNull() & F.col("_z.close").isNotNull() & F.col("_z.adj").isNotNull()
    return rows.where(both).select(
        *keep, F.to_date(F.timestamp_seconds(F.col("_z.ts") + F.col("_o"))).alias("date"),
        F.round("_z.close", 4).alias("close"), F.round("_z.adj", 4).alias("adj_close"))


def date_map(df: DataFrame, body: str, quotes: list[str], keep: list[str] = (),
             field: str = "rates") -> DataFrame:
    """{date: {quote: rate}} to rows; wanted quotes and positive rates only."""
    rates = F.from_json(F.col(body), f"`{field}` map<string, map<string, string>>")[field]
    days = df.select(*keep, F.explode(rates).alias("date", "_m"))
    rows = days.select(*keep, "date", F.explode("_m").alias("_q", "_r"))
    return (once(rows, [*keep, "date"], quote=F.upper("_q"), rate=F.col("_r").try_cast("double"))
            .where(F.col("quote").isin([q.upper() for q in quotes]) & (F.col("rate") > 0)))
