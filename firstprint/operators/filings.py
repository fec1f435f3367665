"""Company filings: watched entities, freshness, buyback pace and the digest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firstprint.functions.fixed_values import DOC_TYPE_TOPICS
from firstprint.functions.periods import business_days_between, document_date
from firstprint.operators.growth import top_n_per_group
from firstprint.operators.store import read_store

STALE_DAYS = 10


def entity_any_id(docs: DataFrame, doc: str, code: str, ids: list[str], watch: DataFrame,
                  watch_code: str = "code", watch_id: str = "entity_id") -> DataFrame:
    """Watched filings: matched by security code, else by any of several ids.

    Ids become rows so that both ways are one equality join; the code match
    outranks the id match, and of several id matches the smallest code stands.
    """
    names = [c for c in watch.columns if c != watch_id]
    entity = F.struct(*names)
    keyed = watch.select(
        F.explode(F.array_compact(F.array(
            F.struct(F.lit(0).alias("kind"), F.col(watch_code).alias("key")),
            F.when(F.coalesce(F.col(watch_id), F.lit("")) != "",
                   F.struct(F.lit(1).alias("kind"), F.col(watch_id).alias("key")))))).alias("_k"),
        entity.alias("_e")).select("_k.kind", "_k.key", "_e")
    keys = F.array(F.struct(F.lit(0).alias("kind"), F.col(code).alias("key")),
                   *[F.struct(F.lit(1).alias("kind"), F.col(c).alias("key")) for c in ids])
    wanted = docs.select(doc, F.explode(keys).alias("_k")).select(doc, "_k.kind", "_k.key")
    best = (wanted.join(keyed, ["kind", "key"]).groupBy(doc)
            .agg(F.min_by("_e", F.struct("kind", f"_e.{watch_code}")).alias("_e")))
    return docs.join(best, doc).select("*", *[F.col(f"_e.{n}").alias(f"entity_{n}") for n in names]).drop("_e")


def doc_type_topics(topics: Column, doc_type: Column, implied=DOC_TYPE_TOPICS) -> Column:
    """Topics found in the text plus the one the filing type implies."""
    implied_topic = F.coalesce(*[F.when(doc_type == c, t) for c, t in implied.items()])
    return F.when(implied_topic.isNotNull(), F.array_union(topics, F.array(implied_topic))).otherwise(topics)


def freshness(date_text, today, days: int = STALE_DAYS) -> Column:
    """'news' or 'history'; a stamp that cannot be read counts as today."""
    day = F.coalesce(document_date(date_text), today)
    return F.when(day >= F.date_sub(today, days), "news").otherwise("history")


def new_since(df: DataFrame, seen: str, since) -> DataFrame:
    """Rows first seen at or after the watermark."""
    return df.where(F.col(seen) >= since)


def stored_watermark(spark: SparkSession, path: str):
    """The last value that was finished, NULL before the first one. Finished values are appended, so a lost write loses none."""
    marks = read_store(spark, path)
    return None if marks is None else marks.agg(F.max("finished")).first()[0]


def work_since(df: DataFrame, seen: str, path: str, work: Callable[[DataFrame], None]) -> DataFrame:
    """Work on the rows seen at or after the stored watermark, then store the newest value seen as the next one.

    The value itself is read again the next time, as rows of that day may still come: `work` must take rows it has had
    before, as append_dedup does. The watermark is written only after `work` has ended well, so a run that fails moves
    nothing, and the next one starts where the last good one ended. Rows without a value have no place in time and are
    left out. Without new rows nothing is written. Returns the rows that were worked on.
    """
    spark = df.sparkSession
    last = stored_watermark(spark, path)
    rows = df.where(F.col(seen).isNotNull()) if last is None else new_since(df, seen, F.lit(last))
    newest = rows.agg(F.max(seen).alias("finished"))  # fixed before the work: what arrives meanwhile is for the next run
    reached = newest.first()["finished"]
    if reached is None:
        return rows
    rows = rows.where(F.col(seen) <= F.lit(reached))
    work(rows)
    spark.createDataFrame([(reached,)], newest.schema).coalesce(1).write.mode("append").parquet(path)
    return rows


def last_n_vwap(trades: DataFrame, keys: list[str], date: str, shares: str, pence: str,
                today, n: int = 5, ties: list[str] = ()) -> DataFrame:
    """Pace of the latest n trades: shares, money, mean price, days since."""
    order = [F.desc(date), F.desc(shares), F.desc(pence), *[F.desc(t) for t in ties]]
    recent = top_n_per_group(trades.where(F.col(date).isNotNull() & F.col(shares).isNotNull()),
                             keys, order, n)
    paid = F.col(shares) * F.coalesce(F.col(pence), F.lit(0.0))
    out = recent.groupBy(*keys).agg(
        F.max(date).alias("last_trade"), F.count(F.lit(1)).alias("days"),
        F.sum(shares).alias("shares"), (F.sum(paid) / 100.0).alias("spend"))
    gap = business_days_between("last_trade", today)
    return (out.withColumn("avg_pence", F.coalesce(
                F.try_divide(F.col("spend") * 100.0, F.col("shares")), F.lit(0.0)))
            .withColumn("gap_days", gap).withColumn("watch", F.col("gap_days") >= 3))


def filings_digest(docs: DataFrame, keys: list[str], seen: str, since, date_text: str, today,
                   reading: str, routine: str) -> DataFrame:
    """Per company: fresh and historical filings, must-reads and routine notices."""
    new = new_since(docs, seen, since).withColumn("_age", freshness(date_text, today))
    plain = F.coalesce(F.col(routine), F.lit("")) == ""
    fresh = F.col("_age") == "news"
    return new.groupBy(*keys).agg(
        F.count_if(fresh & plain).alias("n_new"),
        F.count_if(~fresh & plain).alias("n_history"),
        F.count_if(fresh & plain & (F.col(reading) == "yes")).alias("n_must_read"),
        F.count_if(fresh & ~plain).alias("n_routine"))


def next_events(events: DataFrame, sort_by: str, today, n: int = 4, ties: list[str] = ()) -> DataFrame:
    return ordered_cap(events.where(F.col(sort_by) >= today), [F.asc(sort_by), *[F.asc(t) for t in ties]], n)


def ordered_cap(df: DataFrame, order: list, n: int) -> DataFrame:
    """First n rows of a report in a total order."""
    return df.orderBy(*order).limit(n)
