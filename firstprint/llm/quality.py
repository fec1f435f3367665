"""Quality rules: plain counts of a text, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed word n-grams (of the orders given) are counted: one over every text of the raw corpus, one over
trusted texts. The ratio of a text is the sum over its n-grams of ln(p_trusted / p_raw) divided by their number, so
texts of any length are measured alike. The trusted counts are smoothed towards the raw ones, so that a bucket the
trusted texts never show costs at most ln(prior / (trusted + prior)), and with no trusted texts every ratio is 0.

The weight of a bucket is kept in whole millionths. Sums of whole numbers do not depend on the order in which Spark adds
them, so the verdict on a document is the same on every run, and in SQL.

Everything is DataFrame functions. The corpus is read once for the counts, which are added up per bucket before the
shuffle (at most BUCKETS rows from a task), and once for the verdicts, which are expressions of the row: no shuffle.
What travels to the driver is one number for each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firstprint.functions.staging import once
from firstprint.llm.texts import white_words
from firstprint.session import materialize

ORDERS = (1, 2)
BUCKETS = 10_000
PRIOR = 10_000
LEAST_RATIO = -0.07
LEAST_WORDS = 50


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of the labelled documents of quality 1."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def grams(words: Column, orders: tuple[int, ...] = ORDERS) -> Column:
    """The word n-grams of each order, as text."""
    def of(order: int) -> Column:
        starts = F.slice(words, 1, F.greatest(F.size(words) - (order - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.concat_ws(" ", x, *[F.get(words, i + j) for j in range(1, order)]))
    return F.concat(*[words if n == 1 else of(n) for n in orders])


def bucket(gram: Column, buckets: int = BUCKETS) -> Column:
    return F.crc32(gram.cast("binary")) % buckets


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS,
                orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """(bucket, raw, trusted): counts over every text, and over the texts of the trusted ids.

    `trusted` has distinct ids and grows with the corpus, so it is joined by merge at every size: the texts are shuffled
    once, and AQE splits an id that many rows share. Rows without a doc_id are trusted by nobody and stay out of the join,
    where they would all meet in one task. The n-grams that begin at a word are made as the row of that word is, without
    an array of them.
    """
    named = docs.select("doc_id", "text").where("doc_id is not null")
    trusted = trusted.withColumn("is_trusted", F.lit(1)).hint("merge")
    marked = named.join(trusted, "doc_id", "left").select("text", "is_trusted").unionAll(
        docs.where("doc_id is null").select("text", F.lit(None).cast("int").alias("is_trusted")))
    words = once(marked, [F.coalesce("is_trusted", F.lit(0)).alias("is_trusted")], w=white_words(F.col("text")))
    each = words.select("is_trusted", "w", F.posexplode("w").alias("i", "word"))
    begun = [F.concat("word", *[x for k in range(1, n) for x in (F.lit(" "), F.get("w", F.col("i") + k))]) for n in orders]
    found = each.select("is_trusted", F.explode(F.array(*[bucket(g, buckets) for g in begun])).alias("bucket"))
    return found.where("bucket is not null").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.sum("is_trusted").cast("bigint").alias("trusted"))


def weights(counts: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> list[int]:
    """Whole millionths of ln(p_trusted / p_raw) for each bucket; 0 where the corpus has none. `counts` is read twice."""
    sums = counts.agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).first()
    share = F.col("trusted") * F.lit(float(sums["raw"] or 0)) / F.col("raw") + F.lit(float(prior))
    ratio = F.log(share / F.lit(float(sums["trusted"] or 0) + float(prior)))
    rows = counts.select("bucket", F.round(ratio * 1_000_000).cast("bigint").alias("weight"))
    found = {r.bucket: r.weight for r in rows.collect()}
    return [found.get(b, 0) for b in range(buckets)]


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    """The plain counts of a text, given its words."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {"n_words": F.size(words).cast("bigint"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("bigint"),
            "n_symbols": F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("bigint"),
            "lines": lines}


def verdicts(docs: DataFrame, weight_list: list[int], buckets: int = BUCKETS,
             least_ratio: float = LEAST_RATIO, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """Every column of `docs` under `doc`, with the counts, the ratio and the verdict of each row.

    A null or empty text has no words and fails the base rules; a text of any length is read whole; equal texts get
    equal verdicts; columns of `docs` other than text are only carried.
    """
    rows = once(docs.select(F.struct("*").alias("doc")), ["doc"], words=white_words(F.col("doc.text")))
    triples = F.transform("words", lambda x, i: F.xxhash64(x, F.get("words", i + 1), F.get("words", i + 2)))
    # One literal: Spark folds the split and the cast of a constant while planning.
    table = F.split(F.lit(",".join(map(str, weight_list))), ",").cast("array<bigint>")
    score = F.aggregate(grams(F.col("words"), orders), F.lit(0).cast("bigint"),
                        lambda total, g: total + F.get(table, bucket(g, buckets).cast("int")))
    n_grams = F.lit(0).cast("bigint")
    for order in orders:
        n_grams = n_grams + F.greatest(F.size("words") - (order - 1), F.lit(0))
    rows = once(rows, ["doc"], score=score, n_grams=n_grams, **base_columns(F.col("doc.text"), F.col("words")),
                triples=F.slice(triples, 1, F.greatest(F.size("words") - 2, F.lit(0))))
    rows = rows.withColumn("ordered", F.when(
        F.size(F.array_distinct("triples")) < F.size("triples"),
        F.sort_array(F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    rows = once(rows, ["doc", "score", "n_grams", "n_words", "word_chars", "n_symbols"],
                n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"), ordered=F.col("ordered"))
    twice = F.filter("ordered", lambda x, k: (x["h"] == F.get("ordered", k - 1)["h"])
                     | (x["h"] == F.get("ordered", k + 1)["h"]))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    rows = once(rows, ["doc", "score", "n_grams", "n_words", "word_chars", "n_symbols", "n_dup_lines"],
                n_repeat_words=F.coalesce(F.size(covered), F.lit(0)).cast("bigint"))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    clears = F.col("score") >= F.lit(round(least_ratio * 1_000_000)) * F.col("n_grams")
    ratio = F.when(F.col("n_grams") > 0, F.col("score") / 1e6 / F.col("n_grams"))
    return rows.select("doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base_failed.alias("base_failed"), ratio.alias("ratio"), (~base_failed & clears).alias("kept"))


def quality_rules(docs: DataFrame, raw: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                  least_ratio: float = LEAST_RATIO, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """Verdicts on `docs`, with multinomials of the raw corpus and its trusted documents."""
    counts, _ = materialize(gram_counts(raw, trusted_ids(labels), buckets, orders), "gram-counts")
    return verdicts(docs, weights(counts, buckets), buckets, least_ratio, orders)
