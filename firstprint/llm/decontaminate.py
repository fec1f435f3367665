"""Benchmark decontamination by winnowing.

A window is WINDOW consecutive words of a benchmark item. The fingerprint of a window is the smallest hash of its K-word
grams, so two equal windows always have equal fingerprints: whatever shares a window with an item shares a fingerprint
with it, and neighbouring windows mostly repeat theirs. A document gives one row for each stretch of windows with the
same fingerprint (about 2 in WINDOW - K + 2 of its words). Rows whose fingerprint no item has fall away in a semi-join;
the stretches that stay are extended: each of their windows is compared, as text, with the windows of the items. A
fingerprint alone never counts as a hit.

Everything is DataFrame functions. Only ids, hashes and offsets are shuffled for the search; the text of a document is
shuffled only if one of its fingerprints is in the benchmark. The item side is written once, so that Spark knows its real
size when it chooses between broadcasting it and shuffling; nothing is broadcast by hint. No pairs of documents and items
are formed: a document's windows look up the windows of the benchmark, which are distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from firstprint.functions.staging import once
from firstprint.llm.texts import alnum_words
from firstprint.session import materialize

WINDOW = 10
K = 5


def _window_fingerprints(words: str, window: int, k: int) -> tuple[Column, Column]:
    """K-gram hashes of a word array column, and their minimum in each window (of the array column `grams`)."""
    grams = F.transform(words, lambda x, i: F.xxhash64(x, *[F.get(words, i + j) for j in range(1, k)]))
    per_window = window - k + 1
    minima = F.transform(F.slice("grams", 1, F.greatest(F.size("grams") - (window - 1), F.lit(0))),
                         lambda x, i: F.least(x, *[F.get("grams", i + j) for j in range(1, per_window)]))
    return grams, minima


def _spoken(words: Column, start: Column, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def item_windows(items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(size, fingerprint, spoken, item_ids): the distinct windows of the items, with the items that have each."""
    rows = once(items.where("item_id is not null").select("item_id", "text"), ["item_id"], w=alnum_words(F.col("text")))
    rows = rows.where(F.size("w") > 0)
    grams, minima = _window_fingerprints("w", window, k)
    long = once(rows.where(F.size("w") >= window), ["item_id", "w"], grams=grams)
    long = long.select("item_id", F.lit(window).alias("size"), "w", F.posexplode(minima).alias("start", "fingerprint"))
    long = long.select("item_id", "size", "fingerprint", _spoken(F.col("w"), F.col("start"), window).alias("spoken"))
    short = rows.where(F.size("w") < window).select("item_id", F.size("w").alias("size"), F.array_join("w", " ").alias("spoken"))
    short = short.select("item_id", "size", F.xxhash64("spoken").alias("fingerprint"), "spoken")
    return long.union(short).groupBy("size", "fingerprint", "spoken").agg(F.collect_set("item_id").alias("item_ids"))


def anchors(docs: DataFrame, prints: DataFrame, short_sizes: list[int], window: int = WINDOW, k: int = K) -> DataFrame:
    """(doc_id, text_hash, copies, n_words, anchors): one row for each distinct (doc_id, text).

    `anchors` holds (size, start) of the stretches of windows whose fingerprint is in `prints`; they are fewer than the
    words of the row. Every document also sends one row that carries its word count past the join.
    """
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    words = once(texts, ["doc_id", "text_hash"], w=alnum_words(F.col("text")))
    grams, minima = _window_fingerprints("w", window, k)
    rows = once(words, ["doc_id", "text_hash", F.size("w").alias("n_words")],
                grams=F.when(F.size("w") >= window, grams).otherwise(F.array().cast("array<bigint>")))
    rows = once(rows, ["doc_id", "text_hash", "n_words"], prints=F.concat(F.array("text_hash"), minima))
    rows = rows.select("doc_id", "text_hash", "n_words", "prints", F.posexplode("prints").alias("at", "fingerprint"))
    # A gram is the smallest in at most window - k + 1 windows on end, unless it is repeated there.
    before = lambda n: F.get("prints", F.col("at") - n)
    opens = (F.col("at") <= 1) | (before(1) != F.col("fingerprint")) | (
        (F.col("at") > window - k + 1) & (before(window - k + 1) == F.col("fingerprint")))
    rows = rows.where(opens).select("doc_id", "text_hash", "n_words", (F.col("at") - 1).alias("start"),
                                    F.when(F.col("at") == 0, 0).otherwise(window).alias("size"), "fingerprint")
    for size in short_sizes:
        each = words.where(F.size("w") >= size).select(
            "doc_id", "text_hash", "w", F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("start"))
        rows = rows.union(each.select("doc_id", "text_hash", F.lit(0), "start", F.lit(size),
                                      F.xxhash64(_spoken(F.col("w"), F.col("start"), size))))
    found = rows.join(prints.withColumn("known", F.lit(True)), ["size", "fingerprint"], "left")
    found = found.where("known or size = 0")
    return found.groupBy("doc_id", "text_hash").agg(
        F.sum(F.when(F.col("size") == 0, 1).otherwise(0)).alias("copies"), F.max("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("size") > 0, F.struct("size", "start"))).alias("anchors"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, item_ids (sorted as text) and text_hash.

    A word is hit if it lies inside an occurrence of a window of an item; an item of fewer than `window` words is one
    window, an item without words has none. A document whose text is null or has no words has no hits. Texts of any length
    are read whole. Rows that share a doc_id are measured each for itself, a repeated row gives a repeated result, and a
    null doc_id is an id like any other. An item with a null id is left out; other columns are not read.
    """
    known, _ = materialize(item_windows(items, window, k), "item-windows")
    prints, _ = materialize(known.select("size", "fingerprint").distinct(), "item-fingerprints")
    short_sizes = [r["size"] for r in prints.where(F.col("size") < window).select("size").distinct().collect()]
    base, _ = materialize(anchors(docs, prints, sorted(short_sizes), window, k), "document-anchors")
    wanted = base.where(F.size("anchors") > 0).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "anchors")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    same = lambda: F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    again = texts.join(wanted, same()).select("doc_id", "text_hash", "text", "anchors")
    again = once(again, ["doc_id", "text_hash", "anchors"], w=alnum_words(F.col("text")))
    reach = lambda a: F.when(a["size"] < window, a["start"]).otherwise(
        F.least(a["start"] + (window - k), F.size("w") - window))
    starts = F.array_distinct(F.flatten(F.transform("anchors", lambda a: F.transform(
        F.sequence(a["start"], reach(a)), lambda start: F.struct(a["size"].alias("size"), start.alias("start"))))))
    spoken = again.select("doc_id", "text_hash", "w", F.inline(starts))
    spoken = spoken.select("doc_id", "text_hash", "size", "start", _spoken(F.col("w"), F.col("start"), F.col("size")).alias("spoken"))
    hits = spoken.join(known.select("size", "spoken", "item_ids"), ["size", "spoken"])
    found = hits.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("windows"),
                                                    F.collect_set("item_ids").alias("sets"))
    count = F.aggregate("windows", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda done, x: F.struct(
        F.greatest(done["end"], x["start"] + x["size"]).alias("end"),
        (done["n"] + F.greatest(x["start"] + x["size"] - F.greatest(done["end"], x["start"]), F.lit(0))).alias("n")))
    found = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), count["n"].alias("n_hit"),
                         F.array_sort(F.transform(F.array_distinct(F.flatten("sets")), lambda x: x.cast("string"))).alias("item_ids"))
    rows = base.select("doc_id", "text_hash", "n_words", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
    rows = rows.join(found, same(), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.select("doc_id", F.col("n_words").cast("bigint").alias("n_words"),
                       F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                       F.size(ids).cast("bigint").alias("n_items"), ids.alias("item_ids"), "text_hash")
