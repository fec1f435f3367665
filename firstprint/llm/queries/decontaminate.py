"""op9: which documents hold passages of the benchmark."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from firstprint.llm.decontaminate import contamination
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+')"""
SQL = f"""
WITH doc AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents),
item AS MATERIALIZED (SELECT item_id, {WORDS} AS w FROM benchmark),
item_window AS MATERIALIZED (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS spoken
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc_window AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS spoken
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM doc, (SELECT DISTINCT size FROM item_window) WHERE len(w) >= size)),
hit AS MATERIALIZED (SELECT doc_id, i, size, item_id FROM doc_window JOIN item_window USING (size, spoken)),
word AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op9_benchmark_decontamination", SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
