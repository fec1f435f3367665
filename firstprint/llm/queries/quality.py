"""op6: counts and verdicts of the quality rules."""

from pyspark.sql import DataFrame, SparkSession

from firstprint.llm.quality import BUCKETS, LEAST_RATIO, LEAST_WORDS, PRIOR, quality_rules
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table

# CRC-32 by bytes: `crc_table` holds the checksum step of each byte value, for the polynomial 0xEDB88320.
STEP = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
SQL = f"""
WITH crc_table AS (SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda c, i: {STEP}, CAST(b AS BIGINT)) AS c FROM range(256) r(b))),
doc AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
word AS MATERIALIZED (SELECT doc_id, unnest(w) AS gram, unnest(range(len(w))) AS i FROM doc),
gram AS MATERIALIZED (SELECT doc_id, gram FROM word UNION ALL
    SELECT doc_id, w[i] || ' ' || w[i + 1] FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM doc)),
crc AS MATERIALIZED (SELECT gram, xor(list_reduce(
        list_transform(range(octet_length(encode(gram))), lambda i: ('0x' || substr(hex(encode(gram)), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % {BUCKETS} AS bucket
    FROM (SELECT DISTINCT gram FROM gram), crc_table),
trusted AS MATERIALIZED (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
counts AS MATERIALIZED (SELECT bucket, count(*) AS raw, count(trusted.doc_id) AS trusted
    FROM gram JOIN crc USING (gram) LEFT JOIN trusted ON gram.doc_id = trusted.doc_id GROUP BY 1),
weight AS MATERIALIZED (SELECT bucket, CAST(round(ln((trusted * (SELECT sum(raw) FROM counts)::DOUBLE / raw + {PRIOR}.0)
    / ((SELECT sum(trusted) FROM counts)::DOUBLE + {PRIOR}.0)) * 1000000) AS BIGINT) AS weight FROM counts),
score AS (SELECT doc_id, CAST(sum(weight) AS BIGINT) AS score FROM gram JOIN crc USING (gram) JOIN weight USING (bucket) GROUP BY 1),
triple AS MATERIALIZED (SELECT doc_id, i, gram || ' ' || lead(gram, 1) OVER o || ' ' || lead(gram, 2) OVER o AS spoken
    FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, spoken, count(*) OVER (PARTITION BY doc_id, spoken) AS n FROM triple
    WHERE spoken IS NOT NULL) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM again) GROUP BY 1),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(score, 0) AS score
    FROM doc LEFT JOIN repeated USING (doc_id) LEFT JOIN score USING (doc_id)),
verdict AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    n_repeat_words, base_failed, NOT base_failed AND score >= {round(LEAST_RATIO * 1_000_000)} * (2 * n_words - 1) AS kept FROM verdict
"""


@query("op6_quality_rules", SQL)
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality_rules(docs, docs, table(spark, sf_dir, "labels"))
    return found.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")
