"""op10: components of near-duplicate documents."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from firstprint.llm.neardup import near_duplicates
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table

SQL = r"""
WITH RECURSIVE doc AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS spoken
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
same AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle a JOIN shingle b USING (spoken)
    WHERE a.doc_id != b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT x, y FROM same JOIN size a ON x = a.doc_id JOIN size b ON y = b.doc_id
    WHERE 100 * same.n >= 85 * (a.n + b.n - same.n)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM doc UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
lowest AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM lowest LEFT JOIN size USING (doc_id)
"""


@query("op10_minhash_near_dedup", SQL)
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.drop("text_hash").withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
