"""op13: hard negatives of every fiftieth embedding."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from firstprint.llm.negatives import hard_negatives
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table

SQL = """
WITH item AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
score AS MATERIALIZED (SELECT a.vec_id AS anchor_id, i.vec_id, a.label = i.label AS same,
        list_inner_product(a.v, i.v)::BIGINT AS score
    FROM item a JOIN item i ON a.vec_id != i.vec_id WHERE a.vec_id % 50 = 0),
positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM score WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN score USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query("op13_hard_negatives", SQL)
def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, label=label)
