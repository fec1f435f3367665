"""op3: a toxicity score of every document."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table
from firstprint.llm.toxicity import fit, toxicity

REMAINDER = "crc32(cast(cast(doc_id as string) as binary)) % 5"


@query("op3_toxicity")
def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), F.expr(f"{REMAINDER} != 0"))
    held_out = F.coalesce(F.expr(f"{REMAINDER} = 0"), F.lit(False))
    return toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
