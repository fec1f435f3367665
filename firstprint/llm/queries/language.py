"""op4: the language of every document."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from firstprint.llm.language import fit, identified
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table

REMAINDER = "crc32(cast(cast(doc_id as string) as binary)) % 3"


@query("op4_language_id")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identified(docs, fit(docs, F.expr(f"{REMAINDER} != 1"))).select("doc.doc_id", "lang_pred", "score")
    return found.select("doc_id", F.coalesce(F.expr(f"{REMAINDER} = 1"), F.lit(False)).alias("held_out"), "lang_pred", "score")
