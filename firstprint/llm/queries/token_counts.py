"""op7: greedy word-piece counts of every document."""

from pyspark.sql import DataFrame, SparkSession

from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table
from firstprint.llm.token_counts import sentencepiece_vocabulary, token_counts


def vocabulary() -> tuple[list[str], list[str]]:
    import public_tokenizers
    return sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


@query("op7_token_counts")
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary)
