"""op1: all documents packed into windows of 2048 tokens."""

from pyspark.sql import DataFrame, SparkSession

from firstprint.llm.packing import packed
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_file(), with_ids=False)
