"""op12: a byte-level and a sentencepiece tokenizer aligned over all documents."""

from pyspark.sql import DataFrame, SparkSession

from firstprint.llm.alignment import alignment
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query("op12_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), *tokenizer_files())
