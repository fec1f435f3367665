"""op2: the main text of every page."""

from pyspark.sql import DataFrame, SparkSession

from firstprint.llm.extraction import fit, main_texts
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table


@query("op2_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_texts(pages, fit(pages))
