"""op11: the nearest neighbours of every fiftieth embedding."""

from pyspark.sql import DataFrame, SparkSession

from firstprint.llm.forest import nearest
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table


@query("op11_nearest_neighbours")
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)
