"""op5: license texts and notices in documents."""

from pyspark.sql import DataFrame, SparkSession

from firstprint.llm.licenses import license_spans
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table


@query("op5_license_scans")
def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_spans(table(spark, sf_dir, "documents"))
