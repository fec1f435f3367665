"""Append-only stores: first print wins, slices are replaced whole."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from firstprint.operators.growth import latest_of_key


def first_per_key(rows: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """First arrival per key, by aggregation: copies of a hot key meet map-side."""
    others = [c for c in rows.columns if c not in keys]
    return (rows.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(arrival)).alias("_r"))
            .select(*keys, "_r.*").select(*rows.columns))


def conform(rows: DataFrame, header: list[str], keep: list[str] = ()) -> DataFrame:
    """Header columns only, in order; a missing one is blank."""
    return rows.select(*[F.col(c) if c in rows.columns else F.lit("").alias(c) for c in header],
                       *[c for c in keep if c not in header])


def new_rows(batch: DataFrame, store: DataFrame | None, keys: list[str], arrival: str) -> DataFrame:
    """Batch rows whose key is new to the store and to the batch."""
    first = first_per_key(batch, keys, arrival)
    return first if store is None else first.join(_renamed(store, keys), _same(first, keys), "left_anti")


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_is_{k}") for k in keys])


def _same(df: DataFrame, keys: list[str]) -> Column:
    """Equal keys, a missing one equal to a missing one."""
    return reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(f"_is_{k}")) for k in keys])


def read_store(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The stored rows, None before the first ones; with a schema, slice values keep its types."""
    try:
        stored = spark.read.parquet(path)
        return stored if schema is None else spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


SLICE = "slice"


def _slice(column: str) -> Column:
    """Folder name of a slice: '=' before a value, nothing else for a missing one."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("none")).alias(SLICE)


def append_dedup(batch: DataFrame, path: str, header: list[str], keys: list[str], arrival: str,
                 partition_by: str | None = None) -> int:
    """Append the new rows to a parquet store and return how many there were.

    Stored rows are never rewritten. With `partition_by` (one of the keys) a semi
    join with the batch's slices lets Spark read back only the ones it touches.
    A folder name cannot tell a blank slice from a missing one, so slices are
    kept in the folder under a marked copy of the value, and whole in the rows.
    """
    spark = batch.sparkSession
    batch = conform(batch, header, [arrival])
    schema = batch.select(*header).schema
    if partition_by:
        schema = T.StructType([*schema.fields, T.StructField(SLICE, T.StringType())])
    store = read_store(spark, path, schema)
    if store is not None and partition_by:
        store = store.join(batch.select(_slice(partition_by)).distinct(), SLICE, "left_semi")
    counted = Observation()
    fresh = (new_rows(batch, store, keys, arrival).select(*header)
             .observe(counted, F.count(F.lit(1)).alias("n")))
    writer = (fresh.withColumn(SLICE, _slice(partition_by)) if partition_by else fresh).write.mode("append")
    (writer.partitionBy(SLICE) if partition_by else writer).parquet(path)
    return counted.get["n"]


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_partition(df: DataFrame, path: str, slices: list[str]) -> None:
    """Replace only the slices present in `df`; all others stay."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*slices).parquet(path))


def priority_merge(primary: DataFrame, secondary: DataFrame, keys: list[str], date: str,
                   recency: str, years: list[int] | None = None) -> DataFrame:
    """Primary rows always, newest print first; secondary fills only their gaps.

    `years` limits which dates the secondary may fill.
    """
    if years is not None:
        secondary = secondary.where(F.year(date).isin(list(years)))
    both = (primary.withColumn("source", F.lit("primary")).withColumn("_p", F.lit(1))
            .unionByName(secondary.withColumn("source", F.lit("secondary")).withColumn("_p", F.lit(0))))
    columns = [c for c in both.columns if c not in (*keys, "_p")]
    return latest_of_key(both, keys, [F.col("_p"), F.col(recency)], columns)


def entity_fallback(primary: DataFrame, secondary: DataFrame, entity: str) -> DataFrame:
    """Secondary rows only for entities without a single primary row."""
    covered = primary.select(entity).distinct()
    missing = secondary.join(covered, entity, "left_anti")
    return (primary.withColumn("source", F.lit("primary"))
            .unionByName(missing.withColumn("source", F.lit("secondary"))))


def rebuild(parsed: DataFrame, keys: list[str], path_column: str, position: str) -> DataFrame:
    """A store rebuilt from all raw payloads: first file, then first row, wins."""
    arrival = F.struct(path_column, position)
    return first_per_key(parsed.withColumn("_arrival", arrival), keys, "_arrival").drop("_arrival")


def key_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a whose key is not in b."""
    return a.join(b.select(*keys), keys, "left_anti")


def key_intersection(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a whose key is in b."""
    return a.join(b.select(*keys), keys, "left_semi")


def distinct_union(column: str, *tables: DataFrame) -> DataFrame:
    """Distinct keys over several tables, each reduced before they meet."""
    out = None
    for df in tables:
        keys = df.select(column).distinct()
        out = keys if out is None else out.union(keys)
    return out.distinct()
