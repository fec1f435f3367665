"""Append-only stores, merges and rebuilds over the driver tables."""

import datetime as dt

from pyspark.sql import functions as F

from firstprint.operators import store as K
from firstprint.operators.filings import new_since as rows_since, work_since
from firstprint.plans.registry import query
from firstprint.plans.tables import RELEASE, money, release, table
from firstprint.session import scratch_dir

PRINTS = """prints AS (
  SELECT o_custkey, strftime(o_orderdate, '%Y') AS year, o_orderkey AS arrival, CAST(o_totalprice AS DECIMAL(18,2)) AS value,
         o_orderstatus FROM orders)"""


def prints(spark, sf):
    return table(spark, sf, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"), F.col("o_orderkey").alias("arrival"),
        money("o_totalprice").alias("value"), "o_orderstatus")


@query("append_dedup", "o_custkey:i year value:n note added:i", PRINTS, """first_batch AS (
  SELECT * FROM prints WHERE o_orderstatus <> 'O'
  QUALIFY row_number() OVER (PARTITION BY o_custkey, year ORDER BY arrival) = 1), second_batch AS (
  SELECT * FROM prints p WHERE NOT EXISTS (SELECT 1 FROM first_batch f WHERE f.o_custkey = p.o_custkey AND f.year = p.year)
  QUALIFY row_number() OVER (PARTITION BY o_custkey, year ORDER BY arrival) = 1)""", """result AS (
  SELECT o_custkey, year, value, '' AS note, (SELECT count(*) FROM second_batch) AS added FROM first_batch
  UNION ALL SELECT o_custkey, year, value, '', (SELECT count(*) FROM second_batch) FROM second_batch)""")
def append_dedup(spark, sf):
    """Two batches, the second overlapping the first; the first print per customer and year stands."""
    path, header = scratch_dir(spark, "store"), ["o_custkey", "year", "value", "note"]
    rows = prints(spark, sf)
    K.append_dedup(rows.where(F.col("o_orderstatus") != "O"), path, header, ["o_custkey", "year"], "arrival", "year")
    added = K.append_dedup(rows, path, header, ["o_custkey", "year"], "arrival", "year")
    return spark.read.parquet(path).withColumn("added", F.lit(added))


@query("overwrite_table", "item period:d value:n", RELEASE, """result AS (
  SELECT item, period, value FROM release WHERE period >= DATE '1998-01-01')""")
def overwrite_table(spark, sf):
    path = scratch_dir(spark, "table")
    K.overwrite_table(release(spark, sf), path)
    K.overwrite_table(release(spark, sf).where(F.col("period") >= dt.date(1998, 1, 1)), path)
    return spark.read.parquet(path)


@query("overwrite_partition", "item month value:n", RELEASE, """result AS (
  SELECT item, strftime(period, '%Y-%m') AS month, CASE WHEN year(period) = 2000 THEN value * 2 ELSE value END AS value
  FROM release WHERE NOT (year(period) = 2000 AND item = '5-LOW'))""")
def overwrite_partition(spark, sf):
    """One year's slices written again, doubled and without one item."""
    path = scratch_dir(spark, "slices")
    rows = release(spark, sf).withColumn("month", F.date_format("period", "yyyy-MM")).drop("period")
    K.overwrite_partition(rows, path, ["month"])
    later = rows.where(F.startswith("month", F.lit("2000")) & (F.col("item") != "5-LOW"))
    K.overwrite_partition(later.withColumn("value", F.col("value") * 2), path, ["month"])
    return spark.read.parquet(path)


DATED = """dated AS (
  SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS p, max(o_orderkey) AS recency,
         arg_max(o_totalprice, o_orderkey) AS value FROM orders GROUP BY 1, 2)"""


def dated(spark, sf):
    return (table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("p"))
            .agg(F.max("o_orderkey").alias("recency"), F.max_by("o_totalprice", "o_orderkey").alias("value")))


@query("priority_merge", "day:d source value:n", DATED, """result AS (
  SELECT day, 'primary' AS source, arg_max(value, recency) AS value FROM dated WHERE p IN ('1-URGENT', '2-HIGH') GROUP BY 1
  UNION ALL SELECT day, 'secondary', arg_max(value, recency) FROM dated d
  WHERE p NOT IN ('1-URGENT', '2-HIGH') AND year(day) IN (1996, 1997, 2000) AND NOT EXISTS (
    SELECT 1 FROM dated x WHERE x.day = d.day AND x.p IN ('1-URGENT', '2-HIGH')) GROUP BY 1)""")
def priority_merge(spark, sf):
    rows = dated(spark, sf)
    is_primary = F.col("p").isin("1-URGENT", "2-HIGH")
    primary, secondary = rows.where(is_primary).drop("p"), rows.where(~is_primary).drop("p")
    return K.priority_merge(primary, secondary, ["day"], "day", "recency", [1996, 1997, 2000])


@query("entity_fallback", "o_custkey:i o_orderkey:i source", """result AS (
  SELECT o_custkey, o_orderkey, 'primary' AS source FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_custkey, o_orderkey, 'secondary' FROM orders WHERE o_orderstatus <> 'P'
    AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'))""")
def entity_fallback(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return K.entity_fallback(orders.where(F.col("o_orderstatus") == "P"), orders.where(F.col("o_orderstatus") != "P"), "o_custkey")


@query("rebuild_from_raw", "o_custkey:i feed value:n", """lines AS (
  SELECT o_custkey, replace(o_orderpriority, ' ', '_') AS feed, o_orderkey, o_totalprice AS value FROM orders)""", """result AS (
  SELECT o_custkey, feed, value FROM lines
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY feed, o_orderkey) = 1)""")
def rebuild_from_raw(spark, sf):
    """Raw text files per feed, read back; the feed comes from the path, the first feed wins."""
    path = scratch_dir(spark, "raw")
    line = F.concat_ws(",", "o_custkey", "o_orderkey", money("o_totalprice").cast("string"))
    (table(spark, sf, "orders").select(F.replace("o_orderpriority", F.lit(" "), F.lit("_")).alias("feed"), line.alias("value"))
     .write.partitionBy("feed").text(path))
    raw = spark.read.option("recursiveFileLookup", True).text(path).withColumn("path", F.input_file_name())
    cells = F.split("value", ",")
    parsed = raw.select(cells[0].cast("bigint").alias("o_custkey"), cells[1].cast("bigint").alias("position"),
                        cells[2].cast("double").alias("value"), F.regexp_extract("path", "/feed=([^/]+)/", 1).alias("feed"))
    return K.rebuild(parsed, ["o_custkey"], "feed", "position")


@query("new_since", "o_orderkey:i", """result AS (
  SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-15')""")
def new_since(spark, sf):
    return rows_since(table(spark, sf, "orders"), "o_orderdate", dt.datetime(2001, 6, 15)).select("o_orderkey")


@query("new_since_watermark", "o_orderkey:i run:i", """result AS (
  SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-07-01' THEN 1 ELSE 2 END AS run FROM orders)""")
def new_since_watermark(spark, sf):
    """Two runs over growing orders: the second starts at the last day of the first, and stores what it had not seen."""
    path = scratch_dir(spark, "watermark")
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))

    def run(number, rows):
        keep = lambda new: K.append_dedup(new.withColumn("run", F.lit(number)), f"{path}/store", ["o_orderkey", "run"], ["o_orderkey"], "day")
        work_since(rows, "day", f"{path}/marks", keep)

    run(1, orders.where("day < date '1998-07-01'"))
    run(2, orders)
    return spark.read.parquet(f"{path}/store")
