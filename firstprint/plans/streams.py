"""Streaming jobs over the driver tables, run to the end of the data."""

from pyspark.sql import functions as F

from firstprint.plans.registry import query
from firstprint.plans.tables import POSITIONS, positions, table
from firstprint.plans.weekly import FLOWS
from firstprint.session import scratch_dir
from firstprint.streaming import stores as X


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
            .withColumn("ts", F.col("ts").cast("timestamp")))


@query("stream_append_dedup", "user_id:i event_type day event_id:i value:n", """result AS (
  SELECT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day, event_id, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, strftime(ts, '%Y-%m-%d') ORDER BY event_id) = 1)""")
def stream_append_dedup(spark, sf):
    path = scratch_dir(spark, "stream-store")
    rows = event_stream(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("arrival", F.col("event_id"))
    header = ["user_id", "event_type", "day", "event_id", "value"]
    X.stream_append_dedup(rows, path, path + "-state", header, ["user_id", "event_type", "day"], "arrival", "day").awaitTermination()
    return spark.read.parquet(path)


@query("stream_weekly_counts", "week_ending:d search n:i", """weekly AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS week_ending, event_type AS search, count(DISTINCT user_id) AS n
  FROM events GROUP BY 1, 2 UNION ALL
  SELECT CAST(date_trunc('week', ts) AS DATE) + 6, 'total', count(DISTINCT user_id) FROM events GROUP BY 1)""", """spine AS (
  SELECT CAST(unnest(generate_series(min(week_ending), max(week_ending), INTERVAL 7 DAY)) AS DATE) AS week_ending FROM weekly)""",
       """result AS (
  SELECT week_ending, search, coalesce(n, 0) AS n FROM spine CROSS JOIN (
    SELECT DISTINCT event_type AS search FROM events UNION SELECT 'total' UNION SELECT 'never') names
  LEFT JOIN weekly USING (week_ending, search))""")
def stream_weekly_counts(spark, sf):
    """Users per week and event type, a type that never comes, and the total."""
    path = scratch_dir(spark, "weekly-counts")
    X.stream_weekly_counts(event_stream(spark, sf), path, f"{path}/state", "ts", "event_type", "user_id").awaitTermination()
    kinds = sorted(r["event_type"] for r in table(spark, sf, "events").select("event_type").distinct().collect())  # a handful
    return X.weekly_counts(spark, path, [*kinds, "never"])


@query("stream_weekly_windows", "week_ending:d search n:i", """marks AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS week_ending, event_type AS search, user_id FROM events
  UNION ALL SELECT CAST(date_trunc('week', ts) AS DATE) + 6, 'total', user_id FROM events)""", """result AS (
  SELECT week_ending, search, count(DISTINCT user_id) AS n FROM marks
  WHERE CAST(week_ending + 1 AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY 1, 2)""")
def stream_weekly_windows(spark, sf):
    """Users per event type of every week that two days of lateness have passed."""
    path = scratch_dir(spark, "weekly-windows")
    X.stream_weekly_windows(event_stream(spark, sf), f"{path}/final", f"{path}/state", "ts", "event_type", "user_id", "2 days").awaitTermination()
    return spark.read.schema("week_ending date, search string, n bigint").parquet(f"{path}/final")


@query("stream_gap_delta_rank", "series report_date net:n net_change:n move_rank_pct:n net_rank_pct:n", POSITIONS, FLOWS,
       """result AS (
  SELECT series, strftime(report_date, '%Y-%m-%d') AS report_date, net, net_change, move_rank_pct, net_rank_pct FROM flagged)""")
def stream_gap_delta_rank(spark, sf):
    """Weekly positions are published as files, weeks of all years in each, and followed as a stream of several batches."""
    path = scratch_dir(spark, "weekly-positions")
    weekly = positions(spark, sf).select("series", F.date_format("report_date", "yyyy-MM-dd").alias("report_date"), "net")
    weekly = weekly.withColumn("arrival", F.lit(0))
    weekly.repartition(3, "report_date").write.parquet(f"{path}/files")
    stream = spark.readStream.schema(weekly.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/files")
    X.stream_gap_delta_rank(stream, path, f"{path}/state", "series", "arrival").awaitTermination()
    return spark.read.parquet(f"{path}/ranked")
