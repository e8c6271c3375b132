"""Streaming queries over the events, and their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, fresh_path, table
from ..streaming import incremental as S


def _stream(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """The table as a stream of its files: a single file is read through its folder and a name filter."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").option("maxFilesPerTrigger", 1).parquet(sf_dir) if _is_file(spark, f"{sf_dir}/{name}.parquet") else S.file_stream(spark, f"{sf_dir}/{name}.parquet", schema)


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts and sums by event type."""
    return S.windowed(table(spark, sf_dir, "events"), "ts", "1 hour", "1 hour").withColumn("total", F.round("total", 4))


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users with pauses under half an hour."""
    return S.sessions(table(spark, sf_dir, "events"), "ts", "user_id", "30 minutes")


def event_stream_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users discovered by a stream over the events: each starts once."""
    s = _stream(spark, sf_dir).select("user_id").dropDuplicates(["user_id"])
    return S.run_stream(s, fresh_path(spark, "users"))


def event_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event type of every user, merged from micro-batches."""
    return S.latest_states(_stream(spark, sf_dir).select("user_id", "event_type", "ts"), "user_id", "ts", "event_type", fresh_path(spark, "latest")).select("user_id", "event_type", "ts")


def event_state_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event type of every user, after three deliveries that separate runs merge into one table."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    inbox, state = fresh_path(spark, "inbox"), fresh_path(spark, "latest")
    out = e.select("user_id", "event_type", "ts")
    for k in range(3):
        e.filter(F.coalesce(F.col("event_id") % 3, F.lit(0)) == k).drop("event_id").write.mode("append").parquet(inbox)
        out = S.latest_states(S.file_stream(spark, inbox, out.schema), "user_id", "ts", "event_type", state)
    drop_path(spark, inbox)
    return out


def event_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run keys of retries: errors per user counted as attempts."""
    e = table(spark, sf_dir, "events").filter("event_type IS NOT NULL")
    r = e.select(F.concat(F.lit("sha256:"), F.sha2(F.col("user_id").cast("string"), 256)).alias("ingest_id"), (F.col("event_id") % 3).alias("attempt"))
    return S.retry_keys(r).groupBy("attempt").agg(F.count("*").alias("runs"))


def flatten_json_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the events' JSON properties: how many events have each, and distinct values."""
    p = F.from_json("props", "map<string,string>")
    e = table(spark, sf_dir, "events").select(F.explode(p).alias("key", "value"))
    return e.groupBy("key").agg(F.count("*").alias("events"), F.countDistinct("value").alias("distinct_values"))


QUERIES = {f.__name__: f for f in (event_windows, event_sessions, event_stream_discovery, event_stream_latest, event_state_deliveries, event_retries, flatten_json_union)}
SQL = {
    "event_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "event_sessions": "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k",
    "event_stream_discovery": "SELECT DISTINCT user_id FROM events",
    "event_stream_latest": "SELECT user_id, arg_max(event_type, (ts, event_type)) AS event_type, max(ts) AS ts FROM events GROUP BY 1",
    "event_state_deliveries": "SELECT user_id, arg_max(event_type, (ts, event_type)) AS event_type, max(ts) AS ts FROM events GROUP BY 1",
    "event_retries": "SELECT event_id % 3 AS attempt, count(DISTINCT user_id) AS runs FROM events WHERE event_type IS NOT NULL GROUP BY 1",
    "flatten_json_union": "SELECT key, count(*) AS events, count(DISTINCT v) AS distinct_values FROM (SELECT unnest(json_keys(props)) AS key, props FROM events), LATERAL (SELECT json_extract_string(props, '$.' || key) AS v) GROUP BY 1",
}
