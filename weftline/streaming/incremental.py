"""Incremental operators on Structured Streaming: discovery, retries, latest states, idempotent sinks, windows.

Every stream here runs with ``availableNow``: it takes what has arrived, in micro-batches of bounded
size, and stops; its checkpoint makes the next run take only what is new. Sinks lie in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, fresh_path, materialize
from .state import BucketedTable

SEEN = "file_name string, bytes long, arrived timestamp"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, per_trigger: int = 50) -> DataFrame:
    """A stream of the Parquet files that arrive under ``path``, at most ``per_trigger`` in one batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def run_stream(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there into a Parquet sink at ``path`` and return the sink's content.

    The checkpoint lies beside the sink; a second run appends only what is new.
    """
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}-checkpoint").outputMode(mode).trigger(availableNow=True).start(path)
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def discovered(spark: SparkSession, path: str, schema: T.StructType, key: str, state_path: str | None = None) -> DataFrame:
    """One row per new key, the first seen: repeats of a key in one run start nothing again.

    Keys are deduplicated in streaming state bounded by the checkpoint at ``state_path``.
    """
    s = file_stream(spark, path, schema).dropDuplicates([key])
    return run_stream(s, state_path or fresh_path(spark, "discovered"))


def latest_of(rows: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """(key, value, at): the latest value of each key; of equal times the greater value."""
    return rows.groupBy(key).agg(F.max_by(F.struct(value, at), F.struct(at, value)).alias("r")).select(key, "r.*")


def latest_states(stream: DataFrame, key: str, at: str, value: str, path: str) -> DataFrame:
    """(key, value, at): the latest state of each key, kept by merging every micro-batch into the table at ``path``.

    The table outlives the process: a later run over what has arrived since merges into it, and a run over
    nothing new returns it as it is. Only the hash buckets a batch touches are rewritten; equal times keep
    the greater value, so a batch that is delivered again changes nothing. A null key is a key of its own.
    """
    spark = stream.sparkSession
    rows = stream.select(key, value, at)
    state = BucketedTable(spark, f"{path}/state", rows.schema.simpleString()[7:-1].replace(":", " "), [key])

    def merge(batch: DataFrame, _id: int) -> None:
        new = latest_of(batch, key, at, value)
        state.merge(materialize(new, "batch"), lambda old, add: latest_of(old.unionByName(add), key, at, value))

    q = rows.writeStream.foreachBatch(merge).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return state.rows()


def retry_keys(requests: DataFrame) -> DataFrame:
    """(ingest_id, attempt, run_key): each attempt of a retry starts once, apart from discovery."""
    return requests.select("ingest_id", "attempt", F.concat_ws("-a", "ingest_id", F.col("attempt").cast("string")).alias("run_key")).dropDuplicates(["run_key"])


def windowed(events: DataFrame, at: str, length: str, late: str) -> DataFrame:
    """(window_start, event_type, n, total): tumbling windows; on a stream rows later than ``late`` are dropped."""
    e = events.withWatermark(at, late) if events.isStreaming else events
    g = e.groupBy(F.window(at, length), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, at: str, user: str, gap: str) -> DataFrame:
    """(user, session_start, session_end, n): runs of events of a user with pauses shorter than ``gap``."""
    g = events.groupBy(F.session_window(at, gap), user).agg(F.count("*").alias("n"))
    return g.select(user, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def approval_runs(rows: DataFrame, key: str, at: str, props: str, most: int = 50) -> DataFrame:
    """(key, run_key) of the ``most`` rows changed last: the key and a hash of the row's properties.

    ``props`` is a map column. The same content gives the same run key at every poll, whatever the order of
    the properties, so it starts once; a changed one gives another. Ties of time go by run key; a null key starts
    nothing. The limit is the poll's own.
    """
    pairs = F.array_sort(F.transform(F.map_entries(F.coalesce(props, F.create_map().cast("map<string,string>"))), lambda e: F.concat_ws("=", e["key"], e["value"])))
    run = F.concat_ws("_", F.col(key).cast("string"), F.left(F.sha2(F.array_join(pairs, "|"), 256), F.lit(12)))
    r = rows.filter(F.col(key).isNotNull()).select(key, F.col(at).alias("_at"), run.alias("run_key"))
    return r.orderBy(F.col("_at").desc_nulls_last(), "run_key").limit(most).select(key, "run_key").distinct()


def publish_heartbeats(spark: SparkSession, payload: DataFrame, path: str, every: str = "30 seconds", beats: int | None = None) -> int:
    """Write ``payload`` and the time to ``path`` at every beat, each time in place of the last; the number of beats written.

    A reader sees the newest beat under its own number. Without ``beats`` it goes on until the query is stopped.
    """
    written = {"n": 0}

    def beat(_batch: DataFrame, number: int) -> None:
        if beats is not None and written["n"] >= beats:  # a batch that began while the query was being stopped
            return
        if number > 1:
            drop_path(spark, f"{path}/beat={number - 2}")
        payload.withColumns({"beat": F.lit(number), "at": F.current_timestamp()}).coalesce(1).write.mode("overwrite").json(f"{path}/beat={number}")
        written["n"] += 1

    q = spark.readStream.format("rate").option("rowsPerSecond", 1).load().writeStream.foreachBatch(beat).option("checkpointLocation", f"{path}-checkpoint").trigger(processingTime=every).start()
    while beats is None or written["n"] < beats:
        if q.awaitTermination(1):
            break
    q.stop()
    return written["n"]
