"""Session set-up, table access and cutting of lineage through a shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings of sessions that this library starts by itself (tests, bench, scripts).
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.host": "127.0.0.1",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine; on a cluster the caller brings the session."""
    b = SparkSession.builder.master(master).appName("weftline")
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.driver.memory", memory)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def show_package(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package also where it is not installed."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the data folder ``sf_dir`` (a file or a folder)."""
    show_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or where that is unset (tests) one of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="weftline-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/weftline/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "cut", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and lets several consumers share one computation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._weftline_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these tables; only once nothing lazy reads them any more."""
    for t in tables:
        if path := getattr(t, "_weftline_path", None):
            drop_path(t.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def parallelism(spark: SparkSession) -> int:
    """Partitions for stages that carry Python work: all cores, and no fewer than the shuffle width."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def scratch_is_local(path: str) -> bool:
    """Whether ``path`` lies on a local file system (used by tests to look into results)."""
    return path.startswith("file:") or os.path.isabs(path)
