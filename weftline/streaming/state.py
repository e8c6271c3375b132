"""Durable state of incremental operators: a keyed table in hash buckets with a manifest.

The manifest of a version is one small file that names, for each bucket, the folder that holds its
rows, and the deliveries that are in it. It is written last and under its own name, so a version is there
whole or not at all; a new process opens the newest one. A delivery that is repeated under its name
changes nothing. One writer at a time; a second one that commits the same version is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, parallelism

#: Rows a file of a bucket should hold at most, and rows of a bucket beyond which the number of buckets doubles.
FILE_ROWS, BUCKET_ROWS = 2_000_000, 20_000_000
#: Manifests that are kept; what only older ones name is deleted.
KEPT = 2


class BucketedTable:
    """Rows by key under ``path``; ``buckets`` counts for a new table only, an old one keeps its own."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 16):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        versions = self._versions()
        if versions:
            self.state = json.loads(self._read(versions[-1]))
        else:
            self.state = {"version": 0, "buckets": buckets, "at": {}, "rows": {}, "applied": []}

    def _file(self, version: int):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest/{version:012d}.json")

    def _fs(self):
        return self._file(0).getFileSystem(self._conf)

    def _versions(self) -> list[int]:
        folder = self._file(0).getParent()
        fs = self._fs()
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read(self, version: int) -> str:
        stream = self._fs().open(self._file(version))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _commit(self, state: dict) -> None:
        fs, target = self._fs(), self._file(state["version"])
        part = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest/_{uuid.uuid4().hex}")
        out = fs.create(part, True)
        out.write(json.dumps(state).encode())
        out.close()
        if fs.exists(target) or not fs.rename(part, target):
            fs.delete(part, False)
            raise RuntimeError(f"another writer has committed version {state['version']} of {self.path}")
        self.state = state
        old = [v for v in self._versions() if v <= state["version"] - KEPT]
        if old:
            live = {p for v in self._versions() if v not in old for p in json.loads(self._read(v))["at"].values()}
            gone = {p for v in old for p in json.loads(self._read(v))["at"].values()} - live
            for p in sorted(gone):
                drop_path(self.spark, f"{self.path}/{p}")
            for v in old:
                fs.delete(self._file(v), False)

    @property
    def version(self) -> int:
        return self.state["version"]

    def applied(self, delivery: str) -> bool:
        """Whether the table holds this delivery already."""
        return delivery in self.state["applied"]

    def bucket(self, buckets: int | None = None):
        """The bucket of a row, by its first key."""
        return F.expr(f"cast(pmod(xxhash64({self.keys[0]}), {buckets or self.state['buckets']}) AS int)")

    def rows(self, of: list[int] | None = None) -> DataFrame:
        """The current rows of all buckets or of some."""
        paths = [f"{self.path}/{p}" for b, p in sorted(self.state["at"].items()) if of is None or int(b) in of]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*sorted(set(paths)))

    def merge(self, batch: DataFrame, combine, delivery: str | None = None) -> bool:
        """Put ``combine(old rows of the touched buckets, batch)`` in place of those buckets; False if the delivery is known.

        ``batch`` has the table's columns and is read twice: it should be a table or cheap. Buckets without
        rows in it are not read.
        """
        if delivery is not None and self.applied(delivery):
            return False
        b = batch.withColumn("_bucket", self.bucket())
        sizes = {r[0]: r[1] for r in b.groupBy("_bucket").agg(F.count("*")).collect()}  # at most one row a bucket
        held = self.state["rows"]
        new = {**self.state, "version": self.version + 1, "at": dict(self.state["at"]), "rows": dict(held), "applied": [*self.state["applied"], *([delivery] if delivery is not None else [])]}
        if sizes:
            grown = max(n + held.get(str(k), 0) for k, n in sizes.items()) > BUCKET_ROWS
            touched = None if grown else sorted(sizes)
            n = new["buckets"] = self.state["buckets"] * (2 if grown else 1)
            merged = combine(self.rows(touched), batch).withColumn("bucket", self.bucket(n))
            most = max(sizes.values()) + max([0, *held.values()])
            salts = max(1, -(-most // FILE_ROWS))
            folder = f"v={self.version + 1}-{uuid.uuid4().hex[:8]}"
            salt = F.expr(f"pmod(xxhash64({', '.join(self.keys)}, 7), {salts})")
            merged.repartition(max(parallelism(self.spark), 1), "bucket", salt).write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
            written = self.spark.read.parquet(f"{self.path}/{folder}").groupBy("bucket").agg(F.count("*")).collect()
            counts = {str(r[0]): r[1] for r in written}
            if grown:
                new["at"], new["rows"] = {}, {}
            new["at"] |= {b: f"{folder}/bucket={b}" for b in counts}
            new["rows"] |= counts
        self._commit(new)
        return True
