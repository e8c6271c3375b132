"""Catalogues, ragged JSON, paged services and profile-driven exports as tables."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def flattened(df: DataFrame, sep: str = ".") -> DataFrame:
    """All struct fields as columns with dotted names, in their order, nested ones in place."""
    out = []

    def walk(at: str, name: str, kind: T.DataType):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f"{at}.`{f.name}`", f"{name}{sep}{f.name}", f.dataType)
        else:
            out.append(F.col(at).alias(name))

    for f in df.schema.fields:
        walk(f"`{f.name}`", f.name, f.dataType)
    return df.select(*out)


def ragged_union(frames: list[DataFrame]) -> DataFrame:
    """Rows of frames with different columns; columns in first-seen order, absent ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def catalogue_entities(comments: DataFrame, tables: DataFrame, schemas: DataFrame) -> DataFrame:
    """(entity, description) of commented tables, named schema.table in lower case.

    ``comments``: (table_id, comment), ``tables``: (table_id, schema_id, name), ``schemas``: (schema_id, schema).
    """
    j = comments.filter("comment IS NOT NULL").join(tables, "table_id").join(schemas, "schema_id")
    return j.select(F.lower(F.concat_ws(".", "schema", "name")).alias("entity"), F.col("comment").alias("description"))


def merged_catalogues(catalogues: list[DataFrame], least: float = 0.85) -> DataFrame:
    """(entity, description, confidence) of several catalogues: the last one that names an entity wins, doubtful rows are left out."""
    u = None
    for i, c in enumerate(catalogues):
        c = c.select("entity", "description", "confidence", F.lit(i).alias("_o"))
        u = c if u is None else u.unionByName(c)
    best = u.groupBy("entity").agg(F.max_by(F.struct("description", "confidence"), "_o").alias("r")).select("entity", "r.*")
    return best.filter(F.col("confidence") >= least)


class PagedSearch(DataSource):
    """A search service that is read page by page: each page is a partition and is fetched by its own task.

    ``path`` names a folder of ``page-N.json`` files (lists of {id, name, modified}); a client for a
    real service replaces ``fetch``.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return "id string, name string, modified long"

    def reader(self, schema):
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        return [InputPartition(i) for i in range(len(list(Path(self.path).glob("page-*.json"))))]

    def fetch(self, page: int) -> list[dict]:
        return json.loads(Path(self.path, f"page-{page}.json").read_text())

    def read(self, partition):
        for r in self.fetch(partition.value):
            yield r.get("id"), r.get("name"), r.get("modified")


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV export with header, quotes doubled, empty strings kept apart from nulls."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", '""').csv(path)


def write_atomically(df: DataFrame, path: str, format: str = "json") -> None:
    """Write beside ``path`` and rename: a reader sees the old result or the whole new one."""
    spark: SparkSession = df.sparkSession
    jvm = spark.sparkContext._jvm
    staged, final = jvm.org.apache.hadoop.fs.Path(path + ".staged"), jvm.org.apache.hadoop.fs.Path(path)
    df.write.mode("overwrite").format(format).save(path + ".staged")
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(final, True)
    if not fs.rename(staged, final):
        raise OSError(f"could not rename to {path}")


def write_marked(df: DataFrame, path: str, marks: dict[str, str]) -> None:
    """A Parquet collection with its provenance in a table beside it (``_marks``)."""
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.createDataFrame(sorted(marks.items()), "mark string, value string").coalesce(1).write.mode("overwrite").json(path.rstrip("/") + "_marks")


def exported(rows: DataFrame, notices: DataFrame, columns: list[tuple[str, str, str]]) -> DataFrame:
    """One row per (notice, part) with a column per (output, container, field).

    ``rows``: (notice_id, part_index, field, value) pivots by the profile's part fields; ``notices``
    gives the notice fields. A notice without parts has one row with null part fields.
    """
    fields = [f for _, c, f in columns if c == "part"]
    wide = rows.groupBy("notice_id", "part_index").pivot("field", fields).agg(F.first("value", ignorenulls=True)) if fields else rows.select("notice_id", "part_index").distinct()
    j = notices.join(wide, "notice_id", "left")
    return j.select("notice_id", "part_index", *[F.col(f).alias(o) for o, _, f in columns])
