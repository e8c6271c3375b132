"""Duplicates hidden by formatting: an incremental ledger of canonical keys (problem 2).

A record's text has two spellings that put its dress aside: ``flat`` (letters and digits only, in the
order written) and ``sorted`` (the same by parts between commas, semicolons and slashes, parts in
sorted order). Records are copies when either agrees, and copies of copies are copies.

The ledger holds one row per (scope, flat, sorted) with the number of records and the earliest
representative, in hash buckets (``streaming.state``). A batch is aggregated map-side first, so a key that
holds a third of all rows is one row per task before any shuffle, then full-outer-joined with only those
buckets it touches. Buckets are written as new versions under a manifest, so a later process goes on
where the last one ended; an update never rewrites a bucket it did not touch, and buckets double as they fill.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from ..operators.skew import join_counted
from ..session import drop, fresh_path, materialize, table
from ..streaming.state import BucketedTable

_PARTS = re.compile(r"[,;/]")
_PLAIN = re.compile(r"[^0-9a-z]")
KEYS = T.StructType([T.StructField("flat", T.StringType()), T.StructField("sorted", T.StringType())])


def _letters(s: str) -> str:
    """Letters, digits and marks that compose with no letter."""
    return _PLAIN.sub("", s) if s.isascii() else "".join(c for c in s if c.isalnum() or unicodedata.category(c)[0] == "M")


def spelling_keys(text: str | None) -> tuple[str | None, str | None]:
    """(flat, sorted) of one text; both None for null and for text without any letter or digit."""
    if text is None:
        return None, None
    if text.isascii():
        s = text.lower()
    else:
        s = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    parts = [p for p in map(_letters, _PARTS.split(s)) if p]
    return ("".join(parts), "\x1f".join(sorted(parts))) if parts else (None, None)


@F.pandas_udf(KEYS)
def _keys_udf(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([spelling_keys(t) for t in texts], columns=["flat", "sorted"])


def _hash(*parts: Column) -> Column:
    """A 128-bit key of several nullable values."""
    return F.md5(F.to_json(F.struct(*[p.cast("string").alias(f"c{i}") for i, p in enumerate(parts)])))


def with_keys(records: DataFrame, text: Column, scope: list[str]) -> DataFrame:
    """``records`` with ``flat_key`` and ``sorted_key`` within ``scope`` (null scope values are values of their own)."""
    keyed = records.withColumn("_k", _keys_udf(text))
    at = [F.col(c) for c in scope]
    return (
        keyed.withColumn("flat_key", F.when(F.col("_k.flat").isNotNull(), _hash(*at, F.col("_k.flat"))))
        .withColumn("sorted_key", F.when(F.col("_k.sorted").isNotNull(), _hash(*at, F.col("_k.sorted"))))
        .drop("_k")
    )


class Ledger:
    """Canonical-key counts in the durable table under ``path``; a new object opens what the last one left."""

    SCHEMA = "flat_key string, sorted_key string, n bigint, keep_id bigint"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark = spark
        self.table = BucketedTable(spark, path, self.SCHEMA, ["flat_key", "sorted_key"], buckets)

    def rows(self) -> DataFrame:
        """The current rows."""
        return self.table.rows()

    def update(self, keyed: DataFrame, record_id: str, delivery: str | None = None) -> bool:
        """Add a batch of records that carry ``flat_key`` and ``sorted_key``; rows without keys are left out.

        A delivery that was added under its name before changes nothing (False).
        """
        if delivery is not None and self.table.applied(delivery):
            return False
        k = ["flat_key", "sorted_key"]
        batch = materialize(keyed.filter("flat_key IS NOT NULL").groupBy(*k).agg(F.count("*").alias("n"), F.min(record_id).cast("long").alias("keep_id")), "batch")

        def joined(old: DataFrame, new: DataFrame) -> DataFrame:
            both = old.withColumnsRenamed({"n": "n0", "keep_id": "k0"}).join(new, k, "full_outer")
            return both.select(*k, (F.coalesce("n0", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n"), F.least("k0", "keep_id").alias("keep_id"))

        done = self.table.merge(batch, joined, delivery)
        drop(batch)
        return done

    def groups(self) -> DataFrame:
        """(flat_key, sorted_key, n, keep_id, copies): the ledger with each group's representative and size.

        Rows that share a flat or a sorted key are one group, and so on. Only rows that share a key with
        another row go through the components; the others are groups by themselves.
        """
        rows = self.rows()
        shared = []
        for key, other in (("flat_key", "sorted_key"), ("sorted_key", "flat_key")):
            ends = rows.groupBy(key).agg(F.min(other).alias("lo"), F.max(other).alias("hi")).filter("lo <> hi")
            shared.append(rows.join(ends.select(key), key, "left_semi").select("flat_key", "sorted_key"))
        edges = materialize(shared[0].unionByName(shared[1]).select(F.concat(F.lit("f"), "flat_key").alias("a"), F.concat(F.lit("s"), "sorted_key").alias("b")).distinct(), "shared")
        of = materialize(connected_components(edges).filter("node LIKE 's%'").select(F.expr("substr(node, 2)").alias("sorted_key"), F.col("component").alias("g")), "groups")
        g = rows.join(of, "sorted_key", "left").withColumn("g", F.coalesce("g", F.concat(F.lit("s"), "sorted_key")))
        whole = g.groupBy("g").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("copies"))
        return g.drop("keep_id").join(whole, "g").select("flat_key", "sorted_key", "n", "keep_id", "copies")


def concept_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with their keys; the text is ``name``, or ``name_normalized`` where it is null."""
    r = table(spark, sf_dir, "concept_records").select("record_id", "domain", "course_id", "name", "name_normalized", "loaded_at")
    return with_keys(r, F.coalesce("name", "name_normalized"), ["domain", "course_id"]).select("record_id", "loaded_at", "flat_key", "sorted_key")


def build_ledger(spark: SparkSession, records: DataFrame, batches: int = 2) -> Ledger:
    """A ledger fed with ``records`` in ``batches`` deliveries by load time (null times come first)."""
    lo, hi = records.agg(F.min("loaded_at").cast("double"), F.max("loaded_at").cast("double")).first()
    ledger = Ledger(spark, fresh_path(spark, "ledger"))
    step = ((hi - lo) / batches if hi is not None and hi > lo else 1.0) or 1.0
    at = F.coalesce(F.least(F.floor((F.col("loaded_at").cast("double") - F.lit(lo or 0.0)) / step), F.lit(batches - 1)), F.lit(0))
    for k in range(batches):
        ledger.update(records.filter(at == k), "record_id", f"delivery-{k}")
    return ledger


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keep_id, copy_id) for every surplus record: same domain, course and text but for its dress.

    Texts that are null or hold no letter or digit are copies of nothing; rows that repeat are copies;
    an empty table gives no rows. A hot group's rows meet its representative through a bounded broadcast.
    """
    records = materialize(concept_records(spark, sf_dir), "records")
    ledger = build_ledger(spark, records)
    groups = materialize(ledger.groups().filter("copies > 1"), "copied")
    pair = F.concat_ws("-", "flat_key", "sorted_key").alias("pair")
    total = records.count()
    rows = records.filter("flat_key IS NOT NULL").select("record_id", pair)
    met = join_counted(rows, groups.select(pair, "keep_id", "n"), "pair", "n", total)
    return met.filter("record_id <> keep_id").select("keep_id", F.col("record_id").alias("copy_id"))


def p2_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record group: its representative, its text, and how many records it had in all."""
    groups = build_ledger(spark, materialize(concept_records(spark, sf_dir), "records")).groups()
    kept = groups.groupBy("keep_id").agg(F.max("copies").alias("copies"))
    src = table(spark, sf_dir, "concept_records").select("record_id", "domain", "course_id", F.coalesce("name", "name_normalized").alias("text"))
    return src.join(kept, src.record_id == kept.keep_id).select("keep_id", "domain", "course_id", "text", "copies")


QUERIES = {"p2_found": p2_found, "p2_collapsed": p2_collapsed}
