"""State of incremental operators: new processes, repeated deliveries, empty ones, growth."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weftline.streaming import incremental as S
from weftline.streaming import state as ST

SCHEMA = "k string, n bigint"


def add(old, new):
    return old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n"))


def content(t):
    return {r["k"]: r["n"] for r in t.rows().collect()}


def test_every_object_opens_what_the_last_one_left(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for i, rows in enumerate([[("a", 1), ("b", 1)], [("a", 5), (None, 2)], [("c", 7)]]):
        t = ST.BucketedTable(spark, path, SCHEMA, ["k"], buckets=4)
        assert t.merge(spark.createDataFrame(rows, SCHEMA), add, f"d{i}")
    again = ST.BucketedTable(spark, path, SCHEMA, ["k"], buckets=99)
    assert again.version == 3 and again.state["buckets"] == 4
    assert content(again) == {"a": 6, "b": 1, None: 2, "c": 7}


def test_a_repeated_delivery_changes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([("a", 1)], SCHEMA)
    assert ST.BucketedTable(spark, path, SCHEMA, ["k"]).merge(rows, add, "one")
    t = ST.BucketedTable(spark, path, SCHEMA, ["k"])
    assert not t.merge(rows, add, "one")
    assert t.merge(rows.limit(0), add, "none") and content(t) == {"a": 1}


def test_a_second_writer_of_a_version_is_refused(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    a, b = (ST.BucketedTable(spark, path, SCHEMA, ["k"]) for _ in range(2))
    a.merge(spark.createDataFrame([("a", 1)], SCHEMA), add)
    with pytest.raises(RuntimeError):
        b.merge(spark.createDataFrame([("b", 1)], SCHEMA), add)
    assert content(ST.BucketedTable(spark, path, SCHEMA, ["k"])) == {"a": 1}


def test_buckets_double_and_old_versions_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "BUCKET_ROWS", 20)
    monkeypatch.setattr(ST, "FILE_ROWS", 10)
    path = f"file://{tmp_path}/t"
    for i in range(4):
        rows = spark.createDataFrame([(f"k{j}", 1) for j in range(i * 30, i * 30 + 60)], SCHEMA)
        t = ST.BucketedTable(spark, path, SCHEMA, ["k"], buckets=2)
        t.merge(rows, add)
    assert t.state["buckets"] > 2
    assert content(t) == {f"k{j}": (1 if j < 30 or j >= 120 else 2) for j in range(150)}
    assert len(list((tmp_path / "t/_manifest").glob("*.json"))) == ST.KEPT


def test_latest_states_keep_what_earlier_runs_saw(spark, tmp_path):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    schema = "u string, e string, t timestamp"
    inbox, state = f"file://{tmp_path}/in", f"file://{tmp_path}/state"

    def run():
        stream = S.file_stream(spark, inbox, spark.createDataFrame([], schema).schema)
        return {r["u"]: (r["e"], r["t"]) for r in S.latest_states(stream, "u", "t", "e", state).collect()}

    spark.createDataFrame([("a", "x", at(1)), ("b", "y", at(1))], schema).write.mode("append").parquet(inbox)
    assert run() == {"a": ("x", at(1)), "b": ("y", at(1))}
    spark.createDataFrame([("a", "z", at(2)), ("b", "old", at(0)), ("a", "q", at(2))], schema).write.mode("append").parquet(inbox)
    assert run() == {"a": ("z", at(2)), "b": ("y", at(1))}
    assert run() == {"a": ("z", at(2)), "b": ("y", at(1))}
