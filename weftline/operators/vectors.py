"""Vectors: unit means, cosine search of a stated query set, readback checks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Queries held in memory at once: a bound on a block, not on the work.
BLOCK = 2000


def unit_means(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, dim, value): the mean vector of each group, scaled to length one; a zero mean stays zero.

    Means are taken per dimension with map-side combining, so a hot group is never gathered.
    """
    d = rows.filter(F.col(vector).isNotNull()).select(group, F.posexplode(vector).alias("dim", "x"))
    m = d.groupBy(group, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    n = m.groupBy(group).agg(F.sqrt(F.sum(F.col("m") ** 2)).alias("norm"))
    return m.join(n, group).select(group, "dim", F.when(F.col("norm") > 0, F.col("m") / F.col("norm")).otherwise(0.0).alias("value"))


def cosine(a, b):
    """Cosine of two array columns; null where either has no length."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, norm(a) * norm(b))


def nearest(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int = 1, block: int = BLOCK) -> DataFrame:
    """(query, key, rank, cosine): the k nearest rows of every query by cosine, ties to the smaller key.

    The queries are the stated, smaller side: blocks of them are sent to the rows, each task keeps its
    own best k, and the bests are merged. Null and zero vectors are found by nothing and find nothing.
    """
    spark = rows.sparkSession
    out = None

    def scan(held):
        ids = np.array([h[0] for h in held], dtype=np.int64)
        q = np.array([h[1] for h in held], dtype=np.float64)
        q /= np.linalg.norm(q, axis=1, keepdims=True)
        shared = spark.sparkContext.broadcast((ids, q))

        def run(batches):
            ids, q = shared.value
            best: list[pd.DataFrame] = []
            for pdf in batches:
                m = np.array(pdf[vector].tolist(), dtype=np.float64)
                norm = np.linalg.norm(m, axis=1)
                use = norm > 0
                if not use.any():
                    continue
                keys = pdf[key].to_numpy()[use]
                sims = q @ (m[use] / norm[use, None]).T
                order = np.lexsort((np.broadcast_to(keys, sims.shape), -np.round(sims, 12)), axis=1)[:, :k]
                best.append(pd.DataFrame({"query": np.repeat(ids, order.shape[1]), "key": keys[order].ravel(), "cosine": np.take_along_axis(sims, order, 1).ravel()}))
            if best:
                b = pd.concat(best).sort_values(["query", "cosine", "key"], ascending=[True, False, True])
                yield b.groupby("query").head(k)

        return rows.select(key, vector).filter(F.col(vector).isNotNull()).mapInPandas(run, "query long, key long, cosine double")

    held: list[tuple] = []
    for r in queries.select(key, vector).filter(F.col(vector).isNotNull()).toLocalIterator():
        if any(r[1]):
            held.append((r[0], list(r[1])))
        if len(held) == block:
            out, held = scan(held) if out is None else out.unionByName(scan(held)), []
    if held:
        out = scan(held) if out is None else out.unionByName(scan(held))
    if out is None:
        return spark.createDataFrame([], "query long, key long, rank int, cosine double")
    w = F.expr("row_number() OVER (PARTITION BY query ORDER BY round(cosine, 12) DESC, key)")
    return out.withColumn("rank", w).filter(F.col("rank") <= k).select("query", "key", "rank", "cosine")


def lost_writes(written: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Keys that were written and cannot be read back; empty is the healthy answer."""
    return written.select(key).distinct().join(stored.select(key), key, "left_anti")
