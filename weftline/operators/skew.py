"""Joins against a table with unique keys when one key may hold a third of the other side's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most this many keys can each hold more than 1/HEAVY_KEYS of the rows; so the broadcast side is bounded.
HEAVY_KEYS = 1000


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (one row per key, ``count`` = how often ``rows`` has the key).

    Keys above total / HEAVY_KEYS rows - by counting there are fewer than HEAVY_KEYS of them - are
    joined through a broadcast and never shuffled; the others through a shuffle whose groups are
    small. ``count`` is dropped from the result; null keys join nothing.
    """
    limit = max(1, total // HEAVY_KEYS)
    heavy = keyed.filter(F.col(count) > limit).drop(count)
    light = keyed.filter(F.col(count) <= limit).drop(count)
    hot = heavy.select(key).withColumn("_hot", F.lit(True))
    flagged = rows.join(F.broadcast(hot), key, "left")
    return (
        flagged.filter("_hot").drop("_hot").join(F.broadcast(heavy), key)
        .unionByName(flagged.filter("_hot IS NULL").drop("_hot").join(light, key))
    )
