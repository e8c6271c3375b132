"""Boxes of tables that cut their rows, cells or words: the four edges are moved out to what they cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values, in points: sizes beyond which a row or cell is no measure, as such and against the median
# (but never below an allowance), the furthest a side edge and a word completion move, and the passes over the words.
MOST_ROW, ROW_RATIO, LEAST_ROW = 72.0, 3.0, 30.0
MOST_CELL, CELL_RATIO, LEAST_CELL, MOST_SIDE = 576.0, 12.0, 100.0, 36.0
MOST_WORD, PASSES = 36.0, 4
PAD = 0.03


def moved_edge(edge: Column, other: Column, parts: Column, near: str, far: str, outward: int, bound: Column, most: float, ratio: float, allowance: float, limit: float | None) -> Column:
    """Where one edge goes: to the far side of the plausible parts that begin within it.

    ``parts`` is an array of boxes; ``outward`` is 1 for a bottom or right edge and -1 for a top or left one. A part
    far larger than the median of those that begin within is no measure. Without parts, or plausible ones, the
    edge moves out by a share of the box; it never passes the page's ``bound``.
    """
    clamp = (lambda v: F.least(v, bound)) if outward > 0 else (lambda v: F.greatest(v, bound))
    cap = (lambda v: F.least(v, F.lit(limit))) if limit is not None else (lambda v: v)
    padded = clamp(edge + outward * cap(PAD * (edge - other) * outward))
    size = lambda p: F.abs(p[far] - p[near])
    within = F.filter(parts, lambda p: (edge - p[near]) * outward > 0.5)
    sizes = F.array_sort(F.transform(within, size))
    median = F.get(sizes, F.floor(F.size(sizes) / 2).cast("int"))
    ceiling = F.least(F.lit(most), F.greatest(median * ratio, F.lit(allowance)))
    plausible = F.filter(within, lambda p: size(p) <= ceiling)
    reach = F.array_max(F.transform(plausible, lambda p: p[far] * outward)) * outward
    gain = (reach - edge) * outward
    found = F.when(gain > 0, clamp(edge + outward * cap(gain))).otherwise(clamp(edge))
    return F.when(F.coalesce(F.size(parts), F.lit(0)) == 0, padded).when(F.size(within) == 0, clamp(edge)).when(F.size(plausible) == 0, padded).otherwise(found)


def word_completed(box: Column, words: Column, siblings: Column, width: Column, height: Column) -> Column:
    """``box`` with each edge that passes through a word moved to the word's far side, at most MOST_WORD from where it was.

    Words that a sibling box shows whole (one point tolerated) are its own. The words are met in the order given,
    PASSES times, each against the box as moved so far.
    """
    covered = lambda w: F.exists(siblings, lambda s: (s["x0"] - 1 <= w["x0"]) & (w["x1"] <= s["x1"] + 1) & (s["y0"] - 1 <= w["y0"]) & (w["y1"] <= s["y1"] + 1))
    live = F.flatten(F.array_repeat(F.filter(words, lambda w: ~covered(w)), PASSES))

    def meet(b: Column, w: Column) -> Column:
        rows = (w["y1"] > b["y0"] - 1) & (w["y0"] < b["y1"] + 1)
        x0 = F.when(rows & (w["x1"] > b["x0"] + 0.5) & (w["x0"] < b["x0"] - 0.5), F.greatest(w["x0"], box["x0"] - MOST_WORD, F.lit(0.0))).otherwise(b["x0"])
        x1 = F.when(rows & (w["x0"] < b["x1"] - 0.5) & (w["x1"] > b["x1"] + 0.5), F.least(w["x1"], box["x1"] + MOST_WORD, width)).otherwise(b["x1"])
        columns = (w["x1"] > b["x0"] - 1) & (w["x0"] < b["x1"] + 1)
        y0 = F.when(columns & (w["y1"] > b["y0"] + 0.5) & (w["y0"] < b["y0"] - 0.5), F.greatest(w["y0"], box["y0"] - MOST_WORD, F.lit(0.0))).otherwise(b["y0"])
        y1 = F.when(columns & (w["y0"] < b["y1"] - 0.5) & (w["y1"] > b["y1"] + 0.5), F.least(w["y1"], box["y1"] + MOST_WORD, height)).otherwise(b["y1"])
        return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))

    return F.aggregate(live, box, meet)


def _boxes(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Per key the boxes of ``df`` as one array, by ``order``: what lies on one page or in one table."""
    box = F.struct(*[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    g = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), box.alias("b")))).alias("l"))
    return g.select(*keys, F.transform("l", lambda x: x["b"]).alias(name))


def corrected_boxes(boxes: DataFrame, rows: DataFrame, cells: DataFrame, words: DataFrame) -> DataFrame:
    """(page, box_id, x0, y0, x1, y1) of boxes with all four edges corrected.

    ``boxes``: (page, box_id, x0, y0, x1, y1, width, height); ``rows`` and ``cells``: (page, box_id, seq, x0, y0, x1, y1) of
    the table matched to the box; ``words``: (page, seq, x0, y0, x1, y1). Top and bottom go by rows, the sides by
    cells, each against the box as given; then words are completed, by ``seq``. Arrays hold one page or one table.
    """
    none = F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>")
    own = boxes.select("page", "box_id", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1", "width", "height")])
    j = own.join(_boxes(rows, ["page", "box_id"], "seq", "rows"), ["page", "box_id"], "left").join(_boxes(cells, ["page", "box_id"], "seq", "cells"), ["page", "box_id"], "left")
    all_boxes = own.groupBy("page").agg(F.collect_list(F.struct("box_id", "x0", "y0", "x1", "y1")).alias("all"))
    j = j.join(_boxes(words, ["page"], "seq", "words"), "page", "left").join(all_boxes, "page", "left")
    r, c, zero = F.coalesce("rows", none), F.coalesce("cells", none), F.lit(0.0)
    moved = F.struct(
        moved_edge(F.col("x0"), F.col("x1"), c, "x1", "x0", -1, zero, MOST_CELL, CELL_RATIO, LEAST_CELL, MOST_SIDE).alias("x0"),
        moved_edge(F.col("y0"), F.col("y1"), r, "y1", "y0", -1, zero, MOST_ROW, ROW_RATIO, LEAST_ROW, None).alias("y0"),
        moved_edge(F.col("x1"), F.col("x0"), c, "x0", "x1", 1, F.col("width"), MOST_CELL, CELL_RATIO, LEAST_CELL, MOST_SIDE).alias("x1"),
        moved_edge(F.col("y1"), F.col("y0"), r, "y0", "y1", 1, F.col("height"), MOST_ROW, ROW_RATIO, LEAST_ROW, None).alias("y1"),
    )
    j = j.withColumn("moved", moved).withColumn("others", F.filter("all", lambda s: s["box_id"] != F.col("box_id")))
    done = word_completed(F.col("moved"), F.coalesce("words", none), F.coalesce("others", F.array().cast("array<struct<box_id:int,x0:double,y0:double,x1:double,y1:double>>")), F.col("width"), F.col("height"))
    return j.withColumn("done", done).select("page", "box_id", "done.*")
