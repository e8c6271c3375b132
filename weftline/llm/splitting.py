"""Splitting of oversized texts at natural boundaries, with overlap (problem 4).

For every place a piece may end, the farthest legal end of the next piece is known in one vectorised
step (the successor table: start = end - overlap, end = the last boundary of the best kind within the
limit). Squaring that table doubles the reach of a jump, so all cuts of a text follow in log2(pieces)
steps instead of one after the other.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import parallelism, table
from .spread import spread

# Natural boundaries, best first. A cut lies after the match.
BOUNDARIES = (
    re.compile(r"\n[ \t]*\n+"),  # paragraphs
    re.compile(r"\n"),  # lines
    re.compile(r"[.!?。！？…][\"'”’)\]]*\s+|[。！？]"),  # sentences
    re.compile(r"[;:,]\s+"),  # clauses
    re.compile(r"\s+"),  # words
)
#: A boundary of a better kind is taken if the piece keeps at least this share of the limit.
LEAST_FILL = 0.5


def _last_at(n: int, ends: np.ndarray) -> np.ndarray:
    """For each position 0..n the last boundary at or before it, 0 where there is none."""
    mark = np.zeros(n + 1, dtype=np.int32)
    mark[ends] = ends
    return np.maximum.accumulate(mark)


def cuts(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of one text, in code points, in order.

    A text within the limit is one piece. Pieces are at most ``limit`` long, cover the text, and
    neighbours share exactly ``overlap`` characters (reduced to limit - 1 where it is not smaller). Some ten
    tables of four bytes a character are held at a time: a text of 100 million characters needs about 4 GB.
    """
    n = len(text)
    if limit < 1:
        raise ValueError("the limit must be positive")
    if n <= limit:
        return [(0, n)]
    overlap = max(0, min(overlap, limit - 1))
    end = np.arange(n + 1, dtype=np.int32)
    reach = np.minimum(end - overlap + limit, n)  # the farthest legal end of the piece after one that ends here
    low = np.maximum(end + 1, end - overlap + int(limit * LEAST_FILL))
    succ = np.zeros(n + 1, dtype=np.int32)
    for pattern in BOUNDARIES:
        ends = np.fromiter((m.end() for m in pattern.finditer(text)), dtype=np.int32)
        if len(ends):
            best = _last_at(n, ends)[reach]
            succ = np.where((succ == 0) & (best >= low), best, succ)
    succ = np.where(succ == 0, reach, succ)
    succ = np.where(reach >= n, n, succ)
    # The first piece has no predecessor: it starts at 0, as if one had ended at ``overlap``.
    first = int(succ[overlap]) if overlap > 0 else int(succ[0])
    reached = np.array([first], dtype=np.int32)
    jump = succ
    while True:
        more = np.union1d(reached, jump[reached])
        if len(more) == len(reached):
            break
        reached, jump = more, jump[jump]
    ends = reached.tolist()
    return [(0 if k == 0 else ends[k - 1] - overlap, e) for k, e in enumerate(ends)]


_PIECES = T.StructType(
    [T.StructField("section_id", T.LongType()), T.StructField("piece_no", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("piece", T.StringType())]
)


def _split_batches(batches):
    for pdf in batches:
        rows = []
        for sid, text, limit, overlap in zip(pdf["section_id"], pdf["content"], pdf["max_chars"], pdf["overlap_chars"]):
            rows += [(sid, k, a, b, text[a:b]) for k, (a, b) in enumerate(cuts(text, int(limit), int(overlap)))]
        yield pd.DataFrame(rows, columns=["section_id", "piece_no", "start", "end", "piece"])


def split_texts(texts: DataFrame) -> DataFrame:
    """(section_id, piece_no, start, end, piece) from (section_id, content, max_chars, overlap_chars).

    Texts within their limit, null texts and null limits give no rows; a null overlap counts as 0.
    """
    big = texts.filter("content IS NOT NULL AND max_chars IS NOT NULL AND length(content) > max_chars")
    big = big.select(F.col("section_id").cast("long"), "content", "max_chars", F.coalesce("overlap_chars", F.lit(0)).alias("overlap_chars"))
    return big.mapInPandas(_split_batches, _PIECES)


def limited_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with the limits of their domain (a section without a known domain has none)."""
    s = spread(table(spark, sf_dir, "base_sections").select("section_id", "domain", "content"), parallelism(spark))
    return s.join(table(spark, sf_dir, "split_limits").select("domain", "max_chars", "overlap_chars"), "domain")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every section that had to be cut: those the splitter gave a first piece."""
    return split_texts(limited_sections(spark, sf_dir)).filter("piece_no = 0").select("section_id")


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every section that is longer than its domain allows."""
    return split_texts(limited_sections(spark, sf_dir))


QUERIES = {"p4_found": p4_found, "p4_pieces": p4_pieces}
SQL = {
    "p4_found": "SELECT s.section_id FROM base_sections s JOIN split_limits l USING (domain) WHERE length(s.content) > l.max_chars",
}
