"""Similarity join of short strings: sharded tries traversed with Levenshtein automata.

Two strings within OSA distance k share at least one of the 2k + 1 segments of one of them, shifted by
at most k (an edit damages one segment, a swap across a border two). Index strings go to one shard for
each of their segments, query strings to the shards of every segment they could share. A shard's index
strings form a trie; a query traverses it with the rows of its Levenshtein automaton, which are shared
by all strings with the same prefix and cut off where no state within k is left.

Rows are streamed in shard order, so a task holds one trie at a time. A hot shard is divided on both
sides into cells, so no task holds more than CELL strings of it, nor traverses them with more than CELL queries.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, parallelism

#: Index strings, and queries, that a task meets at once; larger shards are divided on both sides.
CELL = 20_000


def cut_points(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of nearly equal segments; empty segments where the string is shorter."""
    base, more = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        size = base + (i >= parts - more)
        out.append((at, size))
        at += size
    return out


def index_shards(s: str, k: int) -> list[str]:
    return [f"{len(s)}.{i}.{s[a : a + n]}" for i, (a, n) in enumerate(cut_points(len(s), 2 * k + 1))]


def query_shards(s: str, k: int) -> list[str]:
    """Shards of index strings that are not longer than ``s`` (the longer of a pair asks for the shorter)."""
    out = set()
    for length in range(max(1, len(s) - k), len(s) + 1):
        d = len(s) - length
        for i, (a, n) in enumerate(cut_points(length, 2 * k + 1)):
            for shift in range(-((k - d) // 2 + 1), (k + d) // 2 + 2):
                if 0 <= a + shift and a + shift + n <= len(s):
                    out.add(f"{length}.{i}.{s[a + shift : a + shift + n]}")
    return sorted(out)


class Trie:
    """Strings as nested dictionaries; the empty key holds a string that ends there."""

    def __init__(self):
        self.root: dict = {}

    def add(self, s: str) -> None:
        node = self.root
        for c in s:
            node = node.setdefault(c, {})
        node[""] = s

    def within(self, q: str, k: int) -> list[tuple[str, int]]:
        """All strings within OSA distance k of q."""
        out: list[tuple[str, int]] = []
        n = len(q)
        start = [j if j <= k else k + 1 for j in range(n + 1)]
        if "" in self.root and n <= k:
            out.append(("", n))
        over = k + 1
        stack = [(c, child, start, None, "", 1) for c, child in self.root.items() if c]
        while stack:
            c, node, above, above2, before, i = stack.pop()
            row = [over] * (n + 1)
            if i <= k:
                row[0] = i
            lo, hi = i - k if i > k else 1, i + k if i + k < n else n
            least = row[0]
            for j in range(lo, hi + 1):
                y = q[j - 1]
                d = above[j - 1] + (c != y)
                x = above[j] + 1
                if x < d:
                    d = x
                x = row[j - 1] + 1
                if x < d:
                    d = x
                if above2 is not None and j > 1 and c == q[j - 2] and before == y:
                    x = above2[j - 2] + 1
                    if x < d:
                        d = x
                if d < over:
                    row[j] = d
                    if d < least:
                        least = d
            if "" in node and row[n] <= k:
                out.append((node[""], row[n]))
            if least <= k or min(above) < k:  # a swap may still lead back from the row above
                for c2, child in node.items():
                    if c2:
                        stack.append((c2, child, row, above, c, i + 1))
        return out


def _stream(k: int):
    def run(batches):
        shard, held, trie = None, [], None
        for pdf in batches:
            rows = []
            for key, query, s in zip(pdf["shard"], pdf["query"], pdf["s"]):
                if key != shard:
                    shard, held, trie = key, [], None
                if not query:
                    held.append(s)
                    continue
                if not held:
                    continue
                if trie is None:
                    trie = Trie()
                    for x in held:
                        trie.add(x)
                rows += [(s, e, d) for e, d in trie.within(s, k) if e != s]
            yield pd.DataFrame(rows, columns=["q", "e", "d"]).astype({"q": "object", "e": "object", "d": "int32"})

    return run


def trie_join(queries: DataFrame, entries: DataFrame, k: int = 2) -> DataFrame:
    """(q, e, d): pairs of a query and another, not longer entry within OSA distance ``k``.

    ``queries``: (q), ``entries``: (e), distinct strings; nulls and empty strings match nothing.
    """
    spark = queries.sparkSession
    index_udf = F.pandas_udf(lambda s: s.map(lambda x: index_shards(x, k)), "array<string>")
    query_udf = F.pandas_udf(lambda s: s.map(lambda x: query_shards(x, k)), "array<string>")
    index = entries.filter("e <> ''").select(F.explode(index_udf("e")).alias("shard"), F.lit(False).alias("query"), F.col("e").alias("s"))
    ask = queries.filter("q <> ''").select(F.explode(query_udf("q")).alias("shard"), F.lit(True).alias("query"), F.col("q").alias("s"))
    # A shard holds a string at most once, so small sides have no hot shard.
    if max(entries.count(), queries.count()) > CELL:
        index, ask = divided(index, ask)
    rows = index.unionByName(ask).repartition(parallelism(spark), "shard").sortWithinPartitions("shard", "query")
    return rows.mapInPandas(_stream(k), "q string, e string, d int").distinct()


def divided(index: DataFrame, ask: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with their hot shards divided into cells."""
    sizes = index.unionByName(ask).groupBy("shard").agg(F.count_if(~F.col("query")).alias("held"), F.count_if("query").alias("asked"))
    hot = materialize(sizes.filter(F.greatest("held", "asked") > CELL).select("shard", *[F.ceil(F.col(c) / CELL).alias(c) for c in ("held", "asked")]), "hot")
    if not hot.isEmpty():
        # A hot shard becomes held x asked cells: a string goes to one part of its own side, for every part of the other.
        def cells(side: DataFrame, own: str, other: str) -> DataFrame:
            j = side.join(hot, "shard", "left").withColumn(own, F.expr(f"pmod(xxhash64(s), coalesce({own}, 1))"))
            j = j.withColumn(other, F.explode(F.expr(f"sequence(0L, coalesce({other}, 1) - 1)")))
            return j.select(F.concat_ws("#", "shard", F.col("held").cast("string"), F.col("asked").cast("string")).alias("shard"), "query", "s")

        index, ask = cells(index, "held", "asked"), cells(ask, "asked", "held")
    return index, ask
