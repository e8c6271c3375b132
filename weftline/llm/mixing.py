"""Mixing of sources to target shares (problem 8).

Sizes are tokens of a public tokenizer. The largest total is taken at which every source that has
documents can reach its share of it within its cap of repeats. A source's budget is some whole passes
over its documents and a remainder; which documents make up the remainder is decided by a hash of the
document's id: tokens are summed by source and hash bucket, the bucket in which the budget falls is
refined again, and a document is taken if its hash lies below the source's threshold. No sort, no
ranking, and nothing larger than buckets x sources numbers reaches the driver.
"""

from __future__ import annotations

import base64
import functools
from importlib.util import find_spec
from pathlib import Path

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, parallelism, table
from .spread import spread

#: Bits of the hash that one level of the histogram looks at, and the number of levels.
LEVEL_BITS, LEVELS = 8, 4
#: The vocabulary file (tiktoken ranks); another path may be given.
VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where a vocabulary lies: the path itself, the installed package of public tokenizers, or /opt/tokenizers."""
    if Path(name).exists():
        return name
    spec = find_spec("public_tokenizers")
    folder = Path(spec.origin).parent if spec and spec.origin else Path("/opt/tokenizers")
    return str(folder / name)


# Fixed value: the published split pattern of the byte-level vocabulary.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def with_tokens(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``tokens``, the number of tokens of ``text`` (0 for null)."""
    path = vocabulary_path(vocabulary)
    docs.sparkSession.sparkContext.addFile(path)  # the workers need no path of their own

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        enc = _encoding(SparkFiles.get(Path(path).name))
        return pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts])

    return docs.withColumn("tokens", count(text))


def budgets(sizes: dict[str, int], targets: dict[str, tuple[float, int]]) -> dict[str, tuple[int, float]]:
    """(whole passes, tokens of the remainder) by source.

    Sources without tokens take no part; the shares of the others are scaled up to sum to 1. The
    total is the largest at which none needs more than its cap.
    """
    live = {s: t for s, t in targets.items() if sizes.get(s, 0) > 0 and t[0] > 0 and t[1] > 0}
    if not live:
        return {}
    whole = sum(share for share, _ in live.values())
    total = min(cap * sizes[s] * whole / share for s, (share, cap) in live.items())
    out = {}
    for s, (share, cap) in live.items():
        budget = total * share / whole
        passes = min(cap, int(budget / sizes[s] + 1e-9))
        out[s] = (passes, max(0.0, budget - passes * sizes[s]) if passes < cap else 0.0)
    return out


def mix(docs: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, tokens, copies) of the documents that are in the mixture.

    ``docs``: (doc_id, source, text); ``targets``: (source, target_share, max_repeats), one row per
    source, read to the driver. Documents of null or unlisted sources, and without tokens, are left out.
    """
    spark = docs.sparkSession
    wanted = {r[0]: (float(r[1] or 0), int(r[2] or 0)) for r in targets.select("source", "target_share", "max_repeats").collect() if r[0] is not None}
    h = F.expr("xxhash64(doc_id, 'mix')")
    known = spread(docs.select("doc_id", "source", "text"), parallelism(spark)).join(targets.select("source").distinct(), "source", "left_semi")
    sized = with_tokens(known, "text", vocabulary)
    sized = materialize(sized.select("doc_id", "source", "tokens", F.shiftrightunsigned(h, 1).alias("h")).filter("tokens > 0"), "sized")
    sizes = {r[0]: r[1] for r in sized.groupBy("source").agg(F.sum("tokens")).collect()}
    plan = budgets(sizes, wanted)
    # Thresholds: of each source, the hash below which the remainder is taken.
    below = {s: (0, need) for s, (_, need) in plan.items() if need > 0}  # source -> (threshold so far, tokens still wanted)
    shift = 63
    for level in range(LEVELS):
        if not below:
            break
        shift -= LEVEL_BITS
        width = 1 << min(62, shift + LEVEL_BITS)
        floors = spark.createDataFrame([(s, t) for s, (t, _) in below.items()], "source string, floor long")  # a row per source
        inside = sized.join(floors, "source").filter((F.col("h") >= F.col("floor")) & (F.lit(not level) | (F.col("h") - F.col("floor") < F.lit(width))))
        histogram = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("tokens").alias("tokens"))
        by: dict[str, list] = {}
        for s, b, n in histogram.collect():  # at most 2**LEVEL_BITS rows per source
            by.setdefault(s, []).append((b, n))
        for s, (t, need) in below.items():
            for b, n in sorted(by.get(s, [])):
                t = b << shift
                if n > need:
                    break
                need -= n
                t = (b + 1) << shift
            below[s] = (t, need)
    plans = spark.createDataFrame([(s, passes, below.get(s, (0, 0))[0]) for s, (passes, _) in plan.items()], "source string, passes int, threshold long")
    out = sized.join(plans, "source").withColumn("copies", F.col("passes") + (F.col("h") < F.col("threshold")).cast("int"))
    return out.filter("copies > 0").select("doc_id", "source", "tokens", "copies")


def shares(mixed: DataFrame, docs: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target source: its target share, the share reached, tokens and documents used, repeats."""
    used = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used_tokens"), F.count("*").alias("used_docs"), F.max("copies").alias("most_copies"))
    have = docs.groupBy("source").agg(F.count("*").alias("source_docs"))
    t = targets.select("source", "target_share", "max_repeats").join(used, "source", "left").join(have, "source", "left")
    everything = F.expr("sum(used_tokens) OVER ()")  # one row per target source
    return t.withColumn("all_tokens", everything).select(
        "source", "target_share", F.coalesce(F.round(F.col("used_tokens") / F.col("all_tokens"), 6), F.lit(0.0)).alias("reached_share"),
        F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"), F.coalesce("used_docs", F.lit(0)).alias("used_docs"), F.coalesce("source_docs", F.lit(0)).alias("source_docs"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats",
    )


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture and how often each is used."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "source_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares the mixture reaches; a source without documents is reported with share 0."""
    docs, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "source_targets")
    return shares(materialize(mix(docs, targets), "mixed"), docs, targets)


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares}
