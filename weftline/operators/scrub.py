"""Scrubbing of identifying values with a verifiable ledger.

Allowlisted spans are kept, other part-like tokens are replaced by draws of the same shape. A draw is
a keyed hash of the original, so a value is replaced alike wherever it occurs and the result does not
depend on partitioning; only the key, which never leaves the closure, ties the two together.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import materialize

TOKEN = re.compile(r"[^\s|,;()\[\]<>]+")
LEAST = 4
ATTEMPTS = 64
UPPER, MARK, LOWER, DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "QXZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"


def draw(original: str, salt: bytes, attempt: int = 0) -> str:
    """A value of the same shape: its leading capitals from Q, X, Z, other characters class by class."""
    stream, n = b"", 0
    while len(stream) < len(original):
        stream += hmac.new(salt, f"{original}#{attempt}#{n}".encode(), hashlib.sha256).digest()
        n += 1
    out, lead = [], True
    for c, b in zip(original, stream):
        if c.isupper():
            out.append((MARK if lead else UPPER)[b % len(MARK if lead else UPPER)])
            continue
        lead = False
        out.append(LOWER[b % 26] if c.islower() else DIGIT[b % 10] if c.isdigit() else c)
    return "".join(out)


def is_candidate(token: str) -> bool:
    """Four characters or more with a letter and a digit, not longer than a part number, no date."""
    return LEAST <= len(token) <= 48 and any(c.isalpha() for c in token) and any(c.isdigit() for c in token) and not re.fullmatch(r"\d{4}-\d{2}-\d{2}(T.*)?", token)


def spans(text: str, phrases: list[str], patterns: list[str]) -> list[tuple[int, int]]:
    """Non-overlapping allowlisted spans: earlier first, then longer, then by the order of the rules."""
    found = []
    for k, p in enumerate(phrases):
        found += [(m.start(), -m.end(), k) for m in re.finditer(rf"(?<![^\W_]){re.escape(p)}(?![^\W_])", text, re.IGNORECASE)]
    for k, p in enumerate(patterns):
        found += [(m.start(), -m.end(), len(phrases) + k) for m in re.finditer(p, text)]
    out, at = [], 0
    for a, b, _ in sorted(found):
        if a >= at and -b > a:
            out.append((a, -b))
            at = -b
    return out


def candidates(text: str, phrases: list[str], patterns: list[str]) -> list[tuple[int, int, str]]:
    """(start, end, token) of what must be replaced."""
    kept = spans(text, phrases, patterns)
    out = []
    for m in TOKEN.finditer(text):
        t = m[0].rstrip(".,;:")
        a, b = m.start(), m.start() + len(t)
        if is_candidate(t) and not any(x < b and a < y for x, y in kept):
            out.append((a, b, t))
    return out


def scrubbed(blocks: DataFrame, key: str, text: str, salt: bytes, phrases: list[str] = (), patterns: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(blocks with ``scrubbed`` text, ledger (original_hash, shape, replacement, sites)).

    Two passes: distinct originals are drawn once (a draw that equals an original or another draw is
    drawn again), then each block's tokens are replaced. A null text stays null.
    """
    allow, pats = list(phrases), list(patterns)

    def find(batches):
        for pdf in batches:
            yield pd.DataFrame([(t,) for s in pdf[text] if s for _, _, t in candidates(s, allow, pats)], columns=["original"], dtype=object)

    originals = materialize(blocks.select(text).mapInPandas(find, "original string").groupBy("original").agg(F.count("*").alias("sites")), "originals")
    attempts = 0
    drawn = None
    left = originals.select("original")
    while attempts < ATTEMPTS:

        def once(batches, k=attempts):
            for pdf in batches:
                yield pdf.assign(replacement=[draw(o, salt, k) for o in pdf["original"]])

        now = left.mapInPandas(once, "original string, replacement string")
        taken = originals.select(F.col("original").alias("replacement"))
        if drawn is not None:
            taken = taken.unionByName(drawn.select("replacement"))
        w = F.expr("row_number() OVER (PARTITION BY replacement ORDER BY original)")
        good = now.join(taken, "replacement", "left_anti").withColumn("r", w).filter("r = 1").select("original", "replacement")
        good = materialize(good, "drawn")
        drawn = good if drawn is None else materialize(drawn.unionByName(good), "drawn")
        left = materialize(left.join(good, "original", "left_anti"), "left")
        attempts += 1
        if left.isEmpty():
            break
    else:
        raise RuntimeError("no free draw was found")

    def cut(batches):
        for pdf in batches:
            rows = []
            for i, s in zip(pdf[key], pdf[text]):
                if s is None:
                    continue
                at = 0
                for n, (a, b, t) in enumerate(candidates(s, allow, pats)):
                    rows.append((i, n, s[at:a], t))
                    at = b
                rows.append((i, 1_000_000, s[at:], None))
            yield pd.DataFrame(rows, columns=[key, "n", "before", "original"])

    kind = dict(blocks.dtypes)[key]
    pieces = blocks.select(key, text).mapInPandas(cut, f"{key} {kind}, n int, before string, original string")
    put = pieces.join(drawn, "original", "left").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "before", "replacement"))).alias("p"))
    whole = put.select(key, F.array_join(F.transform("p", lambda x: F.concat(x["before"], F.coalesce(x["replacement"], F.lit("")))), "").alias("scrubbed"))
    ledger = originals.join(drawn, "original").select(X.redacted("original").alias("original"), X.shape("original").alias("shape"), "replacement", "sites")
    return blocks.join(whole, key, "left"), ledger


def ledger_checks(blocks: DataFrame, ledger: DataFrame, key: str, text: str, originals: DataFrame | None = None) -> DataFrame:
    """(check, failures) of a scrubbed result: shapes kept, replacements distinct, lengths kept, nothing leaked."""
    length = blocks.filter(F.length(text) != F.length("scrubbed")).agg(F.count("*").alias("failures")).select(F.lit("length").alias("check"), "failures")
    shape = ledger.filter(F.col("shape") != X.shape("replacement")).agg(F.count("*").alias("failures")).select(F.lit("shape").alias("check"), "failures")
    twice = ledger.groupBy("replacement").agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("failures")).select(F.lit("distinct").alias("check"), "failures")
    same = ledger.filter(F.col("original") == X.redacted("replacement")).agg(F.count("*").alias("failures")).select(F.lit("changed").alias("check"), "failures")
    return length.unionByName(shape).unionByName(twice).unionByName(same)
