"""Evaluation items that leak into a corpus (problem 7).

Texts become sequences of word hashes. Windows of the evaluation items and of the documents are
embedded by CGK random walks: the walk reads a window's words and steps on by a random bit of the word
it has just read, so that an inserted, dropped or changed word shifts only a short stretch of the
output and edit distance becomes Hamming distance. Keys sample some positions of the output; two
windows with few edits agree in one of the repeated samples with high probability. Whatever shares a
key is verified by an exact local alignment.

The items are the query set. Up to BLOCK_ITEMS are broadcast, and one scan of the documents finds and
verifies candidates, so no document is shuffled. More items stay distributed: one scan of the documents emits the
keys that a broadcast bitmap of bounded size may know, these meet the items' keys by equality, and only documents
with enough of an item's keys are read again to be verified. Either way gives the same pairs.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, parallelism, table
from .spread import spread

#: Window lengths in words; an item uses the longest that fits into four fifths of a third of it.
WINDOWS = (12, 8, 5, 3, 1)
#: Walks, samples per walk and positions per sample. A window with one changed word out of twelve is met
#: by a single sample with probability of about a fifth, and a passage has several such windows.
WALKS, SAMPLES, POSITIONS = 2, 5, 6
#: A passage counts from this share of the item's words on, with at most this share of them changed.
LEAST_SHARE, MOST_CHANGED = 1 / 3, 0.15
#: Shared keys must cover this share of the least passage; neighbouring keys may shift by so many words.
LEAST_COVER, DRIFT = 0.75, 8
#: Items that are broadcast, words of one batch and bits of the bitmap at most: bounds on memory, not on the work done.
BLOCK_ITEMS, BATCH_WORDS, MOST_BITS = 5000, 24_000, 27
#: Begins of a passage that are aligned together: a bound on memory.
BEGINS = 128
_INNER = re.compile(r"[\W_]+")
_PAD = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20_240_607)
_ODD = _RNG.integers(1, 2**63, size=(WALKS, 64), dtype=np.uint64) | np.uint64(1)
_MIX = _RNG.integers(1, 2**63, size=(WALKS, SAMPLES, 64), dtype=np.uint64) | np.uint64(1)


def words(text: str) -> list[str]:
    """The words of a text (as white space parts it) without case, presentation forms and punctuation."""
    s = text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).casefold().replace("\u00ad", "")
    return [w for w in (x if x.isalnum() else _INNER.sub("", x) for x in s.split()) if w]


class Hasher:
    """64-bit numbers of words, kept for reuse."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, ws: list[str]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        known = self.known
        if len(known) > 500_000:
            known.clear()
        out = np.empty(len(ws), dtype=np.uint64)
        for i, w in enumerate(ws):
            h = known.get(w)
            if h is None:
                h = known[w] = xxh3_64_intdigest(w)
            out[i] = h
        return out


def sample_positions(window: int) -> np.ndarray:
    """The output positions each sample looks at, by walk and sample; fixed for a window length."""
    rng = np.random.default_rng(window)
    k = min(POSITIONS, 2 * window)
    # Later outputs are mostly padding or the window's last word: samples are spread over the first 3/2.
    span = max(k, window + window // 2)
    return np.array([[np.sort(rng.choice(span, k, replace=False)) for _ in range(SAMPLES)] for _ in range(WALKS)])


def window_keys(h: np.ndarray, window: int) -> np.ndarray:
    """(WALKS * SAMPLES, len(h) - window + 1): the sampled keys of every window of a word sequence."""
    n = len(h) - window + 1
    if n <= 0:
        return np.empty((WALKS * SAMPLES, 0), dtype=np.uint64)
    at = sample_positions(window)
    keys = np.empty((WALKS * SAMPLES, n), dtype=np.uint64)
    padded = np.append(h, _PAD)
    starts = np.arange(n)
    for walk in range(WALKS):
        use = defaultdict(list)
        for s in range(SAMPLES):
            for p in at[walk, s]:
                use[int(p)].append(s)
        acc = [np.full(n, (walk * SAMPLES + s + 1) * 0x9E3779B97F4A7C15 % 2**64, dtype=np.uint64) for s in range(SAMPLES)]
        off = np.zeros(n, dtype=np.int64)
        for t in range(max(use) + 1):
            value = padded[np.where(off < window, starts + off, len(h))]
            for s in use.get(t, ()):
                acc[s] = (acc[s] ^ (value * _MIX[walk, s, t])) * np.uint64(0xFF51AFD7ED558CCD)
                acc[s] ^= acc[s] >> np.uint64(29)
            off += ((value * _ODD[walk, t]) >> np.uint64(63)).astype(np.int64)
        for s in range(SAMPLES):
            keys[walk * SAMPLES + s] = acc[s]
    return keys


def passage(item: np.ndarray, doc: np.ndarray, share: float = MOST_CHANGED, enough: float = np.inf) -> tuple[int, int]:
    """(words of the item in the longest passage, errors in it) by an exact alignment from every begin.

    A passage begins and ends with a word that matches; at most ``share`` of its words of the item are
    changed, added or dropped. Among the longest the one with the fewest errors counts; the first of
    ``enough`` words ends the search.
    """
    n, m = len(item), len(doc)
    ramp = np.arange(m + 1, dtype=np.int32)
    far = np.int32(n + m + 1)
    best = (0, 0)
    for block in range(0, n, BEGINS):
        # One row for each begin that is still within its errors: the least errors up to each word of the document.
        begin, errors = np.empty(0, dtype=np.int64), np.empty((0, m + 1), dtype=np.int32)
        for i in range(block, n):
            hit = doc == item[i]
            ends = np.where(hit, errors[:, :-1], far).min(axis=1, initial=far)
            span = i + 1 - begin
            for x in np.flatnonzero(ends <= share * span).tolist():
                best = max(best, (int(span[x]), -int(ends[x])))
            if best[0] >= enough:
                return best[0], -best[1]
            row = np.full_like(errors, far)
            np.minimum(errors[:, :-1] + ~hit, errors[:, 1:] + 1, out=row[:, 1:])
            if i < block + BEGINS and hit.any():
                best = max(best, (1, 0))
                begin = np.append(begin, i)
                row = np.vstack([row, np.append(far, np.where(hit, 0, far)).astype(np.int32)])
            row = np.minimum.accumulate(row - ramp, axis=1) + ramp
            live = row.min(axis=1, initial=far) <= share * (n - begin)
            begin, errors = begin[live], row[live]
            if not len(begin) and i >= block + BEGINS - 1:
                break
    return best[0], -best[1]


def may_hold(item: np.ndarray, doc: np.ndarray, least: int) -> bool:
    """Whether enough words of some ``least`` or more in a row of the item occur in the document at all, which every passage needs."""
    if len(item) < least:
        return False
    spare = np.append(0.0, np.cumsum(np.isin(item, doc) - (1 - MOST_CHANGED)))
    return bool((spare[least:] - np.minimum.accumulate(spare[: len(spare) - least]) >= -1e-6).any())


def window_of(n: int) -> int:
    """The window length of an item of n words."""
    fits = [w for w in WINDOWS if w <= max(1, int(n / 3 * 0.8))]
    return fits[0] if fits else 1


class Items:
    """A block of evaluation items, ready for probing."""

    def __init__(self, rows: list[tuple[int, str]]):
        hasher = Hasher()
        self.items = {}
        by = defaultdict(list)
        for item_id, text in rows:
            h = hasher(words(text))
            if not len(h):
                continue
            self.items[item_id] = h
            by[window_of(len(h))].append(item_id)
        self.tables = {}
        for w, ids in by.items():
            keys, owner, pos = [], [], []
            for i in ids:
                k = window_keys(self.items[i], w)
                keys.append(k.ravel())
                owner.append(np.full(k.size, i, dtype=np.int64))
                pos.append(np.tile(np.arange(k.shape[1], dtype=np.int64), k.shape[0]))
            k, o, p = np.concatenate(keys), np.concatenate(owner), np.concatenate(pos)
            order = np.argsort(k, kind="stable")
            size = 1 << max(16, (5 * len(k)).bit_length())
            seen = np.zeros(size, dtype=bool)  # a first test by the low bits of a key
            seen[(k & np.uint64(size - 1)).astype(np.int64)] = True
            self.tables[w] = (k[order], o[order], p[order], seen)

    def candidates(self, h: np.ndarray, doc_of: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """(document index, item, begin, end, least and greatest diagonal) of stretches of h whose shared keys cover enough of an item.

        Enough is LEAST_COVER of what a passage needs; windows that hold a changed word may be missed.
        """
        out = []
        for w, (keys, owner, pos, seen) in self.tables.items():
            if len(h) < w:
                continue
            whole = doc_of[: len(h) - w + 1] == doc_of[w - 1 :]
            at, to = [], []
            for row in window_keys(h, w):
                may = np.flatnonzero(seen[(row & np.uint64(len(seen) - 1)).astype(np.int64)] & whole)
                lo, hi = np.searchsorted(keys, row[may]), np.searchsorted(keys, row[may], side="right")
                n = hi - lo
                at.append(np.repeat(may, n))
                to.append(np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n))
            j, k = np.concatenate(at), np.concatenate(to)
            if not len(j):
                continue
            d, item, p = doc_of[j], owner[k], pos[k]
            # A passage keeps near one diagonal (position in the document less position in the item).
            diagonal = j - p
            order = np.lexsort((diagonal, item, d))
            j, d, item, p, diagonal = j[order], d[order], item[order], p[order], diagonal[order]
            new = np.append(True, (d[1:] != d[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > DRIFT))
            run = np.cumsum(new)
            order = np.lexsort((p, run))
            j, d, item, p, run = j[order], d[order], item[order], p[order], run[order]
            edge = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            step = np.append(np.minimum(p[1:] - p[:-1], w), w)
            step[edge[1:] - 1] = w
            cover = np.add.reduceat(step, edge)
            need = np.array([LEAST_SHARE * LEAST_COVER * len(self.items[int(x)]) for x in item[edge]])
            for x in np.flatnonzero(cover >= need).tolist():
                e, f = int(edge[x]), int(edge[x + 1]) if x + 1 < len(edge) else len(j)
                near = j[e:f] - p[e:f]
                out.append((int(d[e]), int(item[e]), int(j[e:f].min()), int(j[e:f].max()) + w, int(near.min()), int(near.max())))
        return out

    def leaks(self, h: np.ndarray, doc_of: np.ndarray, first: dict[int, tuple[int, int]]) -> set[tuple[int, int]]:
        """(document index, item) of verified leaks."""
        found = set()
        for d, item, lo, hi, low, high in self.candidates(h, doc_of):
            if (d, item) in found:
                continue
            body = self.items[item]
            n = len(body)
            a, b = first[d]
            least = math.ceil(LEAST_SHARE * n)
            # A passage that its keys belong to strays from their diagonals by its errors at most: count matches there first.
            stray = max(3, int(MOST_CHANGED * n))
            base, width = low - stray, high - low + 2 * stray + 1
            lo_word, hi_word = max(a, base), min(b, base + n + width - 1)
            near_words, inside = np.full(n + width - 1, _PAD), np.zeros(n + width - 1, dtype=bool)
            near_words[lo_word - base : hi_word - base], inside[lo_word - base : hi_word - base] = h[lo_word:hi_word], True
            same = (sliding_window_view(near_words, width) == body[:, None]) & sliding_window_view(inside, width)  # by word of the item and diagonal
            met, plain = same.any(axis=1), False
            # A least passage with changed words only shows on one diagonal and needs no alignment.
            if n >= least:
                sums = np.vstack([np.zeros((1, width), dtype=np.int32), np.cumsum(same, axis=0, dtype=np.int32)])
                few = least - (sums[least:] - sums[:-least]) <= MOST_CHANGED * least
                plain = bool((few & same[: len(few)] & same[least - 1 :]).any())
            if met.sum() < (1 - MOST_CHANGED) * LEAST_SHARE * n:
                continue
            near = h[max(a, lo - n - DRIFT) : min(b, hi + n + DRIFT)]
            if plain or may_hold(body, near, least) and passage(body, near, enough=LEAST_SHARE * n)[0] >= LEAST_SHARE * n:
                found.add((d, item))
        return found


def _probe(broadcast):
    def run(batches):
        items, hasher = broadcast.value, Hasher()
        for pdf in batches:
            found: list[tuple[int, int]] = []
            ids, texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
            k = 0
            while k < len(ids):
                parts, doc_of, first, at = [], [], {}, 0
                while k < len(ids) and (not parts or at < BATCH_WORDS):
                    ws = hasher(words(texts[k]))
                    first[k] = (at, at + len(ws))
                    parts.append(ws)
                    doc_of.append(np.full(len(ws), k, dtype=np.int64))
                    at += len(ws)
                    k += 1
                found += items.leaks(np.concatenate(parts), np.concatenate(doc_of), first)
            yield pd.DataFrame({"doc_id": [ids[d] for d, _ in found], "item_id": [i for _, i in found]}, dtype="int64")

    return run


def _item_keys(batches):
    """(w, key, item_id, pos, need) of the items' windows; ``need`` is how many positions of a document's keys a leak must meet."""
    hasher = Hasher()
    for pdf in batches:
        parts = []
        for item_id, text in zip(pdf["item_id"], pdf["text"]):
            h = hasher(words(text))
            if len(h):
                w = window_of(len(h))
                k = window_keys(h, w)
                pos = np.tile(np.arange(k.shape[1], dtype=np.int64), k.shape[0])
                parts.append(pd.DataFrame({"w": w, "key": k.ravel().view(np.int64), "item_id": np.int64(item_id), "pos": pos, "need": max(1, math.ceil(LEAST_SHARE * LEAST_COVER * len(h) / w))}))
        yield pd.concat(parts).astype({"w": "int32"}) if parts else pd.DataFrame({"w": [], "key": [], "item_id": [], "pos": [], "need": []}).astype("int64").astype({"w": "int32"})


def _bitmap(bits: int):
    def run(batches):
        seen = np.zeros(1 << bits, dtype=bool)
        for pdf in batches:
            seen[(pdf["key"].to_numpy().view(np.uint64) & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
        yield pd.DataFrame({"bits": [np.packbits(seen).tobytes()]})

    return run


def _document_keys(known, windows: list[int]):
    def run(batches):
        seen, hasher = np.unpackbits(np.frombuffer(known.value, dtype=np.uint8)).view(bool), Hasher()
        low = np.uint64(len(seen) - 1)
        for pdf in batches:
            w_of, keys, docs = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"]):
                h = hasher(words(text))
                for w in windows:
                    k = window_keys(h, w).ravel()
                    k = np.unique(k[seen[(k & low).astype(np.int64)]])
                    w_of.append(np.full(len(k), w, dtype=np.int32))
                    keys.append(k.view(np.int64))
                    docs.append(np.full(len(k), doc_id, dtype=np.int64))
            yield pd.DataFrame({"w": np.concatenate(w_of), "key": np.concatenate(keys), "doc_id": np.concatenate(docs)})

    return run


def _verify(batches):
    for pdf in batches:
        hasher, found, held = Hasher(), [], (None, None)
        for doc_id, item_id, doc, item in zip(pdf["doc_id"], pdf["item_id"], pdf["doc"], pdf["item"]):
            if held[0] != (item_id, item):
                held = ((item_id, item), Items([(item_id, item)]))
            h = hasher(words(doc))
            if held[1].leaks(h, np.zeros(len(h), dtype=np.int64), {0: (0, len(h))}):
                found.append((doc_id, item_id))
        yield pd.DataFrame(found, columns=["doc_id", "item_id"]).astype("int64")


def _met_by_keys(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The leaks of any number of items, which stay distributed."""
    spark = rows.sparkSession
    keys = materialize(items.repartition(parallelism(spark)).mapInPandas(_item_keys, "w int, key long, item_id long, pos long, need long"), "keys")
    windows = [r[0] for r in keys.select("w").distinct().collect()]  # at most as many as WINDOWS
    bits = min(MOST_BITS, max(16, (5 * keys.count()).bit_length()))
    known = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in keys.select("key").coalesce(16).mapInPandas(_bitmap(bits), "bits binary").toLocalIterator():
        known |= np.frombuffer(bytes(r[0]), dtype=np.uint8)
    asked = rows.mapInPandas(_document_keys(spark.sparkContext.broadcast(known.tobytes()), windows), "w int, key long, doc_id long")
    # A window position counts once for a document, whatever keys it met by.
    met = asked.join(keys, ["w", "key"]).groupBy("doc_id", "item_id", "pos").agg(F.first("need").alias("need"))
    pairs = met.groupBy("doc_id", "item_id").agg(F.count("*").alias("n"), F.first("need").alias("need")).filter("n >= need").select("doc_id", "item_id")
    pairs = materialize(pairs, "pairs")
    texts = pairs.join(rows.withColumnRenamed("text", "doc"), "doc_id").join(items.withColumnRenamed("text", "item"), "item_id")
    return texts.repartition(parallelism(spark), "doc_id", "item_id").mapInPandas(_verify, "doc_id long, item_id long").distinct()


def leaks(docs: DataFrame, items: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id) of every document that holds a passage of an item.

    ``docs``: (doc_id, text); ``items``: (item_id, text). Null and wordless texts on either side match
    nothing; a document is reported once per item, however often it holds it; equal items are each
    reported. Up to ``block`` items are read to the driver.
    """
    spark = docs.sparkSession
    rows = spread(docs.select(F.col("doc_id").cast("long"), "text").filter("text IS NOT NULL"), parallelism(spark))
    asked = items.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    held = [(r[0], r[1]) for r in asked.limit(block + 1).collect()]
    if len(held) > block:
        return _met_by_keys(rows, asked)
    return rows.mapInPandas(_probe(spark.sparkContext.broadcast(Items(held))), "doc_id long, item_id long")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which evaluation items leaked into which documents."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each leaked item with the number of documents that hold it."""
    return p7_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("docs"))


QUERIES = {"p7_found": p7_found, "p7_items": p7_items}
