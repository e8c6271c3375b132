"""Keyword-stuffed and link-list pages (problem 9).

A page is read as a sequence of function words and word classes. Function words are those that many
documents of some language hold; other words are classes by whether prose knows them, whether they
are capitalised, and whether they occurred shortly before; numbers, codes, links, tags and marks are
classes of their own, and the end of a segment tells whether it had function words. A trigram model of
these sequences is trained on prose - the documents with a prose-like share of function words - and
every segment of every document is scored under it. Segments whose perplexity is abnormally high, or
abnormally low, are no prose; a page is spam if they make up more than half of its text.

Counts and thresholds are taken over all documents. What is broadcast is bounded by the model, not by
the corpus: function words (for each language at most the mean number of words per document divided
by LEAST_DF), known words (for each language at most 1 / KNOWN_RATE) and the trigrams over function
words and classes. Rates are taken within a language, so the prose of a rare language stays known
however large the others are. Markup is no text: a link's tag reads as a link of its length, the ends of
blocks as line ends, other tags as blanks.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, parallelism, table
from .spread import spread_once

#: A word is a function word if this share of the documents of some language hold it.
LEAST_DF = 0.3
#: A document trains the model if it has so many words and at least this share of them are function words.
PROSE_WORDS, PROSE_SHARE = 8, 0.25
#: A word is known to prose at this rate of the words of some language's prose.
KNOWN_RATE, KNOWN_LEAST = 1e-5, 3
#: Scores beyond these quantiles of prose are abnormal, as such or for the length of their segment; the low one is reduced by a margin in nats.
LOW_Q, HIGH_Q, LOW_MARGIN = 0.0005, 0.998, 0.1
#: A page is spam above this share of abnormal text.
MOST_ABNORMAL = 0.5
#: Further copies of a text that is more than one in so many documents train nothing.
HOT_TEXTS = 1000
#: Words that count as repeated if they occurred among so many content words before; least words of a segment.
MEMORY, LEAST_WORDS = 14, 6
WEIGHTS = (0.62, 0.25, 0.12, 0.01)

_TOKEN = re.compile(
    r"(?P<U>(?:https?://|www\.)\S+|\b[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}(?:/\S*)?)"
    r"|(?P<H>[#@][^\W_]\w*)"
    r"|(?P<C>\b(?=[\w/-]*\d)(?=[\w/-]*[^\W\d_])[\w/-]+)"
    r"|(?P<N>\d+(?:[.,]\d+)*)"
    r"|(?P<W>[^\W\d_]+(?:['’-][^\W\d_]+)*)"
    r"|(?P<P>[^\w\s])"
)
# Tags are at most so long, so that a stray angle bracket costs no quadratic search.
_LINK = re.compile(r"<a\b[^<>]{0,4000}>", re.IGNORECASE)
_BLOCK = re.compile(r"</?(?:br|p|div|li|ul|ol|tr|table|h[1-6])\b[^<>]{0,4000}>", re.IGNORECASE)
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,4000}>")
_WRAP = re.compile(r"(?<=[^\W_])[ \t]*\n[ \t]*(?=[a-zà-öø-ÿ]+[\s,;])")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_LETTERS = re.compile(r"[^\W\d_]+")
_URL = re.compile(r"(?:https?://|www\.)\S+")
BEGIN = "^"


def unmarked(text: str) -> str:
    """The text without markup; a link's tag reads as a link of its length."""
    if "<" not in text:
        return text
    text = _LINK.sub(lambda m: " https://" + "x" * max(1, len(m[0]) - 8) + " ", text)
    return _TAG.sub(" ", _BLOCK.sub("\n", text))


def prose_words(text: str) -> list[str]:
    """The words of a text that are no part of links or markup."""
    return _LETTERS.findall(_URL.sub(" ", unmarked(text)).lower())


def segments(text: str) -> list[str]:
    """The sentences of each line; what is too short joins its neighbour within the line.

    A line that goes on in lower case after a line without a stop was wrapped and is no line of its own.
    """
    out = []
    for line in _WRAP.sub(" ", text).split("\n"):
        line = line.strip()
        if not line:
            continue
        held = ""
        for s in _SENTENCE.split(line):
            held = f"{held} {s}" if held else s
            if held.count(" ") + 1 >= LEAST_WORDS:
                out.append(held)
                held = ""
        if held:
            if out and len(line) > len(held):
                out[-1] += " " + held
            else:
                out.append(held)
    return out


class Reader:
    """Turns segments into class sequences; what a run of characters between blanks consists of is found once and kept."""

    def __init__(self, function: frozenset[str], known: frozenset[str]):
        self.function, self.known = function, known
        self.parts: dict[str, list[tuple[str, str | None]]] = {}

    def _parts(self, run: str) -> list[tuple[str, str | None]]:
        """(class, content word or None) of the tokens of a run without blanks."""
        out: list[tuple[str, str | None]] = []
        for m in _TOKEN.finditer(run):
            kind = m.lastgroup
            if kind == "W":
                w = m[0].lower()
                if w in self.function:
                    out.append((w, None))
                    continue
                prose = w in self.known or ("-" in w or "'" in w or "’" in w) and all(x in self.known for x in _LETTERS.findall(w))
                out.append((("K" if prose else "X") if m[0][0].isupper() else "k" if prose else "x", w))
            elif kind == "H":
                out.append(("H", m[0][1:].lower()))
            else:
                out.append((m[0] if kind == "P" else kind, None))
        if len(self.parts) > 300_000:
            self.parts.clear()
        self.parts[run] = out
        return out

    def classes(self, segment: str, memory: deque) -> list[str]:
        """The class sequence of a segment; ``memory`` holds the content words read last."""
        out, n_words, n_function = [], 0, 0
        if sum(map(str.isupper, segment)) > 0.5 * len(segment):  # shouted, not names
            segment = segment.lower()
        parts = self.parts
        for run in segment.split():
            for c, word in parts.get(run) or self._parts(run):
                if word is None:
                    if len(c) > 1 or c.isalpha() and c not in "UCN":  # a function word
                        n_words += 1
                        n_function += 1
                    out.append(c)
                elif c == "H":
                    out.append(c)
                    memory.append(word)
                else:
                    n_words += 1
                    out.append("R" if word in memory else c)
                    memory.append(word)
        if out:
            out.append("$" if n_words < 4 or n_function >= 0.15 * n_words else "$few" if n_function else "$none")
        return out


class Model:
    """An interpolated trigram model over classes."""

    def __init__(self, counts: dict[tuple[str, str, str], int]):
        self.tri, self.bi, self.uni = counts, Counter(), Counter()
        self.ctx2, self.ctx1 = Counter(), Counter()
        for (a, b, c), n in counts.items():
            self.ctx2[a, b] += n
            self.bi[b, c] += n
            self.ctx1[b] += n
            self.uni[c] += n
        self.total = sum(self.uni.values()) or 1
        self.size = len(self.uni) + 100
        self.memo: dict = {}

    def surprise(self, a: str, b: str, c: str) -> float:
        """Negative log probability of c after a, b."""
        key = (a, b, c)
        s = self.memo.get(key)
        if s is None:
            w3, w2, w1, w0 = WEIGHTS
            n2, n1 = self.ctx2.get((a, b), 0), self.ctx1.get(b, 0)
            p = w1 * self.uni.get(c, 0) / self.total + w0 / self.size
            p += w2 * self.bi.get((b, c), 0) / n1 if n1 else 0
            p += w3 * self.tri.get(key, 0) / n2 if n2 else 0
            s = -math.log(p)
            if len(self.memo) < 500_000:
                self.memo[key] = s
        return s

    def score(self, seq: list[str]) -> float:
        """Mean surprise (the log of the perplexity) of a sequence."""
        a = b = BEGIN
        total = 0.0
        for c in seq:
            total += self.surprise(a, b, c)
            a, b = b, c
        return total / max(1, len(seq))


def function_words(docs: DataFrame) -> DataFrame:
    """(word) of every function word of (l, text); by language as given, the empty one being one of its own."""
    n = docs.groupBy("l").agg(F.count("*").alias("n"))
    plain = F.regexp_replace(F.lower("text"), r"</?[a-z][^<>]{0,4000}>|(?:https?://|www\.)\S+", " ")
    words = docs.select("l", F.explode(F.array_distinct(F.split(plain, r"[^\p{L}]+"))).alias("word")).filter("word <> ''")
    df = words.groupBy("l", "word").agg(F.count("*").alias("df"))
    return df.join(n, "l").filter((F.col("df") >= LEAST_DF * F.col("n")) & (F.col("df") >= 3)).select("word").distinct()


def without_hot_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the further copies of texts that more than 1 / HOT_TEXTS of all documents are: a page
    that was copied a third of the corpus over makes no function words and trains no model.

    By counting there are fewer than HOT_TEXTS such texts, so their hashes are broadcast and no text is shuffled.
    """
    h = F.xxhash64("text")
    copies = docs.groupBy(h.alias("h")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    total = docs.count()
    hot = copies.filter(F.col("n") > max(1, total // HOT_TEXTS)).select("h", "first")
    return docs.withColumn("h", h).join(F.broadcast(hot), "h", "left").filter("first IS NULL OR doc_id = first").drop("h", "first")


def is_prose(words: list[str], function: frozenset[str]) -> bool:
    """Whether a document of these words has the function words of prose."""
    return len(words) >= PROSE_WORDS and sum(w in function for w in words) >= PROSE_SHARE * len(words)


def _count_words(function):
    def run(batches):
        for pdf in batches:
            counts: Counter = Counter()
            for lang, text in zip(pdf["l"], pdf["text"]):
                words = prose_words(text)
                if is_prose(words, function.value):
                    counts.update((lang, w) for w in words)
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["l", "word", "n"]).astype({"l": "object", "word": "object", "n": "int64"})

    return run


def _count_trigrams(function, known):
    def run(batches):
        reader = Reader(function.value, known.value)
        for pdf in batches:
            counts: Counter = Counter()
            for text in pdf["text"]:
                if not is_prose(prose_words(text), function.value):
                    continue
                memory: deque = deque(maxlen=MEMORY)
                for s in segments(unmarked(text)):
                    a = b = BEGIN
                    for c in reader.classes(s, memory):
                        counts[a, b, c] += 1
                        a, b = b, c
            yield pd.DataFrame([(a, b, c, n) for (a, b, c), n in counts.items()], columns=["a", "b", "c", "n"]).astype({"n": "int64"})

    return run


def _score(function, known, model):
    def run(batches):
        m, reader = model.value, Reader(function.value, known.value)
        for pdf in batches:
            rows = []
            for d, text in zip(pdf["doc_id"], pdf["text"]):
                prose = is_prose(prose_words(text), function.value)
                memory: deque = deque(maxlen=MEMORY)
                for s in segments(unmarked(text)):
                    if seq := reader.classes(s, memory):
                        rows.append((d, len(s), len(seq), m.score(seq), seq[-1] != "$", prose and seq[-1] == "$" and len(seq) > LEAST_WORDS))
            yield pd.DataFrame(rows, columns=["doc_id", "chars", "tokens", "score", "few", "prose"]).astype({"doc_id": "int64", "chars": "int64", "tokens": "int64", "score": "float64", "few": "bool", "prose": "bool"})

    return run


def scored_segments(docs: DataFrame) -> DataFrame:
    """(doc_id, chars, tokens, score, few, prose) of every segment; ``few`` if few of its words are function words, ``prose`` for the sentences of documents that trained the model."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    rows = spread_once(docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("l"), "text").filter("text IS NOT NULL"), parallelism(spark))
    once = without_hot_copies(rows)
    function = share(frozenset(r[0] for r in function_words(once).toLocalIterator()))
    words = materialize(once.select("l", "text").mapInPandas(_count_words(function), "l string, word string, n long").groupBy("l", "word").agg(F.sum("n").alias("n")), "words")
    total = words.groupBy("l").agg(F.sum("n").alias("total"))
    often = words.filter(F.col("n") >= KNOWN_LEAST).join(total, "l").filter(F.col("n") >= KNOWN_RATE * F.col("total")).select("word").distinct()
    known = share(frozenset(r[0] for r in often.toLocalIterator()))
    counts = once.select("text").mapInPandas(_count_trigrams(function, known), "a string, b string, c string, n long").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))
    model = share(Model({(r[0], r[1], r[2]): r[3] for r in counts.toLocalIterator()}))
    return rows.select("doc_id", "text").mapInPandas(_score(function, known, model), "doc_id long, chars long, tokens long, score double, few boolean, prose boolean")


def spam_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, chars, abnormal_chars, share): how much of each page is no prose.

    ``docs``: (doc_id, text, lang). Null texts, and texts without any token, have no row.
    """
    seg = materialize(scored_segments(docs), "segments")
    prose = seg.filter("prose")
    at = prose.agg(F.percentile_approx("score", [LOW_Q, HIGH_Q], 10_000).alias("q"), F.avg("score").alias("mean")).first()
    (low, high), mean = at["q"] or [0.0, 0.0], at["mean"] or 0.0
    # The mean over many tokens strays less from that of prose than the mean over few: long runs of
    # words without function words are judged by that, too.
    stray = (F.col("score") - mean) * F.sqrt("tokens")
    far = prose.agg(F.percentile_approx(stray, HIGH_Q, 10_000)).first()[0] or 0.0
    abnormal = F.when(~F.col("score").between(low - LOW_MARGIN, high) | (F.col("few") & (stray > far)), F.col("chars")).otherwise(0)
    return seg.groupBy("doc_id").agg(F.sum("chars").alias("chars"), F.sum(abnormal).alias("abnormal_chars")).withColumn("share", F.col("abnormal_chars") / F.col("chars"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are spam."""
    return spam_scores(table(spark, sf_dir, "documents")).filter(F.col("share") > MOST_ABNORMAL).select("doc_id")


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the share of its text that is no prose."""
    return spam_scores(table(spark, sf_dir, "documents")).select("doc_id", "chars", "abnormal_chars", F.round("share", 6).alias("share"))


QUERIES = {"p9_found": p9_found, "p9_scores": p9_scores}
