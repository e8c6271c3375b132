"""Noise in text from scanned pages (problem 6).

Pages: a boosted classifier of line pairs tells running headers, footers and page numbers from text by
their repetition within the book, their shape, numbers near them, and whether the text flows on across them; another
decides how the halves of a word broken at a line end are joined. Words that the corpus does not know
meet correction candidates through an inverted join of character q-grams, and a boosted ranker, trained
on simulated misreadings of the corpus's own words, chooses among them.

Part numbers: damaged values are folded to the house format; numbers of one procedure meet each other
through positional q-grams, and a number that misreads one the procedure has more often is replaced.

The models are fitted on the driver on at most SAMPLE rows each; all counts, candidates and decisions
cover all rows.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop, materialize, parallelism, table
from .boost import Booster
from .misreads import HOUSE, code_misreads, damage, explain, fold, fold_key, house_number
from .spread import spread
from .textdist import osa

#: Labelled rows a model is fitted on, at most.
SAMPLE = 6000
#: A book is a scan if text flows on across so large a share of its line ends.
WRAPPED = 0.2
#: Lines of so many characters are longer than a page is wide; a scan has at most this share of them.
LONG, MOST_LONG = 120, 0.25
#: A line is common to books if it stands in so many of them and in this share of all; sentences that recur are not.
COMMON_BOOKS, COMMON_SHARE = 3, 0.05
#: A word is trusted from this count on, however large the corpus.
TRUST_LEAST = 4
#: A candidate must be so many times as frequent as the word it replaces.
TIMES = 8
#: q-grams of words, and how many of a word's rarest must be looked up: three misreadings of at most
#: four grams each, or all, destroy fewer.
Q, RAREST = 3, 13
#: Words of so many characters have their folded whole as a q-gram; candidates may be so many characters longer or shorter.
SHORT, MOST_LONGER = 4, 3

_PAGE = re.compile(r"[\s\[(<|~*–—-]*(?:(?:[Pp]age|PAGE|Seite|SEITE|[Pp]g?\.?)\s*)?[0-9oOlISZB]{1,4}(?:\s*(?:of|OF|von|/)\s*[0-9oOlISZB]{1,4})?[\s\])>|~*–—-]*")
_DIGITLIKE = re.compile(r"[0-9oOlISsZzBi|]{1,4}")
HYPHENS = "-‐‑¬­"
_BROKEN = re.compile(rf"([^\W\d_][^\W\d_’'-]*(?:-[^\W\d_]+)*)([{HYPHENS}])\s*$")
_HALF = re.compile(r"[^\w]*([^\W_][^\s,;:.!?()\"“”]*)")
_OUTER = re.compile(r"^[^\w]+|[^\w]+$")
_ALPHA = re.compile(r"[^\W\d_]")


def line_key(line: str) -> str:
    """What repetitions of a running line share: no page number at its ends, no case, misreadings folded."""
    words = line.split()
    while len(words) > 1 and _DIGITLIKE.fullmatch(words[-1].strip("-–[]().")):
        words.pop()
    while len(words) > 1 and _DIGITLIKE.fullmatch(words[0].strip("-–[]().")):
        words.pop(0)
    return fold(" ".join(words))


def is_page_number(line: str) -> bool:
    return bool(_PAGE.fullmatch(line.strip())) and any(c.isdigit() for c in line)


LINES = "section_id long, package_id string, content_key string, line_no int, text string, key string, first boolean, flows boolean, upper_start boolean, stopped boolean, title_share double, numbered boolean, width double, page_shape boolean, numbers_near int, blank_near boolean"


def _line_batches(batches):
    for pdf in batches:
        rows = []
        for sid, pkg, ck, content in zip(pdf["section_id"], pdf["package_id"], pdf["content_key"], pdf["content"]):
            lines = content.split("\n")
            full = [i for i, x in enumerate(lines) if x.strip()]
            width = max((len(lines[i]) for i in full), default=1)
            at = {i: k for k, i in enumerate(full)}
            shaped = [is_page_number(lines[i]) for i in full]
            for i in full:
                x = lines[i].strip()
                k = at[i]
                before = lines[full[k - 1]].strip() if k else ""
                after = lines[full[k + 1]].strip() if k + 1 < len(full) else ""
                flows = bool(before and after) and before[-1] not in ".!?:;" and after[0].islower()
                words = [w for w in re.findall(r"[^\W_]+", x) if _ALPHA.search(w)]
                title = sum(w[0].isupper() for w in words) / len(words) if words else 0.0
                a, b = x.split()[0], x.split()[-1]
                numbered = bool(_DIGITLIKE.fullmatch(b) or _DIGITLIKE.fullmatch(a)) and "  " in x
                rows.append((sid, pkg, ck, i, lines[i], line_key(x), k == 0, flows, x[0].isupper() or x[0].isdigit(), x[-1] in ".!?;,:", title, numbered, len(x) / width, shaped[k], sum(shaped[max(0, k - 2) : k] + shaped[k + 1 : k + 3]), i == 0 or not lines[i - 1].strip() or i + 1 >= len(lines) or not lines[i + 1].strip()))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in LINES.split(", ")])


def lines_of(sections: DataFrame) -> DataFrame:
    """The non-blank lines of (section_id, package_id, content) with what can be told from their neighbours."""
    s = sections.filter("content IS NOT NULL").select(F.col("section_id").cast("long"), F.coalesce("package_id", F.lit("")).alias("package_id"), F.md5("content").alias("content_key"), "content")
    return spread(s, parallelism(sections.sparkSession)).mapInPandas(_line_batches, LINES)


def scanned(lines: DataFrame) -> DataFrame:
    """The ``lines`` of the books whose lines are those of scanned pages: sentences run on across them.

    A section without package is judged by itself.
    """
    book = lines.withColumn("alone", F.when(F.col("package_id") == "", F.col("section_id")))
    runs = book.groupBy("package_id", "alone").agg(F.count("*").alias("n"), F.sum(F.when(~F.col("stopped") & ~F.col("first"), 1).otherwise(0)).alias("open"), F.count_if(F.length("text") > LONG).alias("long"))
    scans = runs.filter((F.col("open") >= WRAPPED * F.col("n")) & (F.col("long") <= MOST_LONG * F.col("n")))
    b, s = book.alias("b"), scans.alias("s")
    return b.join(s, (F.col("b.package_id") == F.col("s.package_id")) & F.col("b.alone").eqNullSafe(F.col("s.alone")), "left_semi").drop("alone")


FURNITURE = ["share", "n_lines", "book_share", "first", "flows", "upper_start", "stopped", "title_share", "numbered", "width", "page_shape", "numbers_near", "blank_near"]


def with_repetition(lines: DataFrame) -> DataFrame:
    """``lines`` with the share of the book's different sections that hold the line's key, and the books that do."""
    at = lines.select("package_id", "key", "content_key", "line_no").distinct()
    texts = at.groupBy("package_id", "key", "content_key").agg(F.count("*").alias("times"))
    sizes = lines.select("package_id", "content_key").distinct().groupBy("package_id").agg(F.count("*").alias("sections"))
    per = texts.groupBy("package_id", "key").agg(F.count("*").alias("n_sections"), F.sum("times").alias("n_lines"))
    # A section that several books hold unchanged counts for the first of them only: a reprint is no running line.
    homes = texts.groupBy("key", "content_key").agg(F.min("package_id").alias("home"))
    books = homes.groupBy("key").agg(F.countDistinct("home").alias("books"))
    all_books = texts.groupBy("content_key").agg(F.min("package_id").alias("home")).agg(F.countDistinct("home")).first()[0] or 1
    stats = per.join(books, "key").join(sizes, "package_id").withColumn("share", F.col("n_sections") / F.col("sections"))
    stats = stats.withColumn("book_share", F.when(F.col("books") >= COMMON_BOOKS, F.col("books") / all_books).otherwise(0.0))
    return lines.join(stats, ["package_id", "key"])


def furniture_model(lines: DataFrame) -> Booster:
    """A classifier of running lines, fitted on lines whose repetition or shape alone tells what they are."""
    sure_yes = F.col("first") & (F.col("share") >= 0.7) & (F.col("sections") >= 3) & ~F.col("stopped") & (F.col("title_share") >= 0.5)
    sure_yes = sure_yes | ((F.col("book_share") >= COMMON_SHARE) & (F.col("title_share") > 0) & ~F.col("stopped") & F.col("upper_start") & (F.col("key") != "")) | (F.col("flows") & (F.col("share") >= 0.3) & (F.col("sections") >= 4) & F.col("upper_start"))
    # A line with nothing but a number is a page number where no other stands near it; columns of numbers are text.
    page = F.col("page_shape")
    sure_yes = F.when(page, F.col("numbers_near") == 0).otherwise(sure_yes)
    sure_no = F.when(page, F.col("numbers_near") >= 2).otherwise(F.col("stopped") | ~F.col("upper_start") | ((F.col("n_lines") == 1) & (F.col("book_share") < COMMON_SHARE) & ~F.col("first")))
    labelled = lines.withColumn("y", F.when(sure_yes & ~sure_no, 1).when(sure_no & ~sure_yes, 0)).filter("y IS NOT NULL")
    # A bounded sample by hash, the same whatever the partitioning.
    h = F.expr("xxhash64(package_id, section_id, line_no)")
    parts = [labelled.filter((F.col("y") == y) & (page == shaped)).orderBy(h).limit(SAMPLE // 4) for y in (0, 1) for shaped in (False, True)]
    pdf = reduce(DataFrame.unionByName, parts).select(*FURNITURE, "y").toPandas()
    return Booster().fit(pdf[FURNITURE].astype(float).to_numpy(), pdf["y"].to_numpy())


def classified_lines(lines: DataFrame) -> DataFrame:
    """(section_id, line_no, text, kind) of the lines of scanned books; kind: header, page_no or text."""
    spark = lines.sparkSession
    known = materialize(with_repetition(scanned(lines)), "repeated")
    model = spark.sparkContext.broadcast(furniture_model(known))

    @F.pandas_udf("string")
    def kind(text: pd.Series, *features: pd.Series) -> pd.Series:
        p = model.value.score(np.column_stack([f.astype(float).to_numpy() for f in features]))
        _, n, common, first, _, _, stopped = (f.astype(float).to_numpy() for f in features[:7])
        # What stands once in its book and is not common to books runs nowhere, unless it heads its page; sentences end, running lines do not.
        shaped = features[FURNITURE.index("page_shape")].to_numpy(dtype=bool)
        never = ~shaped & (first == 0) & ((n <= 1) & (common < COMMON_SHARE) | (stopped > 0))
        return pd.Series(np.where((p <= 0.5) | never, "text", np.where(shaped, "page_no", "header")))

    kinds = materialize(known.withColumn("kind", kind("text", *FURNITURE)).select("section_id", "line_no", "text", "kind"), "kinds")
    drop(known)
    return kinds


def core_of(token: str) -> str:
    """A token without the punctuation around it."""
    return _OUTER.sub("", token)


def _count_batches(batches):
    for pdf in batches:
        counts: Counter = Counter()
        for text in pdf["text"]:
            tokens = text.split()
            if tokens and tokens[-1][-1] in HYPHENS:
                tokens.pop()
            counts.update(w for w in map(core_of, tokens) if w and _ALPHA.search(w))
        yield pd.DataFrame(counts.items(), columns=["word", "n"]).astype({"word": "object", "n": "int64"})


TOKENS = "section_id long, line_no int, word string, left string, mark string, right string"


def _token_batches(batches):
    for pdf in batches:
        rows = []
        for sid, no, text, joined, following in zip(pdf["section_id"], pdf["line_no"], pdf["text"], pdf["after_hyphen"], pdf["following"]):
            m = _BROKEN.search(text)
            if m and following:
                half = _HALF.match(following)
                if half and _ALPHA.search(half[1]):
                    rows.append((sid, no, None, m[1], m[2], core_of(half[1])))
            tokens = text.split()
            if m and tokens:
                tokens.pop()
            if joined and tokens:
                tokens.pop(0)
            rows += [(sid, no, w, None, None, None) for w in {core_of(t) for t in tokens} if w and _ALPHA.search(w) and not HOUSE.fullmatch(w)]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in TOKENS.split(", ")])


def grams_of(word: str) -> list[str]:
    """The distinct q-grams of a padded word; of a short one, that a single misreading leaves no q-gram of, its folded whole too."""
    s = f"^{word.lower()}$"
    grams = {s[i : i + Q] for i in range(max(1, len(s) - Q + 1))}
    return sorted(grams | {f"~{fold_key(word)}"} if len(word) <= SHORT else grams)


@F.pandas_udf(T.StructType([T.StructField("grams", T.ArrayType(T.StringType())), T.StructField("folded", T.StringType())]))
def _grams_udf(words: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"grams": words.map(grams_of), "folded": words.map(fold_key)})


RANK = ["misreads", "edits", "log_n", "log_ratio", "digit_inside", "length", "same_start"]


def rank_features(word: str, known: str, n: float, own: float) -> list[float]:
    """What the ranker sees of a word and a candidate with their counts."""
    low = word if any(c.isdigit() for c in word) or not word.isupper() else word.lower()
    x = min(explain(low, known), explain(low[:1].lower() + low[1:], known))
    digits = any(c.isdigit() for c in word)
    return [x, osa(word.lower(), known, 4), np.log1p(n), np.log1p(n) - np.log1p(own), digits, len(word), word[:1].lower() == known[:1]]


def word_ranker(words: list[tuple[str, int]]) -> Booster:
    """A ranker of corrections, fitted on simulated misreadings of the given trusted words.

    Right pairs: a word and its misreading. Wrong pairs: a misreading and another near word, and right
    words (trusted ones, and names that resemble none) with their near words.
    """
    rng = random.Random(17)
    by: dict[str, list[tuple[str, int]]] = {}
    for w, n in words:
        for g in grams_of(w):
            by.setdefault(g, []).append((w, n))
    x, y = [], []
    for w, n in words:
        if len(x) >= SAMPLE:
            break
        if len(w) < 3:
            continue
        bad = damage(w, rng, rng.choice((1, 1, 1, 2)))
        near = [c for g in rng.sample(grams_of(w), min(4, len(grams_of(w)))) for c in rng.sample(by[g], min(2, len(by[g]))) if c[0] != w]
        if bad != w:
            own = rng.choice((1, 1, 2, 3, max(1, n // 50)))
            x.append(rank_features(bad, w, n, own))
            y.append(1)
            for c, m in near[:3]:
                x.append(rank_features(bad, c, m, own))
                y.append(0)
        for c, m in near[:2]:
            name = w[: len(w) // 2] + "".join(rng.choice("abdefgiklmnoprstuz") for _ in range(3)) + w[len(w) // 2 + 2 :]
            x.append(rank_features(name, c, m, 1))
            y.append(0)
        x.append(rank_features(name if near else w[::-1], w, n, 1))
        y.append(0)
    return Booster().fit(np.array(x), np.array(y)) if x else Booster()


def cased(read: str, right: str) -> str:
    """``right`` in the case of ``read``."""
    letters = [c for c in read if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return right.upper()
    return right[:1].upper() + right[1:] if read[:1].isupper() and not (read[0] == "I" and right[0] == "l") else right


def corrections(suspects: DataFrame, trusted: DataFrame) -> DataFrame:
    """(word, fixed): the chosen correction of each suspect (word, n) that has one.

    ``trusted``: (known, n). Candidates share one of the suspect's rarest q-grams; the best by the
    ranker is taken if it is probable, explained by misreadings, and TIMES as frequent.
    """
    spark = suspects.sparkSession
    # Words meet by q-gram and band of length, so that a common gram of short words meets no long ones.
    band = lambda n: F.floor(n / (MOST_LONGER + 1))
    index = trusted.withColumn("_g", _grams_udf("known")).select("known", "n", F.explode("_g.grams").alias("gram"), F.col("_g.folded").alias("target"), band(F.length("known")).alias("band"))
    index = materialize(index, "grams")
    df = index.groupBy("gram").agg(F.count("*").alias("df"))
    asked = suspects.withColumn("_g", _grams_udf("word")).select("word", "n", F.explode("_g.grams").alias("gram"), F.col("_g.folded").alias("folded")).join(df, "gram")
    rank = F.expr("row_number() OVER (PARTITION BY word ORDER BY df, gram)")
    bands = F.sequence(band(F.length("word") - MOST_LONGER), band(F.length("word") + MOST_LONGER))
    asked = asked.withColumn("r", rank).filter(F.col("r") <= RAREST).select("word", F.col("n").alias("own"), "gram", "folded", F.explode(bands).alias("band"))
    # What the table of misreadings explains has the same folded form: the others need no scoring.
    fits = (F.col("folded") == F.col("target")) & (F.col("n") >= TIMES * F.col("own")) & (F.abs(F.length("word") - F.length("known")) <= MOST_LONGER)
    pairs = asked.join(index, ["gram", "band"]).filter(fits).select("word", "own", "known", "n").distinct()
    sample = [(r[0], r[1]) for r in trusted.filter("length(known) >= 3").orderBy(F.expr("xxhash64(known)")).limit(SAMPLE).collect()]
    model = spark.sparkContext.broadcast(word_ranker(sample))

    def score(batches):
        for pdf in batches:
            keep = []
            for word, own, known, n in zip(pdf["word"], pdf["own"], pdf["known"], pdf["n"]):
                f = rank_features(word, known, n, own)
                if f[0] <= 3:
                    keep.append((word, known, f))
            if keep:
                p = model.value.score(np.array([f for _, _, f in keep], dtype=float))
                yield pd.DataFrame({"word": [w for w, _, _ in keep], "fixed": [cased(w, k) for w, k, _ in keep], "p": p, "misreads": [int(f[0]) for _, _, f in keep]})

    scored = pairs.repartition(parallelism(spark)).mapInPandas(score, "word string, fixed string, p double, misreads int").filter("p > 0.5 AND fixed <> word")
    best = materialize(scored.groupBy("word").agg(F.max_by("fixed", F.struct(-F.col("misreads"), "p", "fixed")).alias("fixed")), "best")
    drop(index)
    return settled(best, trusted)


@F.pandas_udf(T.StringType())
def _cased_udf(read: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([cased(a, b) for a, b in zip(read, right)], dtype=object)


def settled(fixes: DataFrame, trusted: DataFrame) -> DataFrame:
    """``fixes`` (word, fixed) whose ends are no misreadings themselves: in a large corpus these recur and are trusted.

    A trusted word leads on to its own correction where that is TIMES as frequent, so no chain is a circle.
    """
    known = lambda word, n: trusted.select(F.col("known").alias(word), F.col("n").alias(n))
    on = fixes.filter(F.col("word") == F.lower("word")).select(F.col("word").alias("via"), F.lower("fixed").alias("next"))
    on = materialize(on.join(known("via", "n_via"), "via").join(known("next", "n_next"), "next").filter(F.col("n_next") >= TIMES * F.col("n_via")).select("via", "next"), "onward")
    while not fixes.join(on, F.lower("fixed") == F.col("via"), "left_semi").isEmpty():
        step = fixes.join(on, F.lower("fixed") == F.col("via"), "left")
        fixes = materialize(step.select("word", F.when(F.col("next").isNull(), F.col("fixed")).otherwise(_cased_udf("word", F.coalesce("next", "fixed"))).alias("fixed")), "chosen")
    return fixes.filter("fixed <> word")


JOIN = ["log_joined", "log_hyphened", "log_left", "log_right", "soft"]


def join_model(words: list[tuple[str, int]]) -> Booster:
    """Decides whether two halves make one word or keep their hyphen; fitted on words broken on purpose."""
    rng = random.Random(23)
    count = dict(words)
    x, y = [], []
    for w, _ in words:
        if "-" in w:
            a, b = w.split("-", 1)
            soft, label = 0, 1
        elif len(w) >= 4:
            k = rng.randint(2, len(w) - 2)
            a, b, soft, label = w[:k], w[k:], rng.random() < 0.4, 0
        else:
            continue
        for _ in range(20 if label else 1):
            x.append([np.log1p(count.get(a + b, 0)), np.log1p(count.get(f"{a}-{b}", 0)), np.log1p(count.get(a, 0)), np.log1p(count.get(b, 0)), soft])
            y.append(label)
    return Booster().fit(np.array(x), np.array(y)) if x else Booster()


def repaired_joins(broken: DataFrame, counts: DataFrame, trusted: DataFrame) -> DataFrame:
    """(left, mark, right, fixed, known) of distinct broken words; ``known`` where the corpus has the result."""
    spark = broken.sparkSession
    low = F.lower
    c = lambda name: counts.select(F.col("word").alias(f"w_{name}"), F.col("n").alias(name))
    d = broken.select("left", "mark", "right").distinct()
    d = d.withColumns({"w_joined": low(F.concat("left", "right")), "w_hyphened": low(F.concat("left", F.lit("-"), "right")), "w_l": low("left"), "w_r": low("right")})
    for name in ("joined", "hyphened", "l", "r"):
        d = d.join(c(name), f"w_{name}", "left")
    sample = [(r[0], r[1]) for r in trusted.orderBy(F.col("known").contains("-").desc(), F.expr("xxhash64(known)")).limit(SAMPLE).collect()]
    model = spark.sparkContext.broadcast(join_model(sample))

    @F.pandas_udf("boolean")
    def hyphened(joined: pd.Series, hyph: pd.Series, left: pd.Series, right: pd.Series, mark: pd.Series) -> pd.Series:
        x = np.column_stack([np.log1p(s.fillna(0).astype(float)) for s in (joined, hyph, left, right)] + [(mark != "-").astype(float)])
        return pd.Series(model.value.score(x) > 0.5)

    d = d.withColumn("keep", hyphened("joined", "hyphened", "l", "r", "mark"))
    return d.select("left", "mark", "right", F.concat("left", F.when(F.col("keep"), F.lit("-")).otherwise(F.lit("")), "right").alias("fixed"), F.coalesce(F.when(F.col("keep"), F.col("hyphened")).otherwise(F.col("joined")), F.lit(0)).alias("known"))


def repair_content(sections: DataFrame) -> DataFrame:
    """(row_id, item_pos, noise, fixed) of the noise in scanned (section_id, package_id, content)."""
    lines = materialize(lines_of(sections), "lines")
    kinds = classified_lines(lines)
    furniture = kinds.filter("kind <> 'text'").select(F.col("section_id").alias("row_id"), F.col("line_no").alias("item_pos"), F.col("kind").alias("noise"), F.lit("").alias("fixed"))
    text = kinds.filter("kind = 'text'").select(
        "section_id", "line_no", "text",
        F.expr("lead(text) OVER (PARTITION BY section_id ORDER BY line_no)").alias("following"),
        F.coalesce(F.expr("lag(text) OVER (PARTITION BY section_id ORDER BY line_no)").rlike(rf"\p{{L}}[{HYPHENS}]\s*$"), F.lit(False)).alias("after_hyphen"),
    )
    tokens = materialize(text.mapInPandas(_token_batches, TOKENS), "tokens")
    counts = materialize(lines.select("text").mapInPandas(_count_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    lower = materialize(counts.groupBy(F.lower("word").alias("word")).agg(F.sum("n").alias("n")), "lower")
    trusted = materialize(
        counts.filter(~F.col("word").rlike(r"[\d_]") & ~F.col("word").rlike(r"\p{Ll}\p{Lu}")).groupBy(F.lower("word").alias("known")).agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= TRUST_LEAST),
        "trusted",
    )
    # Suspects: words of scanned text; a frequent misreading is no more trusted than a rare one, so all are
    # asked but those that occur often and have no digit inside a word - these are weighed by TIMES.
    words = tokens.filter("word IS NOT NULL").select("word").distinct()
    # Of two characters only those with a digit: a wrong letter leaves no trace in so short a word.
    suspects = words.join(counts, "word").filter((F.length("word") >= 3) | ((F.length("word") == 2) & F.col("word").rlike("[0-9]"))).select("word", "n")
    drop(lines)
    broken = materialize(repaired_joins(tokens.filter("left IS NOT NULL"), lower, trusted), "broken")
    drop(lower)
    odd = broken.filter("known = 0").select(F.col("fixed").alias("word"), F.lit(1).cast("long").alias("n")).distinct()
    fixes = materialize(corrections(suspects.unionByName(odd).groupBy("word").agg(F.min("n").alias("n")), trusted), "fixes")
    drop(counts, trusted)
    chars = tokens.filter("word IS NOT NULL").join(fixes, "word").select(F.col("section_id").alias("row_id"), F.col("line_no").alias("item_pos"), F.lit("char").alias("noise"), "fixed")
    whole = broken.withColumnRenamed("fixed", "word").join(fixes, "word", "left").select("left", "mark", "right", F.coalesce("fixed", "word").alias("fixed"))
    hyphens = tokens.filter("left IS NOT NULL").join(whole, ["left", "mark", "right"]).select(F.col("section_id").alias("row_id"), F.col("line_no").alias("item_pos"), F.lit("hyphen").alias("noise"), "fixed")
    return furniture.unionByName(hyphens).unionByName(chars).distinct()


@F.pandas_udf(T.StringType())
def _house_udf(values: pd.Series) -> pd.Series:
    return values.map(house_number)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _code_grams_udf(values: pd.Series) -> pd.Series:
    return values.map(lambda s: [f"{i}{s[i : i + Q]}" for i in range(len(s) - Q + 1)])


def code_ranker(numbers: list[str]) -> Booster:
    """Tells misreadings of a number from its sisters; fitted on simulated ones."""
    rng = random.Random(29)
    pairs = {"8": "3", "3": "8", "6": "5", "5": "6", "7": "1", "1": "7", "C": "G", "G": "C", "E": "F", "F": "E", "V": "W", "W": "V"}
    x, y = [], []
    for s in numbers:
        at = [i for i, c in enumerate(s) if c in pairs]
        for times in (1, 1, 2):
            if len(at) >= times:
                t = list(s)
                for i in rng.sample(at, times):
                    t[i] = pairs[t[i]]
                x.append([code_misreads("".join(t), s), sum(a != b for a, b in zip(t, s))])
                y.append(1)
        i = rng.choice([i for i, c in enumerate(s) if c.isdigit()])
        t = s[:i] + str((int(s[i]) + rng.choice((2, 4))) % 10) + s[i + 1 :]
        if code_misreads(t, s) == 99:
            x.append([99, 1])
            y.append(0)
        x.append([99, rng.randint(2, 6)])
        y.append(0)
    return Booster(trees=10, depth=2).fit(np.array(x), np.array(y)) if x else Booster()


def repair_codes(entries: DataFrame) -> DataFrame:
    """(row_id, item_pos, noise, fixed) of damaged (procedure_id, row_id, item_pos, value) part numbers."""
    spark = entries.sparkSession
    read = materialize(spread(entries, parallelism(spark)).withColumn("number", _house_udf("value")).filter("number IS NOT NULL").withColumn("procedure_id", F.coalesce("procedure_id", F.lit(""))), "numbers")
    counts = materialize(read.filter("value = number").groupBy("procedure_id", "number").agg(F.count("*").alias("n")), "house")
    all_numbers = read.select("procedure_id", "number").distinct().join(counts, ["procedure_id", "number"], "left").na.fill(0, ["n"])
    index = counts.withColumn("gram", F.explode(_code_grams_udf("number"))).select("procedure_id", "gram", F.col("number").alias("target"), F.col("n").alias("n_target"))
    pairs = all_numbers.withColumn("gram", F.explode(_code_grams_udf("number"))).join(index, ["procedure_id", "gram"]).filter("n_target > n AND target <> number").select("procedure_id", "number", "n", "target", "n_target").distinct()
    sample = [r[0] for r in counts.select("number").distinct().orderBy(F.expr("xxhash64(number)")).limit(SAMPLE // 5).collect()]
    model = spark.sparkContext.broadcast(code_ranker(sample))

    @F.pandas_udf("double")
    def score(number: pd.Series, target: pd.Series) -> pd.Series:
        x = np.array([[code_misreads(a, b), sum(p != q for p, q in zip(a, b))] for a, b in zip(number, target)], dtype=float).reshape(-1, 2)
        return pd.Series(np.where(x[:, 0] <= 3, model.value.score(x), 0.0))  # what no misreading explains is another number

    best = pairs.withColumn("p", score("number", "target")).filter("p > 0.5").groupBy("procedure_id", "number").agg(F.max_by("target", F.struct("n_target", "p", "target")).alias("target"))
    fixed = read.join(best, ["procedure_id", "number"], "left").withColumn("fixed", F.coalesce("target", "number"))
    return fixed.filter("fixed <> value").select("row_id", "item_pos", F.lit("char").alias("noise"), "fixed").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All noise in scanned sections and damaged part numbers, with the repair; equal rows once.

    Null and blank content, null lists and null entries give no rows.
    """
    sections = table(spark, sf_dir, "base_sections").select("section_id", "package_id", "content")
    content = repair_content(sections).select(F.lit("content").alias("field"), F.col("row_id"), F.col("item_pos"), "noise", "fixed")
    steps = table(spark, sf_dir, "mfg_steps").select("procedure_id", F.col("step_key").alias("row_id"), F.posexplode("internal_part_numbers").alias("item_pos", "value")).filter("value IS NOT NULL")
    codes = repair_codes(steps).select(F.lit("internal_part_numbers").alias("field"), "row_id", "item_pos", "noise", "fixed")
    return content.unionByName(codes)


def _rebuild(broken_marks: str):
    def run(batches):
        for pdf in batches:
            out = []
            for content, noise in zip(pdf["content"], pdf["noise"]):
                out.append(rebuilt(content, [] if noise is None else [(int(n["item_pos"]), n["noise"], n["fixed"]) for n in noise]))
            yield pd.DataFrame({"section_id": pdf["section_id"], "content": out})

    return run


def rebuilt(content: str, noise: list[tuple[int, str, str]]) -> str:
    """The text of a section as continuous paragraphs, its noise repaired."""
    lines = content.split("\n")
    by: dict[int, list[tuple[str, str]]] = {}
    for pos, kind, fixed in noise:
        by.setdefault(pos, []).append((kind, fixed))
    out: list[str] = []
    carry = None
    for i, line in enumerate(lines):
        kinds = by.get(i, [])
        if any(k in ("header", "page_no") for k, _ in kinds):
            continue
        if not line.strip():
            if out and out[-1] != "" and carry is None:
                out.append("")
            continue
        words = line.split()
        if carry is not None:
            m = _HALF.match(words[0])
            tail = words[0][m.end() :] if m else ""
            if m:
                tail = words[0][words[0].find(core_of(m[1])) + len(core_of(m[1])) :]
            words[0] = carry + tail
            carry = None
        for k, fixed in kinds:
            if k == "char":
                for j, w in enumerate(words):
                    c = core_of(w)
                    if c and c != fixed and explain(c if not c.isupper() else c.lower(), fixed.lower()) <= 3 and not c.islower() - fixed.islower():
                        words[j] = w.replace(c, fixed)
        h = [f for k, f in kinds if k == "hyphen"]
        if h:
            carry = h[0]
            lead = re.match(r"[^\w]*", words[-1])[0]
            carry = lead + carry
            words.pop()
        text = " ".join(words)
        if out and out[-1] != "":
            out[-1] = (out[-1] + " " + text).strip()
        else:
            out.append(text)
    if carry is not None:
        out.append(carry)
    return "\n".join(x if x else "" for x in out).replace("\n\n\n", "\n\n").strip()


def p6_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scanned section that had noise, as continuous paragraphs."""
    sections = table(spark, sf_dir, "base_sections").select("section_id", "package_id", "content")
    noise = repair_content(sections).groupBy("row_id").agg(F.collect_list(F.struct("item_pos", "noise", "fixed")).alias("noise"))
    both = sections.join(noise, F.col("section_id") == F.col("row_id")).select("section_id", "content", "noise")
    return both.mapInPandas(_rebuild(HYPHENS), "section_id long, content string")


def p6_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(step_key, numbers) of every step that had a damaged part number: its list with the right numbers in place."""
    steps = table(spark, sf_dir, "mfg_steps").select("procedure_id", "step_key", F.posexplode("internal_part_numbers").alias("item_pos", "value"))
    fixes = repair_codes(steps.filter("value IS NOT NULL").withColumnRenamed("step_key", "row_id")).select(F.col("row_id").alias("step_key"), "item_pos", "fixed")
    whole = steps.join(fixes, ["step_key", "item_pos"], "left").groupBy("step_key").agg(F.array_sort(F.collect_list(F.struct("item_pos", F.coalesce("fixed", "value").alias("v")))).alias("l"), F.count("fixed").alias("repaired"))
    return whole.filter("repaired > 0").select("step_key", F.transform("l", lambda x: x["v"]).alias("numbers"), "repaired")


QUERIES = {"p6_found": p6_found, "p6_repaired": p6_repaired, "p6_numbers": p6_numbers}
