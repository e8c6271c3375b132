"""Alignment of concepts, course roll-ups, section membership and call planning."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import materialize, parallelism
from .components import connected_components

#: Proposals below this confidence are not made; the best of each course are kept.
LEAST_CONFIDENCE, TOP_PER_COURSE = 0.7, 50
#: Keys of a block that meet undivided, and pairs that a task looks at.
BLOCK, TASK_PAIRS = 8192, 1 << 24
#: Fewer keys than this can each hold more than 1/HOT_KEYS of what is taught.
HOT_KEYS = 300
# Confidence of lexical signals without vectors, strongest first.
SIGNALS = {"term": 0.70, "plural": 0.80, "acronym": 0.60, "overlap": 0.40}
# Fixed values: (base, weight) of the confidence with a cosine.
WITH_COSINE = {"term": (0.5, 0.5), "plural": (0.5, 0.5), "acronym": (0.4, 0.5), "overlap": (0.2, 0.6)}


def concept_records(rows: DataFrame) -> DataFrame:
    """One record per aligned key: (key, name, teach_count, n_courses, terms) from (name, course_id, slide, related_terms).

    The name is the one most slides teach, the shortest, the first; terms are the keys of all related terms.
    """
    r = rows.withColumn("key", X.align_key("name")).filter("key <> ''")
    names = r.groupBy("key", "name").agg(F.count("*").alias("n"))
    name = names.groupBy("key").agg(F.min_by("name", F.struct(-F.col("n"), F.length("name"), "name")).alias("name"))
    teach = r.groupBy("key").agg(F.countDistinct("course_id", "slide").alias("teach_count"), F.countDistinct("course_id").alias("n_courses"))
    terms = r.select("key", F.explode("related_terms").alias("t")).select("key", X.align_key("t").alias("t")).filter("t <> '' AND t <> key").distinct().groupBy("key").agg(F.array_sort(F.collect_list("t")).alias("terms"))
    return name.join(teach, "key").join(terms, "key", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))


def mutual_links(rows: DataFrame) -> DataFrame:
    """(a, b), a < b: keys that name each other among their related terms."""
    e = term_keys(rows).distinct()
    back = e.select(F.col("t").alias("key"), F.col("key").alias("t"))
    return e.join(back, ["key", "t"]).filter("key < t").select(F.col("key").alias("a"), F.col("t").alias("b"))


def aligned(rows: DataFrame) -> DataFrame:
    """(key, canonical, canonical_id): components of mutually related keys, named by their most taught name."""
    rec = materialize(concept_records(rows), "concepts")
    comp = connected_components(mutual_links(rows))
    c = rec.join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    name = c.groupBy("component").agg(F.min_by(F.struct("name", "key"), F.struct(-F.col("teach_count"), F.length("name"), "name")).alias("n"))
    named = c.join(name, "component")
    return named.select("key", F.col("n.name").alias("canonical"), F.concat(F.lit("canonical_"), F.left(F.sha2(F.col("n.key"), 256), F.lit(16))).alias("canonical_id"))


def keys_of(rows: DataFrame) -> DataFrame:
    """(key): the aligned keys of all names."""
    return rows.select(X.align_key("name").alias("key")).filter("key <> ''").distinct()


def term_keys(rows: DataFrame) -> DataFrame:
    """(key, t): keys and the keys of their related terms, as often as they occur."""
    e = rows.select(X.align_key("name").alias("key"), F.explode("related_terms").alias("t"))
    return e.select("key", X.align_key("t").alias("t")).filter("key <> '' AND t <> '' AND key <> t")


def named_pairs(keys: DataFrame, terms: DataFrame) -> DataFrame:
    """(a, b, o), a < b: pairs by term (0), plural (1) or acronym (2), the strongest of each. No more than a few a key and term:
    a plural key stands for at most four keys, and one short key equals given initials."""
    pair = lambda x, y, o: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.lit(o).alias("o"))
    term = terms.join(keys.select(F.col("key").alias("t")), "t").select(*pair("key", "t", 0))
    p = keys.groupBy(X.plural_key(F.col("key")).alias("p")).agg(F.collect_list("key").alias("of")).filter(F.size("of") > 1)
    plural = p.select("of", F.explode("of").alias("key")).select("key", F.explode("of").alias("other")).filter("key < other").select(*pair("key", "other", 1))
    long = keys.filter("key LIKE '% %'").select(F.col("key").alias("l"), X.initials(F.col("key")).alias("i"))
    short = keys.filter("key NOT LIKE '% %' AND length(key) BETWEEN 2 AND 6").select(F.col("key").alias("i"))
    acronym = short.join(long, "i").select(*pair("i", "l", 2))
    return term.unionByName(plural).unionByName(acronym).groupBy("a", "b").agg(F.min("o").alias("o"))


def held_pairs(pairs: DataFrame) -> DataFrame:
    """(key, held): every pair at the end that has fewer pairs, so that no list is longer than the root of twice the number of pairs."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    n = pairs.select("a", "b").join(ends.select(F.col("key").alias("a"), F.col("n").alias("na")), "a").join(ends.select(F.col("key").alias("b"), F.col("n").alias("nb")), "b")
    at_a = F.col("na") <= F.col("nb")
    return n.select(F.when(at_a, F.col("a")).otherwise(F.col("b")).alias("key"), F.when(at_a, F.col("b")).otherwise(F.col("a")).alias("other")).groupBy("key").agg(F.collect_list("other").alias("held"))


def overlap_pairs(keys: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b), a < b: keys that share a token of four letters and half of all their tokens, but for the pairs ``known`` (a, b).

    The blocks are the rarer half of a key's tokens and one more: two keys that share half of all their
    tokens share one of these, and the rarest token they share is among them on both sides. A pair is made
    in that block only. So pairs, whose number grows with the square of a block, are made once and pass no
    shuffle; blocks of more than ``BLOCK`` keys are divided on both sides.
    """
    spark = keys.sparkSession
    tok = keys.select("key", F.explode(F.array_distinct(F.split("key", " "))).alias("t"))
    df = tok.groupBy("t").agg(F.count("*").alias("df"))
    # Tokens of one key only are counted but not listed.
    ranked = tok.join(df, "t").groupBy("key").agg(F.count("*").cast("int").alias("n"), F.array_sort(F.collect_list(F.when(F.col("df") > 1, F.struct("df", "t")))).alias("r"))
    ranked = ranked.select("key", "n", F.col("r.t").alias("toks")).filter(F.size("toks") > 0).join(held_pairs(known), "key", "left")
    ranked = materialize(ranked, "ranked")
    blocks = F.floor(F.col("n") / 2).cast("int") + 1 - (F.col("n") - F.size("toks"))
    prefix = ranked.select("key", "n", "toks", "held", F.posexplode(F.slice("toks", F.lit(1), F.greatest(blocks, F.lit(0)))).alias("at", "t"))
    sizes = materialize(prefix.groupBy("t").agg(F.count("*").alias("size")).filter("size > 1"), "blocks")
    big = materialize(sizes.filter(F.col("size") > BLOCK).select("t", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")), "parts")
    work = sizes.agg(F.sum(F.col("size").cast("double") * F.col("size"))).first()[0] or 0.0
    tasks = max(4 * parallelism(spark), min(10_000, int(work / 2 / TASK_PAIRS)))
    placed = prefix.join(big, "t", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    cell = ["t", "i", "j"]
    x = placed.withColumn("i", F.col("part")).withColumn("j", F.explode(F.sequence("part", F.col("parts") - 1)))
    y = placed.withColumn("j", F.col("part")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("part"))))

    def side(rows: DataFrame, s: str) -> DataFrame:
        before, rest = F.slice("toks", F.lit(1), F.col("at")), F.slice("toks", F.col("at") + 2, F.size("toks"))
        bits = F.aggregate(before, F.lit(0).cast("long"), lambda m, t: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(t), F.lit(64)))))
        rows = rows.select(*cell, "key", "n", "at", "toks", "held").repartition(tasks, *cell)
        of = {"key": F.col("key"), "n": F.col("n"), "before": before, "bits": bits, "rest": rest, "text": F.array_join(rest, " "), "long": F.filter(rest, lambda t: F.length(t) >= 4), "held": F.col("held")}
        return rows.select(*cell, *(c.alias(s + name) for name, c in of.items()))

    held = lambda s, o: F.coalesce(F.array_contains(F.col(f"{s}held"), F.col(f"{o}key")), F.lit(False))
    # Bits and texts only spare most pairs the comparison of arrays.
    shared = F.when(F.col("xtext") == F.col("ytext"), F.size("xrest")).otherwise(F.size(F.array_intersect("xrest", "yrest"))) + 1
    alike = (
        ((F.col("i") < F.col("j")) | (F.col("xkey") < F.col("ykey")))
        & (F.least("xn", "yn") * 2 >= F.greatest("xn", "yn"))
        & ((F.col("xbits").bitwiseAND(F.col("ybits")) == 0) | ~F.arrays_overlap("xbefore", "ybefore"))
        & (shared * 3 >= F.col("xn") + F.col("yn"))
        & ((F.length("t") >= 4) | F.arrays_overlap("xlong", "ylong"))
        & ~held("x", "y") & ~held("y", "x")
    )
    return side(x, "x").join(side(y, "y"), cell).filter(alike).select(F.least("xkey", "ykey").alias("a"), F.greatest("xkey", "ykey").alias("b"))


def lexical_candidates(rows: DataFrame, least: float = 0.0) -> DataFrame:
    """(a, b, signal, confidence), a < b: the strongest lexical signal between the keys of (name, related_terms), found by blocking keys.

    term: one lists the other among its terms; plural: equal but for the plural; acronym: one is the
    other's initials; overlap: they share a token of four letters and half of all their tokens. Every
    signal is an equality join on its blocking key. Confidences below ``least`` are left out; overlaps, the
    weakest signal, are not even looked for then.
    """
    keys = materialize(keys_of(rows), "keys")
    named = named_pairs(keys, term_keys(rows))
    if SIGNALS["overlap"] >= least:
        named = materialize(named, "named")
        named = named.unionByName(overlap_pairs(keys, named).withColumn("o", F.lit(3)))
    return signalled(named).filter(F.col("confidence") >= least)


def signalled(pairs: DataFrame) -> DataFrame:
    """(a, b, signal, confidence) from (a, b, o), o being the place of the signal in ``SIGNALS``."""
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("o") + 1)
    return pairs.select("a", "b", of(SIGNALS).alias("signal"), of(SIGNALS.values()).alias("confidence"))


def cosine_confidence(signal: str, cosine) -> F.Column:
    """Confidence of a signal with a cosine: base + weight * max(cosine, 0)."""
    out = F.lit(None).cast("double")
    for name, (base, weight) in WITH_COSINE.items():
        out = F.when(F.col(signal) == name, base + weight * F.greatest(cosine, F.lit(0.0))).otherwise(out)
    return out


def shared_slides(candidates: DataFrame, taught: DataFrame) -> DataFrame:
    """Candidates (a, b, signal, confidence) with course_id and shared, the number of slides with both, for every course that has both.

    ``taught`` has one row (course_id, key, slides) per course and key. A pair is looked up in the courses of
    the end that fewer courses have. Only where both ends are among the keys that hold more than 1/HOT_KEYS
    of the rows - fewer than HOT_KEYS, by counting - are pairs made within each course, which shuffles none.
    """
    taught = taught.filter("course_id IS NOT NULL")
    width = materialize(taught.groupBy("key").agg(F.count("*").alias("w")), "widths")
    limit = (width.agg(F.sum("w")).first()[0] or 0) / HOT_KEYS
    end = lambda c: width.select(F.col("key").alias(c), F.col("w").alias(f"w{c}"))
    c = materialize(candidates.join(end("a"), "a").join(end("b"), "b"), "candidates")
    hot = (F.col("wa") > limit) & (F.col("wb") > limit)
    at_a = F.col("wa") <= F.col("wb")
    cold = c.filter(~hot).select(F.when(at_a, F.col("a")).otherwise(F.col("b")).alias("key"), F.when(at_a, F.col("b")).otherwise(F.col("a")).alias("other"), "signal", "confidence")
    cold = cold.join(taught.withColumnRenamed("slides", "mine"), "key").join(taught.withColumnRenamed("key", "other"), ["course_id", "other"])
    cold = cold.select("course_id", F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b"), "signal", "confidence", F.size(F.array_intersect("mine", "slides")).alias("shared"))
    own = taught.join(F.broadcast(width.filter(F.col("w") > limit).select("key")), "key")
    own = own.groupBy("course_id").agg(F.collect_list(F.struct("key", "slides")).alias("own")).select("course_id", "own", F.explode("own").alias("x"))
    own = own.select("course_id", "x", F.explode("own").alias("y")).filter("x.key < y.key").select("course_id", F.col("x.key").alias("a"), F.col("y.key").alias("b"), F.col("x.slides").alias("mine"), F.col("y.slides").alias("slides"))
    own = own.join(F.broadcast(c.filter(hot).drop("wa", "wb")), ["a", "b"]).select("course_id", "a", "b", "signal", "confidence", F.size(F.array_intersect("mine", "slides")).alias("shared"))
    return cold.unionByName(own)


def top_proposals(candidates: DataFrame, course: str, per: int = TOP_PER_COURSE) -> DataFrame:
    """The best ``per`` candidates of each course by shared slides, confidence, then names."""
    w = f"row_number() OVER (PARTITION BY {course} ORDER BY shared DESC, confidence DESC, a, b)"
    return candidates.withColumn("rank", F.expr(w)).filter(F.col("rank") <= per)


def course_sections(rows: DataFrame, wide: int = 20, deep: int = 10) -> DataFrame:
    """(course_id, section, depth, start, end): every ``wide`` slides, halves in them, and an open section from 1 on."""
    c = rows.select("course_id").distinct()
    top = c.select("course_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k")).select("course_id", F.concat(F.lit("s"), "k").alias("section"), F.lit(1).alias("depth"), (F.col("k") * wide + 1).alias("start"), ((F.col("k") + 1) * wide).alias("end"))
    sub = c.select("course_id", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("k")).select("course_id", F.concat(F.lit("s"), (F.col("k") / 2).cast("int"), F.lit("_"), F.col("k") % 2).alias("section"), F.lit(2).alias("depth"), (F.col("k") * deep + 1).alias("start"), ((F.col("k") + 1) * deep).alias("end"))
    return top.unionByName(sub).unionByName(c.select("course_id", F.lit("all").alias("section"), F.lit(0).alias("depth"), F.lit(1).alias("start"), F.lit(0).alias("end")))


def members(slides: DataFrame, sections: DataFrame) -> DataFrame:
    """Slides with every section they lie in; an end of 0 leaves a section open. An equality join on the course."""
    inside = (F.col("slide") >= F.col("start")) & ((F.col("end") == 0) | (F.col("slide") <= F.col("end")))
    return slides.join(sections, "course_id").filter(inside)


def coverage(slides: DataFrame, sections: DataFrame) -> DataFrame:
    """(course_id, section, concept, score, frequency): mean salience and number of slides of each concept."""
    return members(slides, sections).groupBy("course_id", "section", F.col("name").alias("concept")).agg(F.avg("salience").alias("score"), F.count("*").alias("frequency"))


def summaries(covered: DataFrame, top: int = 10) -> DataFrame:
    """(course_id, section, concepts): the ten best concepts by score, then name, of each section."""
    w = "row_number() OVER (PARTITION BY course_id, section ORDER BY score DESC NULLS LAST, concept)"
    r = covered.withColumn("r", F.expr(w)).filter(F.col("r") <= top)
    return r.groupBy("course_id", "section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "concept"))), lambda x: x["concept"]), "|").alias("concepts"))


def deepest_section(slides: DataFrame, sections: DataFrame) -> DataFrame:
    """(course_id, slide, section): the deepest section of each slide, the later start on ties; null outside all."""
    s = slides.select("course_id", "slide").distinct()
    best = members(s, sections).groupBy("course_id", "slide").agg(F.max_by("section", F.struct("depth", "start", "section")).alias("section"))
    return s.join(best, ["course_id", "slide"], "left")


def call_runs(placed: DataFrame, most: int = 8) -> DataFrame:
    """(course_id, run, piece, first_slide, last_slide, n): runs of slides of one section, split near-equally at ``most``."""
    w = "(PARTITION BY course_id ORDER BY slide)"
    r = placed.withColumn("changed", F.expr(f"CASE WHEN section <=> lag(section) OVER {w} AND lag(slide) OVER {w} IS NOT NULL THEN 0 ELSE 1 END"))
    r = r.withColumn("run", F.expr(f"sum(changed) OVER {w}"))
    p = "(PARTITION BY course_id, run ORDER BY slide)"
    r = r.withColumn("at", F.expr(f"row_number() OVER {p}") - 1).withColumn("len", F.expr("count(*) OVER (PARTITION BY course_id, run)"))
    size = F.ceil(F.col("len") / F.ceil(F.col("len") / most))
    return r.withColumn("piece", F.floor(F.col("at") / size)).groupBy("course_id", "run", "piece").agg(F.min("slide").alias("first_slide"), F.max("slide").alias("last_slide"), F.count("*").alias("n"))


def packed_calls(runs: DataFrame, most: int = 8) -> DataFrame:
    """(course_id, call, first_slide, last_slide, n): pieces joined greedily while a call stays within ``most``.

    Greedy packing is sequential; it works on pieces, of which a course has few, one course at a time.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        for r in pdf.sort_values("first_slide").itertuples():
            if out and out[-1][4] + r.n <= most:
                out[-1][3], out[-1][4] = r.last_slide, out[-1][4] + r.n
            else:
                out.append([r.course_id, len(out), r.first_slide, r.last_slide, r.n])
        return pd.DataFrame(out, columns=["course_id", "call", "first_slide", "last_slide", "n"])

    return runs.groupBy("course_id").applyInPandas(pack, "course_id string, call long, first_slide int, last_slide int, n long")


def survivors(rows: DataFrame, group: str, degree: str, key: str) -> DataFrame:
    """(group, survivor, members): of each duplicate group the row with most relations, then the smallest id."""
    g = rows.groupBy(group).agg(F.min_by(key, F.struct(-F.col(degree), key)).alias("survivor"), F.count("*").alias("members"))
    return g.filter("members > 1")
