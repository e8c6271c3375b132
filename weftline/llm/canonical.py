"""Mapping of freely typed values to a reference list (problem 3).

Token-level repair: every distinct token of the entries is joined to the reference vocabulary by edit
distance (an equality join on deletion neighbourhoods, then an exact check); an entry's corrected
tokens then meet the names that hold them in an inverted index and soft TF-IDF ranks the names.
All work is done on distinct spellings; rows meet their spelling's result at the end.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import join_counted
from ..session import materialize, table
from .textdist import allowed, deletions, osa

#: The least soft TF-IDF score at which an entry counts as naming a term.
LEAST_SCORE = 0.74
# Words that carry no meaning in an entry.
FILLERS = frozenset("a an the some any of for with and approved std standardised new spare our per acc to as no nr num number type grade qty pcs pc x".split())
# Words after which a letter or number is a revision, paragraph or issue, not part of the name.
_AFTER = re.compile(r"\b(?:rev(?:ision)?|para(?:graph)?|sect(?:ion)?|issue|amd|amendment|ed(?:ition)?|cl(?:ause)?|ch(?:apter)?)\b\.?\s*[-:]?\s*[0-9a-z](?:[0-9.]*)\b")
_THOUSANDS = re.compile(r"(?<=\d),(?=\d{3}\b)")
_WORD = re.compile(r"[^\W_]+")
_RUNS = re.compile(r"\d+|[^\W\d_]+")
_LOOKS = str.maketrans("oilsbz", "011582")
# The fillers of coded entries, whose short words may be parts of the code.
CODED_FILLERS = frozenset("no nr num number per acc to see iaw".split())


def tokens(text: str, coded: bool) -> list[list[str]]:
    """The tokens of an entry or name, each as a list of alternative readings.

    ``coded`` kinds are named by codes with numbers: a run of digits is a token that must be met
    exactly; letters in it are read as the digits they look like, or as a revision when they end it.
    """
    s = unicodedata.normalize("NFKC", text).casefold()
    out: list[list[str]] = []
    if not coded:
        for w in _WORD.findall(s.replace("'", "").replace("’", "")):
            if not re.fullmatch(r"\d+x?|x\d+", w) and w not in FILLERS:
                out.append([w])
        return out
    s = _AFTER.sub(" ", _THOUSANDS.sub("", s))
    for w in _WORD.findall(s):
        if not any(c.isdigit() for c in w):
            if w not in CODED_FILLERS:
                out.append([w])
            continue
        head = re.match(r"[^\W\d_]{2,}", w)
        rest = w[head.end() :] if head else w
        m = re.fullmatch(r"([oilsbz\d]*\d[oil]*)([^\W\d_]?)", rest)
        if head and head[0] not in CODED_FILLERS:
            out.append([head[0]])
        if not m:
            out += [[r] for r in _RUNS.findall(rest)]
            continue
        # As read; with a last letter as a digit; without the letters after the last digit, as a revision.
        readings = [m[1].translate(_LOOKS), rest.translate(_LOOKS), re.sub(r"\D+$", "", m[1]).translate(_LOOKS)]
        out.append(list(dict.fromkeys(r for r in readings if r.isdigit())))
    return out


_TOKENS = T.ArrayType(T.ArrayType(T.StringType()))


@F.pandas_udf(_TOKENS)
def _tokens_udf(text: pd.Series, coded: pd.Series) -> pd.Series:
    return pd.Series([tokens(t, c) for t, c in zip(text, coded)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _deletions_udf(s: pd.Series) -> pd.Series:
    return pd.Series([sorted(deletions(t, 0 if t.isdigit() else allowed(len(t)))) for t in s])


def token_similarity(typed: str, known: str) -> float:
    """How well a typed token reads as a known one: 1 for equal or plural, less by edits, 0 for another token."""
    if typed == known:
        return 1.0
    if typed.isdigit() or known.isdigit():
        return 0.0
    if typed in (known + "s", known + "es") or known in (typed + "s", typed + "es"):
        return 0.98
    k = min(allowed(len(typed)), allowed(len(known)))
    d = osa(typed, known, k)
    if d <= k:
        return 1.0 - d / max(len(typed), len(known))
    if typed[-1] == "s" and len(typed) > 4 and (d := osa(typed[:-1], known, 1)) <= 1:
        return 1.0 - d / len(known)
    return 0.0


def abbreviates(short: str, long: str) -> bool:
    """Whether a short code stands for a written-out word: same first letter and its letters in order."""
    if not (2 < len(short) <= 4 and len(long) > len(short) + 1 and short[0] == long[0]):
        return False
    it = iter(long)
    return all(c in it for c in short)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _written_out_udf(words: pd.Series) -> pd.Series:
    """The first letter with every two later ones in order: what a code of three letters and more begins with that stands for the word."""
    return words.map(lambda w: sorted({w[0] + a + b for i, a in enumerate(w[1:], 1) for b in w[i + 1 :]}))


@F.pandas_udf(T.DoubleType())
def _similarity_udf(typed: pd.Series, known: pd.Series) -> pd.Series:
    return pd.Series([0.95 if abbreviates(k, t) else token_similarity(t, k) for t, k in zip(typed, known)])


def reference_names(terms: DataFrame) -> DataFrame:
    """(kind, ref_id, name_id, pos, token) of every term and alias; kinds whose terms hold digits are coded."""
    coded = terms.groupBy("kind").agg((F.avg(F.col("term").rlike("[0-9]").cast("int")) > 0.5).alias("coded"))
    names = terms.select("kind", "ref_id", F.explode(F.array_distinct(F.concat(F.array("term"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("name"))
    named = names.filter("name IS NOT NULL AND trim(name) <> ''").join(coded, "kind")
    return named.select("kind", "ref_id", "coded", F.md5(F.concat_ws("|", "kind", F.col("ref_id").cast("string"), "name")).alias("name_id"), F.posexplode(_tokens_udf("name", "coded")).alias("pos", "alts")).select("kind", "ref_id", "coded", "name_id", "pos", F.col("alts")[0].alias("token"))


def map_entries(entries: DataFrame, terms: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """(kind, entry, ref_id, score) for each distinct (kind, entry); ref_id -1 where no term is meant.

    ``entries``: (kind, entry), distinct, entry neither null nor blank. ``terms``: (kind, ref_id, term,
    aliases). Ties go to the smaller ref_id. An entry without tokens, or of a kind that has no terms,
    maps to -1.
    """
    names = materialize(reference_names(terms), "names")
    n_names = names.select("kind", "name_id").distinct().groupBy("kind").agg(F.count("*").alias("nn"))
    idf = (
        names.groupBy("kind", "token").agg(F.countDistinct("name_id").alias("df")).join(n_names, "kind")
        .select("kind", "token", F.log(1 + F.col("nn") / F.col("df")).alias("idf"))
    )
    weighted = materialize(names.join(idf, ["kind", "token"]), "weighted")
    norms = weighted.groupBy("kind", "name_id").agg(F.sqrt(F.sum(F.col("idf") ** 2)).alias("norm"), F.collect_list(F.struct("pos", "token")).alias("seq"))
    # Tokens written together: every run of two or more adjacent tokens of a name, and the positions it stands for.
    runs = (
        norms.select("kind", F.array_sort("seq").alias("q"))
        .select("kind", F.explode(F.expr("flatten(transform(sequence(0, size(q) - 1), i -> transform(sequence(i, size(q) - 1), j -> slice(q, i + 1, j - i + 1))))")).alias("part"))
        .select("kind", F.array_join("part.token", "").alias("known"), F.col("part.token").alias("means"))
    ).distinct()
    vocab = materialize(runs.filter("size(means) = 1 OR NOT forall(means, t -> t rlike '^[0-9]+$')").withColumn("key", F.explode(_deletions_udf("known"))), "vocab")
    coded = names.groupBy("kind").agg(F.first("coded").alias("coded"))
    spelled = materialize(
        entries.join(coded, "kind").select("kind", "entry", F.posexplode(_tokens_udf("entry", "coded")).alias("epos", "alts")).select("kind", "entry", "epos", F.explode("alts").alias("typed")),
        "spelled",
    )
    # Repair of distinct tokens.
    typed = materialize(spelled.select("kind", "typed").distinct(), "typed")
    forms = typed.withColumn("form", F.explode(F.array_distinct(F.array("typed", F.expr("CASE WHEN length(typed) > 4 AND typed LIKE '%s' THEN left(typed, length(typed) - 1) ELSE typed END")))))
    near = forms.withColumn("key", F.explode(_deletions_udf("form"))).join(vocab, ["kind", "key"]).select("kind", "typed", "known", "means").distinct()
    # Codes that stand for a word written out: they meet by their first three letters, in coded kinds only.
    coded_kinds = coded.filter("coded").select("kind")
    short = vocab.filter("size(means) = 1 AND length(known) BETWEEN 3 AND 4 AND key = known").join(coded_kinds, "kind", "left_semi").select("kind", "known", "means", F.left("known", F.lit(3)).alias("start")).distinct()
    spelt_out = typed.filter("length(typed) > 4").join(coded_kinds, "kind", "left_semi").withColumn("start", F.explode(_written_out_udf("typed"))).join(short, ["kind", "start"]).select("kind", "typed", "known", "means")
    repaired = materialize(
        near.unionByName(spelt_out).distinct()
        .withColumn("sim", _similarity_udf("typed", "known")).filter("sim > 0.6"),
        "repaired",
    )
    # Soft TF-IDF of each entry against the names that hold one of its corrected tokens.
    met = spelled.join(repaired, ["kind", "typed"]).select("kind", "entry", "epos", "sim", F.explode("means").alias("token"))
    best = met.groupBy("kind", "entry", "epos", "token").agg(F.max("sim").alias("sim"))
    best = materialize(best, "best")
    # No score exceeds the root of the share that the tokens met have of the name's squared weights. So a name that
    # reaches ``least`` has a token met among its rarest: those without which the others stay below that share.
    rest = F.expr("sum(idf * idf) OVER (PARTITION BY kind, name_id ORDER BY idf, token, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    whole = F.expr("sum(idf * idf) OVER (PARTITION BY kind, name_id)")
    rarest = weighted.withColumns({"_rest": rest, "_whole": whole}).filter(F.col("_rest") >= least**2 * F.col("_whole") * (1 - 1e-9)).select("kind", "token", "name_id").distinct()
    asked = best.join(rarest, ["kind", "token"]).select("kind", "entry", "name_id").distinct()
    hits = asked.join(weighted.select("kind", "token", "name_id", "ref_id", "coded", "idf", "pos"), ["kind", "name_id"]).join(best, ["kind", "entry", "token"])
    per_token = hits.groupBy("kind", "entry", "ref_id", "name_id", "coded", "pos", "token").agg(F.max(F.struct("sim", "epos", "idf")).alias("b"))
    dots = per_token.groupBy("kind", "entry", "ref_id", "name_id", "coded").agg(
        F.sum(F.col("b.sim") * F.col("b.idf") ** 2).alias("dot"), F.collect_set("b.epos").alias("used"), F.count("*").alias("tokens_met"),
        F.max(F.col("token").rlike("^[0-9]+$")).alias("number_met"), F.sum(F.col("b.idf") ** 2).alias("met2"),
    )
    unknown = F.lit(1.0)  # the weight of a typed word that is in no name: it counts against the match
    sizes = spelled.groupBy("kind", "entry").agg(F.countDistinct("epos").alias("n_tokens"))
    scored = dots.join(norms.drop("seq"), ["kind", "name_id"]).join(sizes, ["kind", "entry"])
    extra = F.col("n_tokens") - F.size("used")
    scored = scored.withColumn("score", F.col("dot") / (F.col("norm") * F.sqrt(F.col("met2") + extra * unknown * F.col("met2") / F.col("tokens_met")))).filter("NOT coded OR number_met")
    top = scored.groupBy("kind", "entry").agg(F.max_by(F.struct("ref_id", "score"), F.struct("score", (-F.col("ref_id")).alias("r"))).alias("t"))
    return entries.join(top, ["kind", "entry"], "left").select(
        "kind", "entry", F.when(F.col("t.score") >= least, F.col("t.ref_id")).otherwise(F.lit(-1)).cast("bigint").alias("ref_id"), F.col("t.score").alias("score")
    )


FIELDS = [("mfg_steps", "step_key", "military_and_industry_standards", "standard"), ("mfg_steps", "step_key", "material_and_hardware_slang", "material"), ("slide_concepts", "concept_key", "related_terms", "concept")]


def typed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, kind, row_id, item_pos, entry) of every entry that is neither null nor blank."""
    parts = [
        table(spark, sf_dir, t).select(F.lit(c).alias("field"), F.lit(kind).alias("kind"), F.col(key).alias("row_id"), F.posexplode(c).alias("item_pos", "entry"))
        for t, key, c, kind in FIELDS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter(r"entry IS NOT NULL AND entry RLIKE '\\S'")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The term meant by each entry that is not spelled exactly like a term of its kind; -1 for none.

    Null lists, null and blank entries give no row; repeated rows each give their own.
    """
    terms = table(spark, sf_dir, "canonical_terms")
    typed = typed_entries(spark, sf_dir)
    spell = F.md5(F.concat_ws("|", "kind", "entry")).alias("spell")
    counted = materialize(typed.groupBy("kind", "entry").agg(F.count("*").alias("n")), "spellings")
    odd = counted.join(terms.select("kind", F.col("term").alias("entry")).distinct(), ["kind", "entry"], "left_anti")
    mapped = materialize(map_entries(odd.select("kind", "entry"), terms).join(counted, ["kind", "entry"]).select(spell, "ref_id", "n"), "mapped")
    total = counted.agg(F.sum("n")).first()[0] or 0
    return join_counted(typed.select("field", "row_id", "item_pos", spell), mapped, "spell", "n", total).select("field", "row_id", "item_pos", "ref_id")


QUERIES = {"p3_found": p3_found}
