"""The maker a document itself prints: contractions of a nominated name, and standalone names by gazetteer or shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: A name key shorter than this identifies nobody; a name has at most so many words.
LEAST_KEY, MOST_WORDS = 4, 3
# Element types in which a name stands alone.
STANDALONE = ("Title", "UncategorizedText")
# Words of headings of a notice.
HEADING_WORDS = tuple(
    (
        "affected approval approvals attachment authorized available buy change changes contact contacts customer customers date dates description detail details device devices "
        "discontinuance discontinued distribution distributor document documents effective end eol figure form identification impact implementation information issue issued item items "
        "last legend life notice notification note notes number obsolete order page part parts plan process product products purchase qualification quality reason recommendation "
        "recommendations reference references replacement requalify revision sample samples schedule scope series signature specification specifications spec status subject summary "
        "table time title type types"
    ).split()
)
# Words and signs that join others and are no part of a name on their shape alone.
CONNECTIVES = ("a", "an", "and", "at", "by", "for", "from", "in", "of", "on", "or", "the", "to", "with", "&", "+")
# Corporate suffixes that a printed name may carry beyond the gazetteer's form.
SUFFIXES = ("incorporated", "inc", "corporation", "corp", "company", "co", "llc", "ltd", "limited", "plc", "gmbh", "ag", "sa", "nv", "bv", "kk")
# Ends of host names that mark an address.
HOST_ENDS = ("com", "net", "org", "io", "co", "cn", "de", "jp", "tw", "uk")
EDGES = ".,;:!?()[]{}<>\"'“”‘’…"


def name_key(c: Column | str) -> Column:
    """Letters and digits only, lower case."""
    return F.regexp_replace(F.lower(F.coalesce(X.col(c), F.lit(""))), "[^a-z0-9]", "")


def edged(c: Column | str) -> Column:
    """A printed form without punctuation and blanks around it."""
    return F.trim(F.btrim(F.trim(F.coalesce(X.col(c), F.lit(""))), F.lit(EDGES)))


def is_address(c: Column | str) -> Column:
    """Whether a form holds a mail sign, a scheme, ``www.`` or the end of a host name."""
    s = F.lower(X.col(c))
    labels = F.split(s, r"\.")
    host = F.exists(F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(1))), lambda x: F.regexp_extract(x, "^[a-z0-9_]*", 0).isin(*HOST_ENDS))
    www = F.exists(F.split(s, r"[^a-z0-9_.]+"), lambda w: w.startswith("www."))
    return s.contains("@") | s.contains("://") | www | host


def is_name_shaped(c: Column | str) -> Column:
    """Whether a printed string may be a maker's name on its shape: short, no digit, no address, no word of headings or grammar."""
    s = X.col(c)
    words = F.filter(F.transform(F.split(s, r"\s+"), lambda w: F.lower(F.btrim(w, F.lit(EDGES)))), lambda w: w != "")
    plain = F.forall(words, lambda w: ~w.isin(*CONNECTIVES, *HEADING_WORDS))
    return (F.length(name_key(s)) >= LEAST_KEY) & ~s.rlike("[0-9]") & ~is_address(s) & (F.size(words) <= MOST_WORDS) & plain


def _best_form(forms: DataFrame, doc: str) -> DataFrame:
    """(doc, value): of (doc, form, key, at) the form with the longest key; the most frequent, then the first printed one."""
    g = forms.groupBy(doc, "key", "form").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    return g.groupBy(doc).agg(F.max_by("form", F.struct(F.length("key"), "n", -F.col("first"))).alias("value"))


def contracted_names(nominated: DataFrame, words: DataFrame, doc: str) -> DataFrame:
    """(doc, value): the printed word whose key begins the nominated name's key and goes beyond its first word.

    ``nominated``: (doc, name), one a document; ``words``: (doc, at, word) of its narrative text. Addresses and
    short keys do not count. A prefix join by equality: a nominated key meets the words through its own prefixes.
    """
    key, head = name_key("name"), name_key(F.element_at(F.split(F.trim("name"), r"\s+"), 1))
    n = nominated.filter("name IS NOT NULL").select(doc, key.alias("target"), F.greatest(F.length(head) + 1, F.lit(LEAST_KEY)).alias("least"))
    n = n.filter("length(target) >= least").select(doc, F.explode(F.expr("transform(sequence(least, length(target)), k -> left(target, k))")).alias("key")).distinct()
    w = words.filter("word IS NOT NULL").filter(~is_address("word")).select(doc, "at", edged("word").alias("form")).withColumn("key", name_key("form"))
    return _best_form(w.join(n, [doc, "key"]), doc)


def printed_names(elements: DataFrame, gazetteer: DataFrame, doc: str) -> DataFrame:
    """(doc, value, tier): the one name a document prints as an element of its own.

    ``elements``: (doc, at, type, text); ``gazetteer``: (name). Where an element is, whole and up to a corporate
    suffix, a name of the gazetteer, only such elements are candidates (tier gazetteer), else those shaped
    like a name (heuristic). A document is refused, and has no row, unless every candidate's key begins the longest.
    """
    e = elements.filter(F.col("type").isin(*STANDALONE)).select(doc, "at", edged("text").alias("form")).withColumn("key", name_key("form")).filter("form <> ''")
    cut = F.concat(F.array("key"), *[F.when(F.col("key").endswith(s), F.array(F.expr(f"left(key, length(key) - {len(s)})"))).otherwise(F.array().cast("array<string>")) for s in SUFFIXES])
    known = gazetteer.select(name_key("name").alias("known")).filter("known <> ''").distinct()
    forms = e.select("form", F.explode(F.array_distinct(cut)).alias("known")).distinct().join(known, "known", "left_semi").select("form").distinct().withColumn("listed", F.lit(True))
    c = e.join(forms, "form", "left").withColumn("listed", F.coalesce("listed", F.lit(False))).withColumn("shaped", is_name_shaped("form"))
    best = c.groupBy(doc).agg(F.max("listed").alias("any_listed"))
    c = c.join(best, doc).filter(F.when(F.col("any_listed"), F.col("listed")).otherwise(F.col("shaped")))
    longest = c.groupBy(doc).agg(F.max_by("key", F.struct(F.length("key"), "key")).alias("longest"))
    one = c.join(longest, doc).groupBy(doc).agg(F.bool_and(F.expr("startswith(longest, key)")).alias("one"), F.max("any_listed").alias("listed")).filter("one")
    return _best_form(c, doc).join(one, doc).select(doc, "value", F.when(F.col("listed"), "gazetteer").otherwise("heuristic").alias("tier"))


def completed_cuts(cuts: DataFrame, tokens: DataFrame, doc: str, least: int = 4) -> DataFrame:
    """(doc, mpn, whole): part numbers with the only longer part-shaped token of their document that begins or ends with them.

    ``cuts``: (doc, mpn), ``tokens``: (doc, token). A number that is printed as it stands, is shorter than
    ``least``, no part number, or continued by none or several tokens, is left as it is. A token meets
    its beginnings and ends by equality, so a document's tokens are never compared in pairs.
    """
    c = cuts.select(doc, F.col("mpn")).distinct().withColumn("piece", F.trim("mpn"))
    t = tokens.select(doc, "token").distinct()
    asked = c.filter((F.length("piece") >= least) & X.looks_like_mpn("piece")).join(t.select(doc, F.col("token").alias("piece")), [doc, "piece"], "left_anti")
    sides = F.expr(f"array_distinct(flatten(transform(sequence({least}, length(token) - 1), k -> array(left(token, k), right(token, k)))))")
    ends = t.filter((F.length("token") > least) & X.looks_like_mpn("token")).select(doc, "token", F.explode(sides).alias("piece"))
    g = asked.join(ends, [doc, "piece"]).groupBy(doc, "mpn").agg(F.min("token").alias("whole"), F.count("*").alias("n")).filter("n = 1")
    return c.select(doc, "mpn").join(g.select(doc, "mpn", "whole"), [doc, "mpn"], "left").select(doc, "mpn", F.coalesce("whole", "mpn").alias("whole"))
