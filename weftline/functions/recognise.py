"""Recognition inside cells and lines: composites, labels, families, boxes, escapes, stamps."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X

# Labels of header fields that are no values.
LABELS = ("manufacturer", "supplier", "part number", "part no", "notice number", "document number", "revision", "rev", "date", "issue date", "title", "subject", "customer", "page")
# What an affected section lists, and words of a line that counts parts.
AFFECTED_NOUNS = ("model", "models", "part", "parts", "device", "devices")
PARTS_CUES = ("part", "model number", "device")
# What a stated number may count, and the greatest count that is believed.
COUNTED = ("part", "parts", "device", "devices", "mpn", "mpns", "product", "products", "item", "items", "sku", "skus")
MOST_STATED = 5000
NOTICE_NUMBER = r"(?i)\b((?:PCN|PDN|PTN)[-#: ]{0,2}[A-Z0-9][A-Z0-9.-]{3,20})\b"


@F.pandas_udf(T.StringType())
def _folded(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKC", x).split()).casefold())


def concept_name(c: Column | str) -> Column:
    """A concept name normalised: presentation forms, white space, case (the only step that leaves the JVM)."""
    return _folded(X.col(c))


def concept_id(domain: Column | str, name: Column | str) -> Column:
    return F.concat(F.lit("concept_"), F.left(F.sha2(F.concat_ws("␟", F.upper(F.trim(F.regexp_replace(X.col(domain), r"\s+", " "))), concept_name(name)), 256), F.lit(16)))


def composite_parts(c: Column | str) -> Column:
    """The fragments of a cell split at comma and line break, if every one is part-shaped; else the cell alone."""
    s = X.col(c)
    parts = F.filter(F.transform(F.split(s, r",\s*\n|\n|,\s+"), lambda p: F.trim(p)), lambda p: p != "")
    ok = (F.size(parts) > 1) & F.forall(parts, lambda p: p.rlike(r"^[^\sa-z]{2,48}$") & p.rlike(r"\d"))
    return F.when(ok, parts).otherwise(F.array(F.trim(s)))


def is_label_echo(c: Column | str) -> Column:
    """Whether a value is nothing but field labels."""
    words = F.transform(F.split(F.lower(F.regexp_replace(X.col(c), r"[:#]+", "")), r"[/|]"), lambda w: F.trim(w))
    return (F.trim(X.col(c)) != "") & F.forall(words, lambda w: w.isin(*LABELS))


def names_affected_section(c: Column | str) -> Column:
    """Whether a text names an affected section: ``affected``, perhaps another word, then a noun; or a noun, then ``affected``.

    Words are parted by white space; what clings to the outer side of a word does not matter, what
    stands between the words does. Null is false.
    """
    w = F.split(F.lower(X.squeeze(c)), " ")
    n = F.size(w)
    triples = F.arrays_zip(w.alias("at"), F.slice(w, 2, n).alias("next"), F.slice(w, 3, n).alias("after"))

    def names(x: Column) -> Column:
        head = lambda y: F.regexp_extract(y, "^[a-z0-9_]*", 0).isin(*AFFECTED_NOUNS)
        last = F.regexp_extract(x["at"], "[a-z0-9_]*$", 0)
        between = x["next"].rlike("^[a-z][a-z0-9&/-]*$") & (F.length(x["next"]) <= 15)
        forward = (last == "affected") & (head(x["next"]) | (between & head(x["after"])))
        reverse = last.isin(*AFFECTED_NOUNS) & (F.regexp_extract(x["next"], "^[a-z0-9_]*", 0) == "affected")
        return F.coalesce(forward, F.lit(False)) | F.coalesce(reverse, F.lit(False))

    return F.coalesce(F.exists(triples, names), F.lit(False))


def family_models(c: Column | str) -> Column:
    """Array of (family, model) pairs ``FAMILY / MODEL`` whose model is part-shaped and has a letter.

    The text is cut at slashes; the last run of a piece and the first of the next make a pair. A run that
    fills its piece between two slashes belongs to a path or a list, not to a pair.
    """
    pieces = F.split(X.col(c), "/")
    n = F.size(pieces)
    two = F.slice(F.arrays_zip(pieces.alias("left"), F.slice(pieces, 2, n).alias("right")), 1, F.greatest(n - 1, F.lit(0)))
    run = r"[\w.+#-]+"

    def pair(x: Column, i: Column) -> Column:
        left, right = x["left"], x["right"]
        family, model = F.regexp_extract(left, rf"({run})\s*$", 1), F.regexp_extract(right, rf"^\s*({run})", 1)
        between = ((i > 0) & (F.rtrim(left) == family)) | ((i + 2 < n) & (F.ltrim(right) == model))
        good = ~between & family.rlike("^[A-Za-z0-9]") & model.rlike("^[A-Za-z0-9]") & F.length(family).between(2, 31) & F.length(model).between(4, 41)
        good = good & model.rlike("[0-9]") & model.rlike("[A-Za-z]") & family.rlike("[A-Za-z]") & ~model.endswith("-")
        return F.when(good, F.struct(family.alias("family"), model.alias("model")))

    return F.filter(F.transform(two, pair), lambda p: p.isNotNull())


def caption_count(c: Column | str) -> Column:
    """The greatest number in brackets at the end of a line that speaks of parts; one is a footnote.

    Thousands may be grouped by commas, in threes; anything else in the brackets is no number.
    """
    lines = F.filter(F.transform(F.split(X.col(c), "\n"), lambda x: F.rtrim(x)), lambda x: x.endswith(")") & X.contains_any(F.lower(x), PARTS_CUES))

    def number(line: Column) -> Column:
        inner = F.rtrim(F.substring_index(line, "(", -1), F.lit(")"))
        groups = F.split(inner, ",")
        digits = F.forall(groups, lambda g: g.rlike("^[0-9]+$"))
        grouped = (F.size(groups) == 1) | ((F.length(groups[0]) <= 3) & F.forall(F.slice(groups, 2, F.greatest(F.size(groups) - 1, F.lit(1))), lambda g: F.length(g) == 3))
        return F.when(digits & grouped & line.contains("("), F.replace(inner, F.lit(","), F.lit("")).try_cast("int"))

    return F.array_max(F.filter(F.transform(lines, number), lambda n: n >= 2))


def stated_count(c: Column | str) -> Column:
    """The number of parts that a text states first, or null: never a year, an identifier or an implausible number.

    The text is read as words parted by white space. A number is a word of digits and grouping commas (marks
    may precede it, but none that parts of an identifier have); within the next four words a counted
    noun must follow, with only plain words between. A bare number of four digits from 1900 to 2100 is a
    year, beyond MOST_STATED nothing is a count: the first number decides, no later one is tried.
    """
    w = F.split(X.squeeze(F.lower(X.col(c))), " ")
    n = F.size(w)
    five = F.arrays_zip(*[(w if k == 1 else F.slice(w, k, n)).alias(f"w{k}") for k in range(1, 6)])
    noun = lambda x: F.coalesce(F.regexp_extract(x, "^[a-z0-9_]*", 0).isin(*COUNTED), F.lit(False))
    plain = lambda x: F.coalesce(x.rlike(r"^[\w/.-]+$"), F.lit(False))

    def counts(x: Column) -> Column:
        number = x["w1"].rlike(r"^[^\w.\-/#,\u2010-\u2015\u2212]*[0-9][0-9,]*$") & (F.length(F.regexp_extract(x["w1"], "[0-9,]*$", 0)) <= 7)
        follows = noun(x["w5"])
        for k in (4, 3, 2):
            follows = noun(x[f"w{k}"]) | (plain(x[f"w{k}"]) & follows)
        return F.coalesce(number & follows, F.lit(False))

    raw = F.rtrim(F.regexp_extract(F.get(F.filter(five, counts), F.lit(0))["w1"], "[0-9][0-9,]*$", 0), F.lit(","))
    value = F.replace(raw, F.lit(","), F.lit("")).try_cast("int")
    year = value.between(1900, 2100) & (F.length(raw) == 4)
    return F.when(~year & (value <= MOST_STATED), value)


def notice_number(c: Column | str) -> Column:
    """The first printed notice number."""
    return F.nullif(F.regexp_extract(X.col(c), NOTICE_NUMBER, 1), F.lit(""))


def is_name_shape(c: Column | str) -> Column:
    """Whether a value could be a maker's name: letters, at most six words, no URL, no sentence."""
    s = F.trim(X.col(c))
    return (s != "") & (F.size(F.split(s, r"\s+")) <= 6) & s.rlike(r"\p{L}{2}") & ~s.rlike(r"(?i)https?://|www\.|@") & ~s.rlike(r"[.!?]\s+\p{Lu}")


def bounding_box(points: Column | str) -> Column:
    """[x1, y1, x2, y2] of a polygon; null for none."""
    p = X.col(points)
    x, y = F.transform(p, lambda q: q[0]), F.transform(p, lambda q: q[1])
    return F.when(F.size(p) > 0, F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)))


def escaped_iri(c: Column | str) -> Column:
    """Characters that an IRI must not hold as percent escapes."""
    s = X.col(c)
    for ch, code in (("%", "%25"), (" ", "%20"), ('"', "%22"), ("<", "%3C"), (">", "%3E"), ("\\", "%5C"), ("^", "%5E"), ("`", "%60"), ("{", "%7B"), ("|", "%7C"), ("}", "%7D")):
        s = F.replace(s, F.lit(ch), F.lit(code))
    return s


def escaped_literal(c: Column | str) -> Column:
    """A string as the inside of a quoted literal."""
    s = X.col(c)
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def answers(c: Column | str) -> Column:
    """Map of ``label: value`` lines; null words give no entry, the first of a label wins."""
    lines = F.filter(F.split(X.col(c), "\n"), lambda x: x.rlike(r"^\s*[A-Za-z][A-Za-z _]*:\s*\S"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.regexp_extract(x, r"^\s*([A-Za-z][A-Za-z _]*):", 1))).alias("k"), F.trim(F.regexp_extract(x, r":\s*(.*)$", 1)).alias("v")))
    good = F.filter(pairs, lambda p: ~F.lower(p["v"]).isin("null", "none", "n/a", "unknown", "-"))
    keys = F.array_distinct(F.transform(good, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.filter(good, lambda p: p["k"] == k)[0]["v"]))


def doc_title(path: Column | str) -> Column:
    """A title from a file name: no extension, separators to blanks, words capitalised."""
    return F.initcap(F.regexp_replace(F.regexp_replace(F.regexp_extract(X.col(path), r"([^/]*)$", 1), r"\.[A-Za-z0-9]{1,5}$", ""), r"[-_]+", " "))


STAMP = ("source", "kind", "domain", "ingest_id", "parser", "model", "policy", "revision")


def stamp(given: dict[str, Column]) -> Column:
    """The provenance block: eight fields, absent ones empty."""
    return F.struct(*[F.coalesce(given[k].cast("string"), F.lit("")).alias(k) if k in given else F.lit("").alias(k) for k in STAMP])
