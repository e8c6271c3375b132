"""Trust in header values: agreement of readings, recovery from printed text, refusal, nearest phrases and dates."""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import recognise as R
from ..functions import text as X
from ..functions.notices import dated_phrases

def scanned_dates(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, iso, source, phrase, governing, snippet) of all texts; null texts give nothing."""
    kind = dict(texts.dtypes)[key]

    def run(batches):
        for pdf in batches:
            rows = [(k, n, *r) for k, s in zip(pdf[key], pdf[text]) if s for n, r in enumerate(dated_phrases(s))]
            yield pd.DataFrame(rows, columns=[key, "n", "iso", "source", "phrase", "governing", "snippet"])

    return texts.select(key, text).mapInPandas(run, f"{key} {kind}, n int, iso string, source string, phrase string, governing string, snippet string")


def reading_key(c: Column | str) -> Column:
    """A reading folded for comparison: lower case, single blanks, no outer marks; empty is null."""
    return F.nullif(F.regexp_replace(X.squeeze(F.lower(X.col(c))), r"^[^\p{L}\p{Nd}]+|[^\p{L}\p{Nd}]+$", ""), F.lit(""))


def readings_agree(a: str, b: str) -> Column:
    """Whether two folded readings agree: equal, one the other's first words, or (from four letters) a subsequence.

    A null never agrees.
    """
    s = f"(CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END)"
    long = f"(CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END)"
    sub = f"aggregate(split({s}, ''), 1, (at_, ch_) -> CASE WHEN at_ = 0 OR ch_ = '' THEN at_ WHEN locate(ch_, {long}, at_) = 0 THEN 0 ELSE locate(ch_, {long}, at_) + 1 END) > 0"
    return F.expr(f"coalesce({a} = {b} OR (length({s}) >= 2 AND startswith({long}, concat({s}, ' '))) OR (length({a}) <> length({b}) AND length({s}) >= 4 AND {sub}), false)")


def recovered(readings: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, votes, tier): the value most readings print; ties go to the longer, then the first by order.

    tier 1 where all agree, 2 where it has a majority, 3 otherwise.
    """
    r = readings.select(key, F.col(value).alias("v"), reading_key(value).alias("k")).filter("k IS NOT NULL")
    g = r.groupBy(key, "k").agg(F.count("*").alias("votes"), F.max_by("v", F.struct(F.length("v"), "v")).alias("v"))
    t = g.groupBy(key).agg(F.max_by(F.struct("v", "votes"), F.struct("votes", F.length("k"), "k")).alias("b"), F.sum("votes").alias("all"), F.count("*").alias("kinds"))
    tier = F.when(F.col("kinds") == 1, 1).when(F.col("b.votes") * 2 > F.col("all"), 2).otherwise(3)
    return t.select(key, F.col("b.v").alias("value"), F.col("b.votes").alias("votes"), tier.alias("tier"))


def header_branches(headers: DataFrame, text_layer: DataFrame, key: str) -> DataFrame:
    """(key, value, branch): which source gives a header value.

    Healthy text layers outrank the model's value; on degraded ones the model's value stands only if
    the witness agrees with it, a missing value is filled from the witness, and what nothing supports is
    withdrawn. ``headers``: (key, model); ``text_layer``: (key, printed, degraded, witness).
    """
    j = headers.join(text_layer, key, "left").withColumns({"m": reading_key("model"), "p": reading_key("printed"), "w": reading_key("witness")})
    agree_p, agree_w = readings_agree("m", "p"), readings_agree("m", "w")
    ok = ~F.coalesce(F.col("degraded"), F.lit(False))
    branch = (
        F.when(ok & F.col("p").isNotNull(), F.when(agree_p, "printed_agrees").otherwise("printed_wins"))
        .when(F.col("m").isNull(), F.when(F.col("w").isNotNull(), "filled_from_witness").otherwise("absent"))
        .when(agree_w, "witness_agrees").when(F.col("w").isNotNull(), "withdrawn_disagrees").otherwise("withdrawn_uncorroborated")
    )
    value = F.when(branch.startswith("printed"), F.col("printed")).when(branch == "filled_from_witness", F.col("witness")).when(branch == "witness_agrees", F.col("model"))
    return j.select(key, value.alias("value"), branch.alias("branch"))


def as_of(left: DataFrame, right: DataFrame, by: str, at: str, value: str, within: str) -> DataFrame:
    """``left`` with the last ``right.value`` at or before its time, not older than ``within``; null where none is.

    One shuffle by key: both sides are laid over each other and the last value is carried forward.
    """
    cols = left.columns
    both = left.select(*cols, F.lit(1).alias("_side"), F.lit(None).cast(dict(right.dtypes)[value]).alias("_v"), F.lit(None).cast("timestamp").alias("_t"))
    other = right.select(F.col(by), F.col(at), F.lit(0).alias("_side"), F.col(value).alias("_v"), F.col(at).alias("_t"))
    u = both.unionByName(other, allowMissingColumns=True)
    w = f"OVER (PARTITION BY {by} ORDER BY {at}, _side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    u = u.withColumn("_r", F.expr(f"last_value(CASE WHEN _side = 0 THEN struct(_v, _t) END, true) {w}")).filter("_side = 1")
    fresh = F.col("_r._t") >= F.col(at) - F.expr(f"INTERVAL {within}")
    return u.select(*cols, F.when(fresh, F.col("_r._v")).alias(value))


def corroborated(parts: DataFrame, witness: DataFrame, doc: str) -> DataFrame:
    """(doc, mpn, verdict): kept where the witness holds the part; suspect where it holds a longer token of which the part is a subsequence.

    The longer token has one to three characters more and begins with the same two; others are unseen.
    ``parts``: (doc, mpn), ``witness``: (doc, token).
    """
    p = parts.select(doc, F.col("mpn")).distinct()
    w = witness.select(doc, "token").distinct()
    seen = p.join(w.select(doc, F.col("token").alias("mpn")), [doc, "mpn"], "left_semi").withColumn("verdict", F.lit("kept"))
    rest = p.join(seen, [doc, "mpn"], "left_anti")
    j = rest.filter("length(mpn) >= 4").withColumn("h", F.left("mpn", F.lit(2))).join(w.withColumn("h", F.left("token", F.lit(2))), [doc, "h"]).filter("length(token) - length(mpn) BETWEEN 1 AND 3")
    sub = F.expr("aggregate(split(mpn, ''), 1, (p, c) -> CASE WHEN p = 0 OR c = '' THEN p WHEN locate(c, token, p) = 0 THEN 0 ELSE locate(c, token, p) + 1 END) > 0")
    bad = j.filter(sub).select(doc, "mpn").distinct().withColumn("verdict", F.lit("suspect"))
    unseen = rest.join(bad, [doc, "mpn"], "left_anti").withColumn("verdict", F.lit("unseen"))
    return seen.unionByName(bad).unionByName(unseen)


@F.pandas_udf(ArrayType(StringType()))
def _shortened(tokens: pd.Series) -> pd.Series:
    """The token without any one to three of its characters."""
    return tokens.map(lambda t: sorted({"".join(t[i] for i in range(len(t)) if i not in gone) for k in (1, 2, 3) for gone in map(set, combinations(range(len(t)), k))}))


def witnessed(parts: DataFrame, texts: DataFrame, doc: str) -> DataFrame:
    """(doc, mpn, verdict): kept where a witness text contains the part, suspect where a token is the part with one to three characters more, else unseen.

    Part and text are compared without case, presentation forms and anything but letters and digits, so a part that is
    broken or stands in a longer token is found; parts under four such characters are kept or unseen.
    ``parts``: (doc, mpn), ``texts``: (doc, text). A token meets the parts it may have lost characters to
    through its deletion neighbourhood, so no first character need agree. The neighbourhoods are large and
    their size is not foreseen, so they are merged, never broadcast.
    """
    key = lambda c: F.regexp_replace(R.concept_name(c), r"[^\p{L}\p{Nd}]+", "")
    p = parts.select(doc, "mpn").distinct().withColumn("k", key("mpn"))
    asked = p.filter("k <> ''").select(doc, "k").distinct()
    t = texts.select(doc, "text").filter("text IS NOT NULL").distinct()
    seen = asked.join(t.select(doc, key("text").alias("held")), doc).filter(F.contains("held", "k")).select(doc, "k").distinct().withColumn("verdict", F.lit("kept"))
    rest = asked.join(seen, [doc, "k"], "left_anti").filter("length(k) >= 4")
    sizes = rest.groupBy(doc).agg(F.max(F.length("k")).alias("most"))
    tokens = t.select(doc, F.explode(F.split("text", r"\s+")).alias("token")).select(doc, key("token").alias("token")).distinct()
    tokens = tokens.hint("merge").join(sizes, doc).filter("length(token) BETWEEN 5 AND most + 3").select(doc, "token")
    bad = tokens.select(doc, F.explode(_shortened("token")).alias("k")).hint("merge").join(rest.hint("merge"), [doc, "k"]).select(doc, "k").distinct().withColumn("verdict", F.lit("suspect"))
    return p.join(seen.unionByName(bad), [doc, "k"], "left").select(doc, "mpn", F.coalesce("verdict", F.lit("unseen")).alias("verdict"))


def inherited_headers(grids: DataFrame, doc: str) -> DataFrame:
    """``grids`` (doc, seq, width, header) with ``inherited``: the last header declared above, if the width is the same.

    A grid without header takes it; a header of another width ends the inheritance.
    """
    w = f"OVER (PARTITION BY {doc} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    g = grids.withColumn("_l", F.expr(f"last_value(CASE WHEN header IS NOT NULL THEN struct(header, width) END, true) {w}"))
    return g.withColumn("inherited", F.when(F.col("header").isNull() & (F.col("_l.width") == F.col("width")), F.col("_l.header"))).drop("_l")


def completed_boxes(boxes: DataFrame, words: DataFrame, page: str, slack: float = 0.5, most: float = 36.0) -> DataFrame:
    """(page, box_id, x1, x2, cut): boxes whose left or right edge cuts words, widened to the words' far sides.

    A word is cut if it crosses an edge by more than ``slack`` while it overlaps the box in height (one
    point tolerated); an edge moves at most ``most`` points.
    """
    j = boxes.join(words.select(F.col(page), F.col("x1").alias("wx1"), F.col("y1").alias("wy1"), F.col("x2").alias("wx2"), F.col("y2").alias("wy2")), page, "left")
    tall = (F.col("wy2") > F.col("y1") + 1) & (F.col("wy1") < F.col("y2") - 1)
    left = tall & (F.col("wx1") < F.col("x1") - slack) & (F.col("wx2") > F.col("x1") + slack)
    right = tall & (F.col("wx1") < F.col("x2") - slack) & (F.col("wx2") > F.col("x2") + slack)
    g = j.groupBy(page, "box_id", "x1", "x2").agg(F.min(F.when(left, F.col("wx1"))).alias("l"), F.max(F.when(right, F.col("wx2"))).alias("r"), F.count_if(left | right).alias("cut"))
    return g.select(page, "box_id", F.greatest(F.coalesce("l", "x1"), F.col("x1") - most).alias("x1"), F.least(F.coalesce("r", "x2"), F.col("x2") + most).alias("x2"), "cut")


def rows_under_captions(lines: DataFrame, page: str, most_gap: float) -> DataFrame:
    """(page, y, text, caption): lines with the caption whose block they belong to.

    ``lines``: (page, y, text, is_caption). A block goes from a caption down to the first gap of more than
    ``most_gap`` or the next caption; lines outside every block have a null caption.
    """
    w = f"(PARTITION BY {page} ORDER BY y, text)"
    far = F.col("y") - F.expr(f"lag(y) OVER {w}") > most_gap
    d = lines.withColumn("_b", F.expr(f"sum(CASE WHEN is_caption THEN 1 ELSE 0 END) OVER {w}")).withColumn("_f", far & ~F.col("is_caption"))
    b = f"(PARTITION BY {page}, _b ORDER BY y, text)"
    d = d.withColumn("_broken", F.expr(f"coalesce(bool_or(_f) OVER {b}, false)")).withColumn("_c", F.expr(f"max(CASE WHEN is_caption THEN text END) OVER {b}"))
    return d.filter("NOT is_caption").select(page, "y", "text", F.when(~F.col("_broken"), F.col("_c")).alias("caption"))
