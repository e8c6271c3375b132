"""Tables of parts: header rows, column roles, pairing, extraction, merging, grounding and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def header_rows(cells: DataFrame) -> DataFrame:
    """(grid_id, header_row): the row among the first six with most role cells, first on ties, two filled cells at least.

    ``cells``: (grid_id, row, col, cell) from 0.
    """
    role = X.header_role("cell")
    g = cells.filter("row < 6").groupBy("grid_id", "row").agg(F.count_if(F.trim(F.coalesce("cell", F.lit(""))) != "").alias("filled"), F.count_if(role.isin("affected", "replacement")).alias("score"))
    return g.filter("filled >= 2 AND score > 0").groupBy("grid_id").agg(F.max_by("row", F.struct("score", -F.col("row"))).alias("header_row"))


def column_pairs(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """(grid_id, header_row, affected, replacement, customer): for each affected column its mates to the right.

    A mate is the first replacement (customer) column before the next affected one.
    """
    h = cells.join(headers, "grid_id").filter("row = header_row").select("grid_id", "header_row", "col", X.header_role("cell").alias("role"))
    ahead = "OVER (PARTITION BY grid_id ORDER BY col ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    pick = lambda r: F.expr(f"min(CASE WHEN role = '{r}' THEN col END) {ahead}")
    w = h.withColumns({"stop": pick("affected"), "rep": pick("replacement"), "cust": pick("customer")}).filter("role = 'affected'")
    mate = lambda c: F.when(F.col("stop").isNull() | (F.col(c) < F.col("stop")), F.col(c))
    return w.select("grid_id", "header_row", F.col("col").alias("affected"), mate("rep").alias("replacement"), mate("cust").alias("customer"))


def grid_parts(cells: DataFrame) -> DataFrame:
    """(grid_id, row, affected, replacement, customer) of the part rows of grids that declare their columns."""
    pairs = column_pairs(cells, header_rows(cells))
    rows = cells.groupBy("grid_id", "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "cell"))).alias("by"))
    j = rows.join(pairs, "grid_id").filter("row > header_row")
    value = lambda c: X.without_quotes(F.trim(F.try_element_at("by", F.col(c)))).alias(c)
    v = j.select("grid_id", "row", value("affected"), value("replacement"), value("customer"))
    part = lambda c: F.when(X.looks_like_mpn(c), F.col(c)).alias(c)
    return v.filter(X.looks_like_mpn("affected")).select("grid_id", "row", "affected", part("replacement"), part("customer"))


def deduplicated(parts: DataFrame, doc: str, mpn: str, seq: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, tallies): the first row of each trimmed part number per document; duplicates and blanks counted.

    Ranks by the order columns; a document's hot number is ranked by a combining aggregate, not a sort.
    """
    key = F.trim(F.coalesce(F.col(mpn), F.lit("")))
    p = parts.withColumn("_mpn", key)
    first = p.filter("_mpn <> ''").groupBy(doc, "_mpn").agg(F.min_by(F.struct(*[c for c in parts.columns]), F.struct(*seq)).alias("r"), F.count("*").alias("n"))
    kept = first.select("r.*")
    blank = p.filter("_mpn = ''").groupBy(doc).agg(F.count("*").alias("no_mpn"))
    tally = first.groupBy(doc).agg(F.sum(F.col("n") - 1).alias("duplicate"), F.count("*").alias("kept")).join(blank, doc, "full_outer")
    return kept, tally.select(doc, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("kept", "duplicate", "no_mpn")])


def clean_replacement(c: Column | str) -> Column:
    """A replacement that holds a comma names several parts and is refused."""
    s = X.col(c)
    return F.when(~s.contains(","), s)


def grounded(needles: DataFrame, index: DataFrame, doc: str) -> DataFrame:
    """(doc, needle, status, confidence, candidate_count, first_seq) of each needle within its document.

    ``needles``: (doc, needle); ``index``: (doc, seq, text, preferred). Both are normalised (white
    space, case). The containment join is an equality join on the document. One element: unique; some
    of several preferred: region_preferred; several: ambiguous; none or an empty needle: not_found.
    """
    norm = lambda c: X.squeeze(F.upper(F.coalesce(X.col(c), F.lit(""))))
    n = needles.select(doc, "needle").distinct().withColumn("_n", norm("needle"))
    i = index.select(F.col(doc).alias("_d"), "seq", norm("text").alias("_t"), "preferred")
    hit = n.join(i, (F.col(doc) == F.col("_d")) & (F.col("_n") != "") & F.col("_t").contains(F.col("_n")), "left")
    g = hit.groupBy(doc, "needle").agg(F.count("seq").alias("candidate_count"), F.count_if(F.col("preferred")).alias("liked"), F.min("seq").alias("any_seq"), F.min(F.when(F.col("preferred"), F.col("seq"))).alias("liked_seq"))
    status = F.when(F.col("candidate_count") == 0, "not_found").when(F.col("candidate_count") == 1, "unique").when(F.col("liked") > 0, "region_preferred").otherwise("ambiguous")
    conf = F.when(status == "unique", 1.0).when(status == "region_preferred", 0.7).when(status == "ambiguous", 0.4).otherwise(0.0)
    seq = F.when(status == "region_preferred", F.col("liked_seq")).otherwise(F.col("any_seq"))
    return g.select(doc, "needle", status.alias("status"), conf.alias("confidence"), "candidate_count", seq.alias("first_seq"))


def row_scores(truth: DataFrame, got: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(column, match, mismatch, expected_empty_got_value, expected_value_got_empty, not_exported, asserted, rate).

    Blank truth cells assert nothing, ``<empty>`` asserts emptiness; rows only in the truth are not
    exported. A total row has column ``(all)``; a rate without asserted cells is null.
    """
    t = truth.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("want")) for c in columns])).alias("x")).select(key, "x.*").filter("want IS NOT NULL AND want <> ''")
    g = got.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit("")).alias("have")) for c in columns])).alias("x")).select(key, "x.*")
    j = t.join(g, [key, "column"], "left")
    empty = F.col("want") == "<empty>"
    bucket = F.when(F.col("have").isNull(), "not_exported").when(empty, F.when(F.col("have") == "", "match").otherwise("expected_empty_got_value")).when(F.col("have") == "", "expected_value_got_empty").when(F.col("have") == F.col("want"), "match").otherwise("mismatch")
    names = ["match", "mismatch", "expected_empty_got_value", "expected_value_got_empty", "not_exported"]
    s = j.withColumn("b", bucket).rollup("column").agg(*[F.count_if(F.col("b") == x).alias(x) for x in names], F.count("*").alias("asserted"), F.grouping_id().alias("gid"))
    return s.select(F.when(F.col("gid") == 1, "(all)").otherwise(F.col("column")).alias("column"), *names, "asserted", F.try_divide("match", "asserted").alias("rate"))


def set_scores(truth: DataFrame, got: DataFrame, doc: str, item: str) -> DataFrame:
    """(doc, exact, missing, spurious, malformed) of distinct item sets per document."""
    t = truth.select(doc, item).filter(F.col(item).isNotNull()).distinct().withColumn("t", F.lit(1))
    g = got.select(doc, item).filter(F.col(item).isNotNull()).distinct().withColumn("g", F.lit(1))
    j = t.join(g, [doc, item], "full_outer")
    return j.groupBy(doc).agg(
        F.count_if(F.col("t").isNotNull() & F.col("g").isNotNull()).alias("exact"), F.count_if(F.col("g").isNull()).alias("missing"), F.count_if(F.col("t").isNull()).alias("spurious"),
        F.count_if(F.col("g").isNotNull() & F.col(item).rlike("[\n\r\t,]|  ")).alias("malformed"),
    )


def header_verdict(expected: Column, got: Column, accepted: Column, normal) -> Column:
    """exact, alias, misformatted, absent, hallucinated, pending or wrong, in the order of the rules."""
    blank = F.coalesce(F.trim(got), F.lit("")) == ""
    want_none = expected == "<absent>"
    return (
        F.when(want_none, F.when(blank, "correctly_absent").otherwise("hallucinated")).when(expected.isNull(), "pending").when(blank, "absent")
        .when(got == expected, "exact").when(F.array_contains(accepted, got), "alias").when(normal(got) == normal(expected), "misformatted").otherwise("wrong")
    )
