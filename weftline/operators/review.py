"""Grids threaded through a document, review items, packing, seals, gates and registrations."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import recognise as R
from ..functions import text as X


def grid_outcomes(grids: DataFrame) -> DataFrame:
    """(doc, seq, outcome, reason): how each grid of a document gets its columns.

    ``grids``: (doc, seq, page, width, declared, caption, label, forms, mpn_rows). In order: a form
    region declines; an own header; one inherited from above at the same width (a page without grids
    ends the inheritance); a caption that names parts; a label elsewhere; else a decline with its rows.
    """
    w = "OVER (PARTITION BY doc ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    g = grids.withColumn("_l", F.expr(f"last_value(CASE WHEN declared THEN struct(width, page, seq) END, true) {w}"))
    g = g.withColumn("_p", F.expr("lag(page) OVER (PARTITION BY doc ORDER BY seq)"))
    g = g.withColumn("_gap", F.expr("max(CASE WHEN page - _p > 1 THEN seq END) OVER (PARTITION BY doc ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    inherits = (F.col("_l.width") == F.col("width")) & (F.col("_gap").isNull() | (F.col("_l.seq") >= F.col("_gap")))
    outcome = (
        F.when(~F.col("declared") & ~F.col("caption") & (F.col("forms") >= 3), "declined_form").when(F.col("declared"), "declared").when(inherits, "inherited")
        .when(F.col("caption"), "caption").when(F.col("label"), "label").when(F.col("mpn_rows") > 0, "declined_rows").otherwise("empty")
    )
    return g.select("doc", "seq", outcome.alias("outcome"), F.when(outcome == "declined_rows", F.concat(F.col("mpn_rows").cast("string"), F.lit(" rows hold part numbers"))).alias("reason"))


def forwarded_roles(roles: DataFrame, width: str = "width") -> DataFrame:
    """(doc, seq, col, role, refusal) of column roles that a reader gave for declined grids: indices must lie in the grid, once each."""
    n = F.expr("count(*) OVER (PARTITION BY doc, seq, col)")
    bad = F.when((F.col("col") < 0) | (F.col("col") >= F.col(width)), "outside the grid").when(n > 1, "given twice").when(~F.col("role").isin("affected", "replacement", "customer"), "no such role")
    return roles.select("doc", "seq", "col", "role", bad.alias("refusal"))


def form_regions(cells: DataFrame) -> DataFrame:
    """(grid_id, labels, is_form): grids with three or more cells that end like a label."""
    g = cells.groupBy("grid_id").agg(F.count_if(F.trim("cell").rlike(r"^[^:]{2,40}:$")).alias("labels"))
    return g.withColumn("is_form", F.col("labels") >= 3)


def part_rows(cells: DataFrame) -> DataFrame:
    """(grid_id, row) that hold a part number and no cell of prose (thirty characters and three blanks)."""
    prose = (F.length("cell") >= 30) & ((F.length("cell") - F.length(F.replace(F.col("cell"), F.lit(" "), F.lit("")))) >= 3)
    g = cells.groupBy("grid_id", "row").agg(F.bool_or(F.coalesce(X.looks_like_mpn("cell"), F.lit(False))).alias("mpn"), F.bool_or(F.coalesce(prose, F.lit(False))).alias("prose"))
    return g.filter("mpn AND NOT prose").select("grid_id", "row")


def review_items(parts: DataFrame, key: list[str], fields: dict[str, tuple[str, str]]) -> DataFrame:
    """(key, field, value, source, reason): one item for each field that somebody has to approve.

    ``fields``: field -> (value column, source column). Values without source, and sources that do not
    hold the value, give a reason; empty values have no item.
    """
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(v).alias("value"), F.col(s).alias("source")) for f, (v, s) in fields.items()])
    it = parts.select(*key, F.explode(rows).alias("i")).select(*key, "i.*").filter("value IS NOT NULL AND trim(value) <> ''")
    reason = F.when(F.col("source").isNull(), "no source").when(~F.upper("source").contains(F.upper("value")), "source does not hold the value")
    return it.withColumn("reason", reason)


def sourced_or_refused(headers: DataFrame, index: DataFrame, doc: str) -> DataFrame:
    """(doc, value, kept, reason) of (doc, value) that must be printed: verbatim, or with its typography folded."""
    h = headers.select(doc, "value").filter("value IS NOT NULL").distinct()
    i = index.select(F.col(doc).alias("_d"), F.col("text").alias("_t"))
    j = h.join(i, (F.col(doc) == F.col("_d")), "left")
    verbatim = F.coalesce(F.col("_t").contains(F.col("value")), F.lit(False))
    folded = F.coalesce(F.lower(X.fold_typography("_t")).contains(F.lower(X.fold_typography("value"))), F.lit(False))
    g = j.groupBy(doc, "value").agg(F.bool_or(verbatim).alias("v"), F.bool_or(folded).alias("f"))
    url = F.col("value").rlike(r"(?i)^(https?://|www\.)")
    kept = ~url & (F.col("v") | F.col("f"))
    return g.select(doc, "value", kept.alias("kept"), F.when(url, "an address is no name").when(~kept, "not printed").alias("reason"))


def first_title_type(titles: DataFrame, doc: str) -> DataFrame:
    """(doc, doc_type, source): the type of the first title that says anything; an ambiguous first one decides nothing."""
    s = X.title_signal("title")
    t = titles.select(doc, "seq", s["doc_type"].alias("t"), s["signal"].alias("s")).filter("s IS NOT NULL")
    f = t.groupBy(doc).agg(F.min_by(F.struct("t", "s"), "seq").alias("r"))
    return f.select(doc, F.col("r.t").alias("doc_type"), F.when(F.col("r.s") == "ambiguous", "title-ambiguous").otherwise("title").alias("source"))


def leaf_candidates(titles: DataFrame, doc: str, most: int = 3) -> DataFrame:
    """(doc, rank, leaf, score): the best readings of a document's leaf, by score, then order."""
    s = X.title_signal("title")
    t = titles.select(doc, "seq", s["doc_type"].alias("t"), s["signal"].alias("s"), F.col("is_title").alias("i")).filter("s IS NOT NULL")
    leaves = F.when(F.col("s") == "ambiguous", F.array(F.lit("pcn"), F.lit("pdn"))).otherwise(F.array(F.lower("t")))
    t = t.select(doc, "seq", X.leaf_score(F.col("s"), F.col("i")).alias("score"), F.explode(leaves).alias("leaf"))
    best = t.groupBy(doc, "leaf").agg(F.max_by(F.struct("score", "seq"), F.struct("score", -F.col("seq"))).alias("b")).select(doc, "leaf", "b.*")
    w = F.expr(f"row_number() OVER (PARTITION BY {doc} ORDER BY score DESC, seq, leaf)")
    return best.withColumn("rank", w).filter(F.col("rank") <= most).select(doc, "rank", "leaf", "score")


def unique_boxes(words: DataFrame, mpns: DataFrame, doc: str) -> DataFrame:
    """(doc, mpn, box) of part numbers that one word of the document alone spells."""
    j = words.join(mpns.select(doc, F.col("mpn").alias("word")).distinct(), [doc, "word"])
    return j.groupBy(doc, F.col("word").alias("mpn")).agg(F.count("*").alias("n"), F.first("box").alias("box")).filter("n = 1").drop("n")


def rendered_candidates(rows: DataFrame, doc: str) -> DataFrame:
    """(doc, block): the candidates of a document as numbered lines; what is null is left blank."""
    field = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat(F.col("n").cast("string"), F.lit(". "), field("iso"), F.lit(" | "), field("source"), F.lit(" | "), field("governing"))
    g = rows.select(doc, "n", line.alias("line")).groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("l"))
    return g.select(doc, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("block"))


def deck_outline(titles: DataFrame, deck: str) -> DataFrame:
    """(deck, page, number, title, depth, end_page) of pages titled by a number: depth by dots, end before the next as high.

    Pages with equal numbers are told apart by their title.
    """
    from .elements import outline

    n = X.leading_number("title")
    t = titles.select(deck, "page", n["number"].alias("number"), n["rest"].alias("rest")).filter("number IS NOT NULL")
    heads = t.select(deck, F.col("page").alias("line_no"), F.col("rest").alias("heading"), F.size(F.split("number", r"\.")).alias("level"), "number")
    return outline(heads, deck).select(deck, F.col("line_no").alias("page"), "number", F.col("heading").alias("title"), F.col("level").alias("depth"), F.col("end_line").alias("end_page"))


def resolved_outline(entries: list[tuple[int, str]], titles: list[tuple[int, str]]) -> list[tuple[int, str, int]]:
    """(level, title, page) of outline entries in order: the page is the first with that title at or after the last one.

    An entry without page, or of a page taken with the same title, falls away and lifts its children.
    """
    out, cursor, seen, dropped = [], 0, set(), []
    key = lambda s: " ".join(s.lower().split())
    for level, title in entries:
        while dropped and dropped[-1] >= level:
            dropped.pop()
        page = next((p for p, t in sorted(titles) if p >= cursor and key(t) == key(title)), None)
        if page is None or (key(title), page) in seen:
            dropped.append(level)
            continue
        seen.add((key(title), page))
        cursor = page
        out.append((level - len(dropped), title, page))
    return out


def resolved_outlines(entries: DataFrame, titles: DataFrame, deck: str) -> DataFrame:
    """``resolved_outline`` of every deck; the cursor makes it sequential within one."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        e = list(left.sort_values("seq")[["level", "title"]].itertuples(index=False, name=None))
        t = list(right[["page", "title"]].itertuples(index=False, name=None))
        return pd.DataFrame([(key[0], *r) for r in resolved_outline(e, t)], columns=[deck, "level", "title", "page"])

    kind = dict(entries.dtypes)[deck]
    return entries.groupBy(deck).cogroup(titles.groupBy(deck)).applyInPandas(run, f"{deck} {kind}, level int, title string, page int")


def packed_elements(elements: DataFrame, doc: str, most: int) -> DataFrame:
    """(doc, pack, n, text): elements joined by blank lines while a pack is shorter than ``most``; an oversized one is its own."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        for t in pdf.sort_values("seq")["text"]:
            if out and len(out[-1][1]) + len(t) < most:
                out[-1][0] += 1
                out[-1][1] += "\n\n" + t
            else:
                out.append([1, t])
        d = pdf[doc].iloc[0]
        return pd.DataFrame([(d, i, n, t) for i, (n, t) in enumerate(out)], columns=[doc, "pack", "n", "text"])

    kind = dict(elements.dtypes)[doc]
    return elements.filter("text IS NOT NULL AND text <> ''").select(doc, "seq", "text").groupBy(doc).applyInPandas(run, f"{doc} {kind}, pack int, n int, text string")


def mode_of(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n): the most frequent value of each group, the first by order on ties."""
    c = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    w = F.expr(f"row_number() OVER (PARTITION BY {group} ORDER BY n DESC, {value})")
    return c.withColumn("r", w).filter("r = 1").drop("r")


def rebuilt_tables(cells: DataFrame, table: str) -> DataFrame:
    """(table, rows, width, tier): rows of equal width make a table of tier 1, others are refused."""
    r = cells.groupBy(table, "row").agg(F.count("*").alias("w"))
    g = r.groupBy(table).agg(F.count("*").alias("rows"), F.max("w").alias("width"), F.countDistinct("w").alias("widths"))
    return g.select(table, "rows", "width", F.when(F.col("widths") == 1, 1).alias("tier"))


def worst_seals(counts: DataFrame, key: list[str], counters: list[str]) -> DataFrame:
    """Per key the greatest count over all fires of each counter, and their sum."""
    g = counts.groupBy(*key).agg(*[F.max(c).alias(c) for c in counters])
    return g.withColumn("cut", sum((F.col(c) for c in counters[1:]), F.col(counters[0])))


def baseline_ratios(health: DataFrame, pairs: list[str]) -> DataFrame:
    """(pair, ratio): occurrences of each pair for one of the control, over all healthy texts."""
    g = health.agg(F.sum("control").alias("control"), *[F.sum(p).alias(p) for p in pairs])
    return g.select("control", F.explode(F.array(*[F.struct(F.lit(p).alias("pair"), F.col(p).alias("n")) for p in pairs])).alias("x")).select("x.pair", F.round(F.try_divide("x.n", "control"), 4).alias("ratio"))


def gate(verdicts: DataFrame, blocking: list[str]) -> DataFrame:
    """(rule, failures, blocks): rules of a gate with how often they failed; a blocking rule must not fail."""
    g = verdicts.groupBy("rule").agg(F.count_if(~F.col("ok")).alias("failures"), F.count("*").alias("checked"))
    return g.withColumn("blocks", F.col("rule").isin(*blocking) & (F.col("failures") > 0))


def registrations(tools: DataFrame) -> DataFrame:
    """(src, rel, dst, key, value): tools as typed edges between classes, their property maps flattened."""
    e = tools.select("src", "rel", "dst", F.explode_outer("props").alias("key", "value"))
    return e.distinct()


def landed(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """(child, parent, landed) of subclass edges: whether both classes exist."""
    c = classes.select("id").distinct()
    e = edges.select("child", "parent").distinct()
    e = e.join(c.select(F.col("id").alias("child"), F.lit(True).alias("_c")), "child", "left").join(c.select(F.col("id").alias("parent"), F.lit(True).alias("_p")), "parent", "left")
    return e.select("child", "parent", (F.col("_c").isNotNull() & F.col("_p").isNotNull()).alias("landed"))


def backfilled(slides: DataFrame, sections: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new edges, invariants): slide edges of sections that do not exist yet, and counts that must add up."""
    from .concepts import members

    want = members(slides.select("course_id", "slide").distinct(), sections).select("course_id", "section", "slide").distinct()
    new = want.join(existing, ["course_id", "section", "slide"], "left_anti")
    tagged = want.join(existing.select("course_id", "section", "slide").distinct().withColumn("_had", F.lit(True)), ["course_id", "section", "slide"], "left")
    n = tagged.agg(F.count("*").alias("wanted"), F.count_if(F.col("_had").isNull()).alias("added"), F.count_if(F.col("_had").isNotNull()).alias("had"))
    return new, n.withColumn("adds_up", F.col("wanted") == F.col("added") + F.col("had"))


def wiped_and_loaded(store: DataFrame, incoming: DataFrame) -> DataFrame:
    """The store after a sync: everything about any subject or address object of ``incoming`` goes, then it is loaded."""
    seen = incoming.select(F.col("s").alias("uri")).unionByName(incoming.filter(F.col("o").rlike("^(urn|https?):")).select(F.col("o").alias("uri"))).distinct()
    return store.join(seen, store.s == seen.uri, "left_anti").unionByName(incoming)


def schema_rows(df: DataFrame, entity: str) -> list[tuple[str, str, str]]:
    """(entity, field, type) of a DataFrame for a catalogue, nested fields by dotted names."""
    out = []

    def walk(at: str, schema):
        for f in schema.fields:
            name = f"{at}.{f.name}" if at else f.name
            out.append((entity, name, f.dataType.simpleString()))
            if hasattr(f.dataType, "fields"):
                walk(name, f.dataType)

    walk("", df.schema)
    return out


def with_overrides(figures: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """Figures with the override of their key (the greatest where it is given twice) where there is one, and whether it was used."""
    o = overrides.groupBy(key).agg(F.max(value).alias("_o"))
    return figures.join(o, key, "left").withColumn("overridden", F.col("_o").isNotNull()).withColumn(value, F.coalesce("_o", value)).drop("_o")


def routed(paths: Column) -> Column:
    """The reader of an XML file by the first segment of its key."""
    seg = F.lower(F.element_at(F.split(paths, "/"), 1))
    return F.when(seg.isin("s1000d", "iads", "dita", "40051"), seg)


def excluded(rows: DataFrame, iri: str, prefixes: list[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, reasons): rows whose address begins with an excluded prefix or has no shape go, and the counts add up."""
    reason = F.when(F.col(iri).isNull() | ~F.col(iri).rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), "no address")
    for p in prefixes:
        reason = F.coalesce(reason, F.when(F.col(iri).startswith(p), p))
    r = rows.withColumn("reason", reason)
    return r.filter("reason IS NULL").drop("reason"), r.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def profile_findings(profile: dict, containers: dict[str, set[str]]) -> list[str]:
    """All that is wrong with an export profile; nothing may be exported unless this is empty."""
    out = []
    if profile.get("granularity") not in ("notice", "notice_part"):
        out.append("granularity must be notice or notice_part")
    seen = set()
    for i, c in enumerate(profile.get("columns") or []):
        name = c.get("output")
        if not name:
            out.append(f"column {i} has no output")
        elif name in seen:
            out.append(f"{name} is given twice")
        seen.add(name)
        src = c.get("source") or {}
        known = containers.get(src.get("container"))
        if known is None:
            out.append(f"{name}: no container {src.get('container')}")
        elif src.get("field") not in known:
            out.append(f"{name}: {src.get('container')} has no field {src.get('field')}")
    if not profile.get("columns"):
        out.append("no columns")
    return out


def scoped_update(update: str, graph: str) -> str:
    """An INSERT DATA statement with its triples put into a named graph; anything else is refused."""
    m = re.fullmatch(r"\s*INSERT\s+DATA\s*\{(.*)\}\s*;?\s*", update, re.IGNORECASE | re.DOTALL)
    if not m:
        raise ValueError("only INSERT DATA is allowed")
    body = m[1]
    bare = re.sub(r'"(?:[^"\\]|\\.)*"|<[^>]*>', "", body)
    if re.search(r"\bGRAPH\b", bare, re.IGNORECASE):
        if re.findall(r"GRAPH\s*<([^>]*)>", body, re.IGNORECASE) != [graph]:
            raise ValueError("another graph is named")
        return update
    if "{" in bare or "}" in bare:
        raise ValueError("nested groups are not allowed")
    return f"INSERT DATA {{ GRAPH <{graph}> {{{body}}} }}"


def label_above(labels: DataFrame, grids: DataFrame, page: str, slack: float = 2.0) -> DataFrame:
    """(page, grid, label): the nearest label whose foot lies above a grid's head (``slack`` points tolerated)."""
    j = grids.join(labels, page).filter(F.col("foot") <= F.col("head") + slack)
    return j.groupBy(page, "grid").agg(F.max_by("label", F.struct("foot", "label")).alias("label"))


def crops_of(elements: DataFrame, uploads: DataFrame, doc: str) -> DataFrame:
    """Elements with the address of their crop, by the base name of the image path."""
    name = F.regexp_extract("image_path", r"([^/\\]*)$", 1)
    return elements.withColumn("_n", name).join(uploads.select(doc, F.col("name").alias("_n"), "url"), [doc, "_n"], "left").drop("_n")


def affected_pages(pages: DataFrame, doc: str) -> DataFrame:
    """(doc, page, pairs, stated, shortfall): family/model pairs of pages that belong to an affected section.

    A page counts if it or its document names one, or it carries a caption count; fewer than two pairs
    in the document give nothing; below nine tenths of the caption count there is a shortfall.
    """
    p = pages.select(doc, "page", F.size(R.family_models("text")).alias("pairs"), R.names_affected_section("text").alias("named"), R.caption_count("text").alias("stated"))
    d = f"OVER (PARTITION BY {doc})"
    p = p.withColumns({"_any": F.expr(f"bool_or(named) {d}"), "_all": F.expr(f"sum(pairs) {d}"), "_cap": F.expr(f"max(stated) {d}")})
    return p.filter("_all >= 2 AND pairs > 0 AND (named OR stated IS NOT NULL OR _any)").select(doc, "page", "pairs", "stated", F.coalesce(F.col("_all") < 0.9 * F.col("_cap"), F.lit(False)).alias("shortfall"))
