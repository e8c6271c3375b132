"""Health, lines, outlines, chunks and scalar recognition over texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import recognise as R
from ..functions import text as X
from ..operators import elements as E
from ..session import table


def text_layer_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention of letter pairs in every document."""
    return E.text_health(table(spark, sf_dir, "documents"), "doc_id", "text")


def line_elements_running_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of sections with the page the last divider named."""
    return E.running_page(E.lines(table(spark, sf_dir, "base_sections"), "section_id", "content"), "section_id")


def outline_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings recognised in sections, with parent and end."""
    ls = E.lines(table(spark, sf_dir, "base_sections"), "section_id", "content")
    return E.outline(E.recognised_headings(ls, "section_id"), "section_id")


def overlapping_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed windows with overlap over section texts."""
    return E.overlapping_chunks(table(spark, sf_dir, "base_sections"), "section_id", "content", 2000, 200)


def _chunks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b = table(spark, sf_dir, "base_sections")
    row = b.select(F.concat_ws("_p", "node_id", F.col("page_start").cast("string")).alias("chunk_id"), "section_id", F.col("title").alias("vector"))
    return row.filter("section_id % 3 <> 0").dropDuplicates(["chunk_id"]), row.filter("section_id % 2 = 0")


def chunk_upsert_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tally of what writing chunks over a stored state does."""
    old, new = _chunks(spark, sf_dir)
    return E.upsert_verdicts(old, new, "chunk_id", "vector").groupBy("verdict").agg(F.count("*").alias("n"))


def page_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout of pages built from the steps of a procedure: figures are images, tools tables, text the rest."""
    s = table(spark, sf_dir, "mfg_steps")
    text = s.select("procedure_id", F.lit("Text").alias("type"), F.col("instruction_text").alias("text"), F.lit(0).alias("width"))
    figs = s.select("procedure_id", F.explode("figure_references").alias("text")).select("procedure_id", F.lit("Image").alias("type"), "text", (F.regexp_extract("text", r"(\d+)", 1).cast("int") * 60).alias("width"))
    tabs = s.filter("size(tooling) >= 4").select("procedure_id", F.lit("Table").alias("type"), F.lit("").alias("text"), F.lit(0).alias("width"))
    return E.layout(text.unionByName(figs).unionByName(tabs), ["procedure_id"])


def value_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes and redactions of part numbers."""
    s = table(spark, sf_dir, "mfg_steps").select("step_key", F.posexplode("internal_part_numbers").alias("pos", "value")).filter("value IS NOT NULL")
    return s.select("step_key", "pos", X.shape("value").alias("shape"), X.redacted("value").alias("redacted"), X.looks_like_mpn("value").alias("mpn"), X.without_quotes(F.concat(F.lit('"'), "value", F.lit('"'))).alias("bare"))


def typography_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with typography folded, and their match and alignment keys."""
    c = table(spark, sf_dir, "concept_records")
    return c.select("record_id", X.fold_typography("name").alias("folded"), X.fold_ligatures("name").alias("match_key"), X.squeeze("name").alias("squeezed"))


def uri_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of identifiers and of verbs in camel case."""
    c = table(spark, sf_dir, "slide_concepts")
    frag = F.array_join(F.transform(F.split(F.col("name"), r"[^A-Za-z0-9]+"), lambda w: F.initcap(w)), "")
    lab = X.human_label(F.concat_ws("_", frag, F.col("slide").cast("string")))
    return c.select("concept_key", frag.alias("fragment"), lab["label"].alias("label"), lab["opaque"].alias("opaque"), X.human_verb(F.concat(F.lit("query"), frag)).alias("verb"))


def stated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of parts that the summaries of notices state."""
    return table(spark, sf_dir, "notice_headers").select("notice_id", R.stated_count("summary").alias("stated"))


def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of parts that documents state, behind a sentence that gives one."""
    t = F.concat_ws(" ", F.concat(F.lit("About "), F.col("n_chars").cast("string"), F.lit(" of the")), "text")
    return table(spark, sf_dir, "documents").select("doc_id", R.stated_count("text").alias("stated"), R.stated_count(t).alias("after_number"), R.stated_count(F.concat(F.lit("lists "), F.format_number("n_chars", 0), F.lit(" affected parts"))).alias("grouped"))


def page_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as fractions of their page: clamped, rounded, null with a note where degenerate or without dims."""
    e = table(spark, sf_dir, "events").select("event_id", F.array(F.col("value"), F.col("value") * 0.5, F.col("value") + F.col("user_id") % 90, F.col("value") * 2).alias("box"), F.when(F.col("event_id") % 11 != 0, 120.0).alias("w"), F.lit(100.0).alias("h"))
    return fractions(e)


def fractions(boxes: DataFrame) -> DataFrame:
    """(event_id, x1, y1, x2, y2, note) of (event_id, box, w, h)."""
    raw = [F.col("box")[i] / F.col("w" if i % 2 == 0 else "h") for i in range(4)]
    cut = [F.floor(F.least(F.greatest(r, F.lit(0.0)), F.lit(1.0)) * 1e6 + 0.5) / 1e6 for r in raw]
    flat = (cut[2] <= cut[0]) | (cut[3] <= cut[1])
    outside = F.exists(F.array(*raw), lambda r: (r < 0) | (r > 1))
    note = F.when(F.col("box").isNull(), F.lit(None)).when(F.col("w").isNull() | F.col("h").isNull(), "no dims").when(flat, "degenerate").when(outside, "outside")
    good = F.col("box").isNotNull() & F.col("w").isNotNull() & F.col("h").isNotNull() & ~flat
    return boxes.select("event_id", *[F.when(good, c).alias(n) for c, n in zip(cut, ("x1", "y1", "x2", "y2"))], note.alias("note"))


QUERIES = {
    "text_layer_health": text_layer_health, "line_elements_running_page": line_elements_running_page, "outline_sections": outline_sections, "overlapping_chunks": overlapping_chunks,
    "chunk_upsert_verdicts": chunk_upsert_verdicts, "page_layouts": page_layouts, "value_shapes": value_shapes, "typography_folds": typography_folds, "uri_labels": uri_labels, "stated_counts": stated_counts, "document_counts": document_counts, "page_fractions": page_fractions,
}

_COUNT = "len(list_filter(range(1, length(t)), lambda i: substr(t, i, 2) = '{0}'))"
_LINES = "lines AS (SELECT section_id, unnest(range(len(string_split(content, chr(10))))) AS line_no, unnest(string_split(content, chr(10))) AS line FROM base_sections)"
_W1 = "regexp_extract(lower(t), '^[a-z]*')"
_REST = f"ltrim(regexp_replace(substr(lower(t), length({_W1}) + 1), '^\\.', ''))"
_CODE = f"ltrim(regexp_replace({_REST}, '^[:-]', ''))"
_IN = lambda words: ", ".join(f"'{w}'" for w in words)
_FURN = f"""NOT (regexp_matches(lower(t), '^page +[0-9]+( +of +[0-9]+)?$') OR regexp_matches(t, '^[0-9]+$') OR ({_W1} IN ({_IN(X.REVISION_WORDS)}) AND regexp_matches({_CODE}, '^[a-z0-9.-]+$') AND length({_CODE}) <= 12)
      OR lower(t) IN ({_IN(X.STATUS_LINES)}) OR lower(t) IN ('continued', '(continued)', '(continued', 'continued)', 'cont', '(cont)', '(cont', 'cont)', 'cont.', '(cont.)', '(cont.', 'cont.)') OR ({_W1} IN ({_IN(X.DATED_WORDS)}) AND regexp_matches({_REST}, '^(date ?)?[:-]')))"""
_ADMON = f"rtrim(regexp_replace(lower(t), '[:.!]$', '')) IN ({_IN(X.ADMONITIONS)})"


def _stated(text: str) -> str:
    """The stated count of a text, over lists of words."""
    noun = lambda i: f"coalesce(list_contains([{_IN(R.COUNTED)}], regexp_extract(w[{i}], '^[a-z0-9_]*')), false)"
    plain = lambda i: f"coalesce(regexp_full_match(w[{i}], '[\\w/.-]+'), false)"
    follows = noun("i + 4")
    for k in (3, 2, 1):
        follows = f"({noun(f'i + {k}')} OR ({plain(f'i + {k}')} AND {follows}))"
    number = "regexp_matches(w[i], '^[^\\w.\\-/#,\\x{2010}-\\x{2015}\\x{2212}]*[0-9][0-9,]*$') AND length(regexp_extract(w[i], '[0-9,]*$')) <= 7"
    words = f"string_split(trim(regexp_replace(lower({text}), '\\s+', ' ', 'g')), ' ')"
    raw = f"(SELECT rtrim(regexp_extract(w[list_filter(range(1, len(w) + 1), lambda i: {number} AND {follows})[1]], '[0-9][0-9,]*$'), ',') FROM (SELECT {words} AS w))"
    value = f"try_cast(replace({raw}, ',', '') AS INT)"
    return f"CASE WHEN NOT ({value} BETWEEN 1900 AND 2100 AND length({raw}) = 4) AND {value} <= {R.MOST_STATED} THEN {value} END"


_DIV = r"^(?:-+ *)?Page (\d+)(?: of \d+)?(?: *-+)?$"
_KEPT = "list_filter([" + ", ".join(f"CASE WHEN control * {r} >= 5.0 THEN floor({p} / (control * {r}) * 10000 + 0.5) / 10000 END" for p, r in E.PAIR_RATIOS.items()) + "], lambda x: x IS NOT NULL)"
_ROW = "(SELECT concat_ws('_p', node_id, CAST(page_start AS VARCHAR)) AS chunk_id, section_id, title AS vector FROM base_sections)"
_RAW = ["value / w", "value * 0.5 / 100.0", "(value + user_id % 90) / w", "value * 2 / 100.0"]
_CUT = [f"floor(least(greatest({r}, 0.0), 1.0) * 1000000 + 0.5) / 1000000" for r in _RAW]
_FLAT = f"({_CUT[2]} <= {_CUT[0]} OR {_CUT[3]} <= {_CUT[1]})"
_CAMEL = """list_reduce(list_transform(range(1, length(f) + 1), lambda i: substr(f, i, 1) || substr(f, i + 1, 1)), lambda acc, x: acc || CASE
    WHEN regexp_matches(x, '^[^A-Za-z0-9]') THEN chr(1) WHEN regexp_matches(acc, '(^|' || chr(1) || ')$') THEN left(x, 1)
    WHEN regexp_matches(x, '^[A-Z]') AND (regexp_matches(regexp_extract(acc, '[A-Za-z0-9]*$'), '[a-z]') OR (regexp_matches(x, '^.[a-z]') AND NOT regexp_matches(regexp_extract(acc, '[A-Za-z0-9]*$'), '[0-9]'))) THEN chr(1) || left(x, 1)
    WHEN regexp_matches(x, '^[a-z]') AND regexp_matches(regexp_extract(acc, '[A-Za-z0-9]*$'), '^[A-Z0-9]*[A-Z][A-Z0-9]*$') AND regexp_matches(regexp_extract(acc, '[A-Za-z0-9]*$'), '[0-9]') THEN chr(1) || left(x, 1)
    WHEN regexp_matches(x, '^[0-9]') AND regexp_matches(regexp_extract(acc, '[A-Za-z0-9]*$'), '^[A-Z0-9]*[A-Z]$') AND regexp_matches(regexp_extract(acc, '[A-Za-z0-9]*$'), '[0-9]') THEN chr(1) || left(x, 1) ELSE left(x, 1) END, '')"""
_INIT = "array_to_string(list_transform(regexp_split_to_array(name, '[^A-Za-z0-9]+'), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), '')"
SQL = {
    "uri_labels": f"""WITH n AS (SELECT concept_key, {_INIT} AS fragment, concat_ws('_', {_INIT}, CAST(slide AS VARCHAR)) AS f FROM slide_concepts), w AS (SELECT *, list_filter(string_split({_CAMEL}, chr(1)), lambda w: w <> '') AS ws, list_filter(string_split(f, '_'), lambda w: w <> '') AS sg FROM n)
      SELECT concept_key, fragment, array_to_string(list_transform(ws, lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS label, len(sg) = 0 OR len(list_filter(sg, lambda x: regexp_full_match(x, '[0-9]+|[A-Za-z]'))) > 0 AS opaque,
        lower(regexp_replace(regexp_replace('query' || fragment, '([^A-Z])([A-Z])', '\\1 \\2', 'g'), '([^A-Z ])([A-Z])', '\\1 \\2', 'g')) AS verb FROM w""",
    "text_layer_health": f"""WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents), c AS (SELECT doc_id, {_COUNT.format('th')} + {_COUNT.format('er')} AS control, {', '.join(_COUNT.format(p) + ' AS ' + p for p in E.PAIR_RATIOS)} FROM d),
      k AS (SELECT doc_id, control, {_KEPT} AS kept FROM c) SELECT doc_id, control, len(kept) AS judged, list_min(kept) AS retention, coalesce(list_min(kept) < 0.35, false) AS degraded FROM k""",
    "line_elements_running_page": f"""WITH {_LINES}, m AS (SELECT *, CASE WHEN regexp_matches(trim(line), '{_DIV}') THEN CAST(regexp_extract(trim(line), '{_DIV}', 1) AS INT) END AS mark FROM lines),
      r AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY section_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS page FROM m) SELECT section_id, line_no, line, page FROM r WHERE mark IS NULL""",
    "outline_sections": f"""WITH {_LINES}, x AS (SELECT section_id, line_no, trim(line) AS t FROM lines WHERE trim(line) <> ''), h AS (
        SELECT section_id, line_no, t AS heading, CASE WHEN regexp_matches(t, '^(\\d+(?:\\.\\d+)*)\\.?\\s+(\\S.*)$') THEN regexp_extract(t, '^(\\d+(?:\\.\\d+)*)\\.?\\s+(\\S.*)$', 1) END AS number FROM x
        WHERE {_FURN} AND (regexp_matches(t, '^(\\d+(?:\\.\\d+)*)\\.?\\s+(\\S.*)$') OR (length(t) <= 48 AND regexp_matches(t, '\\p{{L}}') AND t = upper(t) AND NOT {_ADMON}))),
      l AS (SELECT *, CASE WHEN number IS NULL THEN 1 ELSE len(string_split(number, '.')) END AS level FROM h)
      SELECT section_id, line_no, heading, level, number, (SELECT max(b.line_no) FROM l b WHERE b.section_id = l.section_id AND b.line_no < l.line_no AND b.level < l.level) AS parent,
        (SELECT min(b.line_no) FROM l b WHERE b.section_id = l.section_id AND b.line_no > l.line_no AND b.level <= l.level) - 1 AS end_line FROM l""",
    "overlapping_chunks": "WITH s AS (SELECT section_id, content, unnest(CASE WHEN length(content) <= 2000 THEN [0] ELSE range(0, length(content), 1800) END) AS start FROM base_sections WHERE length(content) > 0) SELECT section_id, start // 1800 AS chunk_no, substr(content, start + 1, 2000) AS chunk FROM s",
    "chunk_upsert_verdicts": f"SELECT CASE WHEN vector IS NOT NULL THEN 'written' WHEN chunk_id IN (SELECT chunk_id FROM {_ROW} WHERE section_id % 3 <> 0) THEN 'skipped_would_strip_vector' ELSE 'written_without_vector' END AS verdict, count(*) AS n FROM {_ROW} WHERE section_id % 2 = 0 GROUP BY 1",
    "page_layouts": """WITH e AS (SELECT procedure_id, 'Text' AS type, instruction_text AS text, 0 AS width FROM mfg_steps UNION ALL
        SELECT procedure_id, 'Image', f, CAST(regexp_extract(f, '(\\d+)', 1) AS INT) * 60 FROM (SELECT procedure_id, unnest(figure_references) AS f FROM mfg_steps) UNION ALL SELECT procedure_id, 'Table', '', 0 FROM mfg_steps WHERE len(tooling) >= 4),
      g AS (SELECT procedure_id, count(*) FILTER (type = 'Table') AS tables, count(*) FILTER (type = 'Image') AS images, sum(CASE WHEN type = 'Text' THEN length(text) ELSE 0 END) AS chars, max(CASE WHEN type = 'Image' THEN width END) / 1280.0 AS ratio FROM e GROUP BY 1)
      SELECT procedure_id, CASE WHEN tables > 0 THEN 'table' WHEN images = 1 AND chars < 200 THEN 'hero' WHEN images = 0 THEN 'documentary' WHEN images >= 3 THEN 'grid' WHEN ratio > 0.6 THEN 'content_caption' ELSE 'split' END AS layout FROM g""",
    "value_shapes": f"""WITH v AS (SELECT step_key, unnest(range(len(internal_part_numbers))) AS pos, unnest(internal_part_numbers) AS value FROM mfg_steps) SELECT step_key, pos,
        regexp_replace(regexp_replace(regexp_replace(value, '\\p{{Lu}}', 'A', 'g'), '\\p{{Ll}}', 'a', 'g'), '\\p{{Nd}}', '9', 'g') AS shape, 'len=' || strlen(value) || ' sha256:' || left(sha256(value), 8) AS redacted,
        trim(value) <> '' AND length(trim(value)) <= 48 AND length(trim(value)) - length(regexp_replace(trim(value), '\\s', '', 'g')) <= 2 AND regexp_matches(value, '\\d') AND NOT ends_with(trim(value), ':') AS mpn, value AS bare FROM v WHERE value IS NOT NULL""",
    "typography_folds": "SELECT record_id, regexp_replace(translate(name, '‐‑‒–—―−‘’‚‛“”„‟', '-------''''''''\"\"\"\"'), '[\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{202F}\\x{205F}\\x{3000}]', ' ', 'g') AS folded, regexp_replace(lower(replace(replace(replace(replace(replace(name, 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl')), '\\s+', '', 'g') AS match_key, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS squeezed FROM concept_records",
    "stated_counts": f"SELECT notice_id, {_stated('summary')} AS stated FROM notice_headers",
    "document_counts": f"""SELECT doc_id, {_stated('text')} AS stated, {_stated("concat_ws(' ', 'About ' || n_chars || ' of the', text)")} AS after_number, {_stated("'lists ' || format('{:,}', n_chars) || ' affected parts'")} AS grouped FROM documents""",
    "page_fractions": f"""WITH e AS (SELECT event_id, value, user_id, CASE WHEN event_id % 11 <> 0 THEN 120.0 END AS w FROM events) SELECT event_id, {', '.join(f'CASE WHEN value IS NOT NULL AND w IS NOT NULL AND NOT {_FLAT} THEN {c} END AS {n}' for c, n in zip(_CUT, ('x1', 'y1', 'x2', 'y2')))},
        CASE WHEN w IS NULL THEN 'no dims' WHEN {_FLAT} THEN 'degenerate' WHEN {' OR '.join(f'{r} < 0 OR {r} > 1' for r in _RAW)} THEN 'outside' END AS note FROM e""",
}
