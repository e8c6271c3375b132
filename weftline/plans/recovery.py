"""Makers read off the document, completed part numbers, corrected boxes, readers, drift and polls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geometry, graph, names
from ..session import table
from ..sources import readers
from ..streaming import incremental


def contracted_makers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word among a notice's readings that contracts the maker it states."""
    n = table(spark, sf_dir, "notice_headers").select("notice_id", F.col("mfr").alias("name"))
    w = table(spark, sf_dir, "written_headers").select("notice_id", "header_id", F.posexplode(F.split("mfr", r"\s+")).alias("k", "word"))
    return names.contracted_names(n, w.select("notice_id", (F.col("header_id") * 1000 + F.col("k")).alias("at"), "word"), "notice_id")


def printed_makers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one name that a notice's first two readings print alone, by the names that any third reading gives or by shape."""
    w = table(spark, sf_dir, "written_headers")
    e = w.select("notice_id", F.col("header_id").alias("at"), F.when(F.col("fire") == 1, "Title").when(F.col("fire") == 2, "UncategorizedText").otherwise("NarrativeText").alias("type"), F.col("mfr").alias("text"))
    return names.printed_names(e, w.filter("fire = 3").select(F.col("mfr").alias("name")), "notice_id")


def completed_cut_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part numbers cut at either end, completed by the only longer number of their procedure."""
    s = table(spark, sf_dir, "mfg_steps").select("procedure_id", "step_key", F.explode("internal_part_numbers").alias("mpn")).filter("mpn IS NOT NULL")
    cut = F.when(F.col("step_key") % 3 == 0, F.expr("left(mpn, greatest(length(mpn) - 3, 0))")).when(F.col("step_key") % 3 == 1, F.expr("substr(mpn, 4)")).otherwise(F.col("mpn"))
    return names.completed_cuts(s.select("procedure_id", cut.alias("mpn")), s.select("procedure_id", F.col("mpn").alias("token")), "procedure_id")


def corrected_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two boxes a page laid out from an order, corrected by rows, cells and words laid out from its line items."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("seq"), "l_quantity", "l_discount", "l_tax")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), (F.col("o_custkey") % 40).alias("k"))
    boxes = o.select("page", F.explode(F.array(F.lit(1), F.lit(2))).alias("box_id"), "k").select(
        "page", "box_id", (F.col("k") + 10.0).alias("x0"), (F.col("box_id") * 90.0 - 80).alias("y0"), (F.col("k") + 120.0).alias("x1"), (F.col("box_id") * 90.0 - 15).alias("y1"), F.lit(300.0).alias("width"), F.lit(220.0).alias("height"))
    at = F.col("seq") % 2 + 1
    rows = li.select("page", at.alias("box_id"), "seq", F.lit(0.0).alias("x0"), (at * 90.0 - 85 + F.col("seq") * 9).alias("y0"), F.lit(200.0).alias("x1"), (at * 90.0 - 74 + F.col("seq") * 9 + F.col("l_tax") * 100).alias("y1"))
    cells = li.select("page", at.alias("box_id"), "seq", F.col("l_quantity").alias("x0"), F.lit(0.0).alias("y0"), (F.col("l_quantity") + 40 + F.col("l_discount") * 900).alias("x1"), F.lit(9.0).alias("y1"))
    words = li.select("page", "seq", (F.col("l_quantity") * 3).alias("x0"), (F.col("seq") * 21.0).alias("y0"), (F.col("l_quantity") * 3 + 25).alias("x1"), (F.col("seq") * 21.0 + 8).alias("y1"))
    return geometry.corrected_boxes(boxes, rows, cells, words)


def text_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of documents read as text files: how many, and their characters."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.coalesce("source", F.lit("x")), F.lit(".txt")).alias("name"), "text")
    e = readers.elements(d, "doc_id", "name", "text")
    return e.groupBy("doc_id").agg(F.count("*").alias("elements"), F.sum(F.length("text")).alias("chars"))


def design_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of entity models rendered from regions and their nations."""
    x = readers.escaped_xml
    nav = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("n_name")), lambda n: F.concat(F.lit('<NavigationProperty Name="'), x(n), F.lit('"/>'))), "").alias("nav"))
    r = table(spark, sf_dir, "region").join(nav, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    doc = F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("<Documentation><Summary>All of "), x("r_name"), F.lit("</Summary></Documentation>"))).otherwise("")
    xml = F.concat(F.lit('<Edmx xmlns="http://schemas.microsoft.com/ado/2009/11/edm"><EntityType Name="'), x("r_name"), F.lit('">'), doc, F.coalesce("nav", F.lit("")), F.lit("</EntityType></Edmx>"))
    return readers.edmx_designs(r.select(F.concat(F.lit("geo/"), F.col("r_regionkey").cast("string"), F.lit(".edmx")).alias("path"), xml.alias("xml")), "path", "xml").withColumn("relations", F.array_join("relations", ","))


def drift_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation items against the documents of the same number: how many are missing, unexpected, changed or in sync."""
    e = table(spark, sf_dir, "eval_items").select(F.col("item_id").alias("k"), "text")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), "text")
    return graph.drifted(e, d, "k", "text").groupBy("state").agg(F.count("*").alias("n"))


def approval_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run keys of the fifty events changed last."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", F.create_map(F.lit("type"), F.coalesce("event_type", F.lit("")), F.lit("id"), F.col("event_id").cast("string")).alias("props"))
    return incremental.approval_runs(e, "user_id", "ts", "props")


QUERIES = {f.__name__: f for f in (contracted_makers, printed_makers, completed_cut_parts, corrected_boxes, text_elements, design_entities, drift_states, approval_polls)}
_Q = lambda s: "'" + s.replace("'", "''") + "'"
_LIST = lambda ws: ", ".join(_Q(w) for w in ws)
_KEY = "regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]', '', 'g')"
_EDGED = lambda c: f"trim(trim(trim(coalesce({c}, '')), {_Q(names.EDGES)}))"
_ADDR = "(contains({0}, '@') OR contains({0}, '://') OR regexp_matches(lower({0}), '(^|[^a-z0-9_.])www\\.') OR len(list_filter(string_split(lower({0}), '.')[2:], lambda x: regexp_extract(x, '^[a-z0-9_]*') IN (" + _LIST(names.HOST_ENDS) + "))) > 0)"
_WORDS = f"list_filter(list_transform(regexp_split_to_array(form, '\\s+'), lambda w: lower(trim(w, {_Q(names.EDGES)}))), lambda w: w <> '')"
_SHAPED = f"(length(key) >= 4 AND NOT regexp_matches(form, '[0-9]') AND NOT {_ADDR.format('form')} AND len({_WORDS}) <= 3 AND len(list_filter({_WORDS}, lambda w: w IN ({_LIST(names.CONNECTIVES + names.HEADING_WORDS)}))) = 0)"
_BEST = "arg_max(form, (length(key), n, -first_at))"
_MPN = "(trim({0}) <> '' AND length(trim({0})) <= 48 AND length(trim({0})) - length(regexp_replace(trim({0}), '\\s', '', 'g')) <= 2 AND regexp_matches({0}, '\\d') AND NOT ends_with(trim({0}), ':'))"
SQL = {
    "contracted_makers": f"""WITH n AS (SELECT notice_id, {_KEY.format('mfr')} AS target, greatest(length({_KEY.format("regexp_split_to_array(trim(mfr), '\\s+')[1]")}) + 1, 4) AS least FROM notice_headers WHERE mfr IS NOT NULL),
      w AS (SELECT notice_id, header_id * 1000 + unnest(range(len(regexp_split_to_array(mfr, '\\s+')))) AS pos, unnest(regexp_split_to_array(mfr, '\\s+')) AS word FROM written_headers WHERE mfr IS NOT NULL),
      f AS (SELECT notice_id, pos, {_EDGED('word')} AS form, {_KEY.replace('{0}', _EDGED('word'))} AS key FROM w WHERE NOT {_ADDR.format('word')}),
      g AS (SELECT f.notice_id, form, key, count(*) AS n, min(pos) AS first_at FROM f JOIN n ON f.notice_id = n.notice_id AND length(key) >= least AND starts_with(target, key) GROUP BY ALL) SELECT notice_id, {_BEST} AS value FROM g GROUP BY 1""",
    "printed_makers": f"""WITH e AS (SELECT notice_id, header_id AS pos, {_EDGED('mfr')} AS form, {_KEY.replace('{0}', _EDGED('mfr'))} AS key FROM written_headers WHERE fire IN (1, 2)), k AS (SELECT DISTINCT {_KEY.format('mfr')} AS known FROM written_headers WHERE fire = 3 AND {_KEY.format('mfr')} <> ''),
      l AS ({' UNION '.join(f"SELECT form FROM e JOIN k ON key = known || '{s}'" for s in ('', *names.SUFFIXES))}),
      c AS (SELECT *, form IN (SELECT form FROM l) AS listed, {_SHAPED} AS shaped FROM e WHERE form <> ''), b AS (SELECT *, bool_or(listed) OVER (PARTITION BY notice_id) AS any_listed FROM c), d AS (SELECT * FROM b WHERE CASE WHEN any_listed THEN listed ELSE shaped END),
      g AS (SELECT notice_id, any_listed, form, key, count(*) AS n, min(pos) AS first_at FROM d GROUP BY ALL), m AS (SELECT *, arg_max(key, (length(key), key)) OVER (PARTITION BY notice_id) AS longest FROM g)
      SELECT notice_id, {_BEST} AS value, CASE WHEN bool_or(any_listed) THEN 'gazetteer' ELSE 'heuristic' END AS tier FROM m GROUP BY 1 HAVING bool_and(starts_with(longest, key))""",
    "completed_cut_parts": f"""WITH s AS (SELECT procedure_id, step_key, mpn FROM (SELECT procedure_id, step_key, unnest(internal_part_numbers) AS mpn FROM mfg_steps) WHERE mpn IS NOT NULL), t AS (SELECT DISTINCT procedure_id, mpn AS token FROM s),
      c AS (SELECT DISTINCT procedure_id, CASE step_key % 3 WHEN 0 THEN left(mpn, greatest(length(mpn) - 3, 0)) WHEN 1 THEN substr(mpn, 4) ELSE mpn END AS mpn FROM s),
      g AS (SELECT c.procedure_id, c.mpn, min(token) AS whole FROM c JOIN t ON c.procedure_id = t.procedure_id AND length(token) > length(trim(c.mpn)) AND (starts_with(token, trim(c.mpn)) OR ends_with(token, trim(c.mpn))) WHERE length(trim(c.mpn)) >= 4 AND {_MPN.format('c.mpn')} AND {_MPN.format('token')}
        AND NOT EXISTS (SELECT 1 FROM t u WHERE u.procedure_id = c.procedure_id AND u.token = trim(c.mpn)) GROUP BY ALL HAVING count(*) = 1)
      SELECT c.procedure_id, c.mpn, coalesce(whole, c.mpn) AS whole FROM c LEFT JOIN g ON c.procedure_id = g.procedure_id AND c.mpn = g.mpn""",
    "text_elements": "WITH p AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\n[ \\t]*\\n')) AS t FROM documents), q AS (SELECT doc_id, regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS t FROM p) SELECT doc_id, count(*) AS elements, sum(length(t)) AS chars FROM q WHERE t <> '' GROUP BY 1",
    "design_entities": "SELECT 'geo/' || r_regionkey || '.edmx' AS path, 'GEO' AS domain, r_name AS entity, CASE WHEN r_regionkey % 2 = 0 THEN 'All of ' || r_name ELSE 'Entity Model: ' || r_name END AS description, coalesce(string_agg(n_name, ',' ORDER BY n_name), '') AS relations FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name",
    "drift_states": "WITH e AS (SELECT item_id AS k, max(trim(coalesce(text, ''))) AS e FROM eval_items GROUP BY 1), d AS (SELECT doc_id AS k, max(trim(coalesce(text, ''))) AS a FROM documents GROUP BY 1) SELECT CASE WHEN a IS NULL THEN 'missing' WHEN e IS NULL THEN 'unexpected' WHEN a <> e THEN 'changed' ELSE 'in_sync' END AS state, count(*) AS n FROM e FULL JOIN d USING (k) GROUP BY 1",
    "approval_polls": "WITH e AS (SELECT user_id, ts, user_id || '_' || left(sha256('id=' || event_id || '|type=' || coalesce(event_type, '')), 12) AS run_key FROM events WHERE user_id IS NOT NULL), t AS (SELECT * FROM e ORDER BY ts DESC NULLS LAST, run_key LIMIT 50) SELECT DISTINCT user_id, run_key FROM t",
}
