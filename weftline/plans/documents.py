"""Document readers over documents rendered from the tables, so that what is read can be compared with its origin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from ..sources import documents as D


def _by_procedure(spark: SparkSession, sf_dir: str, row, head, sep: str, tail: str = "") -> DataFrame:
    s = table(spark, sf_dir, "mfg_steps").withColumn("row", row)
    g = s.groupBy("procedure_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step_key", "row"))), lambda x: x["row"]), sep).alias("body"))
    return g.select("procedure_id", F.concat(head, F.col("body"), F.lit(tail)).alias("content"))


def html_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedures rendered as HTML tables and read back as cells."""
    td = lambda c: F.concat(F.lit("<td>"), F.coalesce(c.cast("string"), F.lit("")), F.lit("</td>"))
    docs = _by_procedure(spark, sf_dir, F.concat(F.lit("<tr>"), td(F.col("step_id")), td(F.col("action_verb")), td(F.col("estimated_duration_minutes")), F.lit("</tr>")), F.lit("<table><tr><th>Step</th><th>Verb</th><th>Minutes</th></tr>"), "", "</table>")
    return D.read_with(docs, "procedure_id", "content", D.html_cells, "table_no int, row int, col int, cell string").drop("reason")


def requirement_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedures rendered as requirement exports and read back: identifier, level and the path of headings."""
    row = F.concat_ws(",", F.col("step_id"), F.when(F.col("step_key") % 4 == 0, "1").otherwise("2"), F.when(F.col("step_key") % 4 == 0, F.col("step_id")).otherwise(""), F.lit("text"))
    docs = _by_procedure(spark, sf_dir, row, F.lit("Project: P\nModule: M\n\nObject Identifier,Object Level,Object Heading,Object Text\n"), "\n")
    return D.read_with(docs, "procedure_id", "content", D.requirement_objects, "seq int, identifier string, level int, heading string, body string, path string").drop("reason", "body")


def xml_module_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedures rendered as XML data modules and read back as triples, counted by predicate."""
    step = F.concat(F.lit("<proceduralStep><para>"), F.col("step_id"), F.lit("</para></proceduralStep>"))
    head = F.concat(F.lit('<dmodule><identAndStatusSection><dmAddress><dmIdent><dmCode modelIdentCode="MRAD" systemDiffCode="A" systemCode="00" subSystemCode="0" subSubSystemCode="0" assyCode="00" disassyCode="00" disassyCodeVariant="A" infoCode="520" infoCodeVariant="A" itemLocationCode="A"/></dmIdent><dmAddressItems><dmTitle><techName>'), F.col("procedure_id"), F.lit("</techName></dmTitle></dmAddressItems></dmAddress></identAndStatusSection><content><procedure><mainProcedure>"))
    docs = _by_procedure(spark, sf_dir, step, head, "", "</mainProcedure></procedure></content></dmodule>")
    t = D.read_with(docs, "procedure_id", "content", D.xml_facts, "s string, p string, o string")
    return t.groupBy("procedure_id", F.regexp_extract("p", "^([^/]*)", 1).alias("predicate")).agg(F.count("*").alias("n"), F.max("o").alias("last"))


def markdown_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages rendered as markdown and read back as sections; fenced headings are none."""
    s = table(spark, sf_dir, "base_sections").select("section_id", "level", F.concat(F.repeat(F.lit("#"), F.lit(1) + (F.col("level") - 1) % 6), F.lit(" "), F.coalesce("title", F.lit("Untitled")), F.lit("\n```\n# no heading\n```\n")).alias("md"))
    return D.read_with(s, "section_id", "md", D.markdown_sections, "slug string, parent string, heading string, level int, body string").select("section_id", "heading", "level")


def element_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections rendered as element dumps and read back with their pages."""
    s = table(spark, sf_dir, "base_sections").filter("page_start IS NOT NULL AND title IS NOT NULL").select("section_id", F.concat(F.lit("--- Page "), F.col("page_start"), F.lit(" ---\n[Title] "), F.col("title"), F.lit("\n[NarrativeText] text\ngoes on")).alias("dump"))
    return D.read_with(s, "section_id", "dump", D.element_lines, "seq int, page int, kind string, text string").drop("reason")


def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Label : value`` lines of documents, the first value of each label in a document."""
    p = r"^\s*([A-Za-z][A-Za-z ]{0,30}?)\s*:\s+(\S.*)$"
    ls = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("n", "line")).filter(F.col("line").rlike(p))
    g = ls.select("doc_id", "n", F.regexp_extract("line", p, 1).alias("label"), F.regexp_extract("line", p, 2).alias("value"))
    return g.groupBy("doc_id", "label").agg(F.min_by("value", "n").alias("value"))


def catalogue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue scan: commented tables with lower-case qualified names and their schema's comment."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey).filter("n_name IS NOT NULL")
    return j.select(F.lower(F.concat_ws(".", F.regexp_replace("r_name", " ", "_"), F.regexp_replace("n_name", " ", "_"))).alias("entity"), F.col("r_name").alias("domain"), F.col("n_nationkey").alias("table_id"))


def picked_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sidecar of each file: the pinned one (of files divisible by seven the last), else the first by name."""
    w = table(spark, sf_dir, "written_headers").select("file_name", F.concat("file_name", F.lit("."), F.col("fire"), F.lit(".json")).alias("sidecar"), "notice_id").distinct()
    pins = w.filter("notice_id % 7 = 0").groupBy("file_name").agg(F.max("sidecar").alias("pinned"))
    first = w.groupBy("file_name").agg(F.min("sidecar").alias("first"))
    return first.join(pins, "file_name", "left").select("file_name", F.coalesce("pinned", "first").alias("sidecar"), F.col("pinned").isNotNull().alias("by_pin"))


QUERIES = {f.__name__: f for f in (html_table_cells, requirement_objects, xml_module_facts, markdown_sections, element_dumps, label_values, catalogue_rows, picked_sidecars)}
_ROW = "SELECT procedure_id, step_id, step_key, action_verb, estimated_duration_minutes, row_number() OVER (PARTITION BY procedure_id ORDER BY step_key) AS row FROM mfg_steps"
_LV = r"^\s*([A-Za-z][A-Za-z ]{0,30}?)\s*:\s+(\S.*)$"
SQL = {
    "html_table_cells": f"WITH r AS ({_ROW}), h AS (SELECT DISTINCT procedure_id FROM mfg_steps) SELECT procedure_id, 0 AS table_no, row, unnest([0, 1, 2]) AS col, unnest([step_id, coalesce(trim(action_verb), ''), coalesce(CAST(estimated_duration_minutes AS VARCHAR), '')]) AS cell FROM r UNION ALL SELECT procedure_id, 0, 0, unnest([0, 1, 2]), unnest(['Step', 'Verb', 'Minutes']) FROM h",
    "requirement_objects": f"WITH r AS ({_ROW}) SELECT procedure_id, row - 1 AS seq, step_id AS identifier, CASE WHEN step_key % 4 = 0 THEN 1 ELSE 2 END AS level, CASE WHEN step_key % 4 = 0 THEN step_id ELSE '' END AS heading, CASE WHEN step_key % 4 = 0 THEN '' ELSE coalesce(last_value(CASE WHEN step_key % 4 = 0 THEN step_id END IGNORE NULLS) OVER (PARTITION BY procedure_id ORDER BY row), '') END AS path FROM r",
    "xml_module_facts": f"WITH r AS ({_ROW}) SELECT procedure_id, 'step' AS predicate, count(*) AS n, max(step_id) AS last FROM r GROUP BY 1 UNION ALL SELECT DISTINCT procedure_id, 'type', 1, 'DataModule' FROM r UNION ALL SELECT DISTINCT procedure_id, 'infoCode', 1, '520' FROM r UNION ALL SELECT DISTINCT procedure_id, 'title', 1, procedure_id FROM r",
    "markdown_sections": "SELECT section_id, coalesce(title, 'Untitled') AS heading, 1 + (level - 1) % 6 AS level FROM base_sections WHERE level IS NOT NULL",
    "element_dumps": "SELECT section_id, unnest([0, 1]) AS seq, page_start AS page, unnest(['Title', 'NarrativeText']) AS kind, unnest([title, 'text' || chr(10) || 'goes on']) AS text FROM base_sections WHERE page_start IS NOT NULL AND title IS NOT NULL",
    "label_values": f"WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS n, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, regexp_extract(line, '{_LV}', 1) AS label, arg_min(regexp_extract(line, '{_LV}', 2), n) AS value FROM l WHERE regexp_matches(line, '{_LV}') GROUP BY ALL",
    "catalogue_rows": "SELECT lower(replace(r_name, ' ', '_') || '.' || replace(n_name, ' ', '_')) AS entity, r_name AS domain, n_nationkey AS table_id FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name IS NOT NULL",
    "picked_sidecars": "SELECT file_name, CASE WHEN notice_id % 7 = 0 THEN max(s) ELSE min(s) END AS sidecar, notice_id % 7 = 0 AS by_pin FROM (SELECT file_name, notice_id, file_name || '.' || fire || '.json' AS s FROM written_headers) GROUP BY file_name, notice_id",
}
