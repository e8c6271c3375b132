"""Cells, words, captions, seals and registrations of pages, and texts of exchange formats, built from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import recognise as R
from ..operators import elements, review, trust
from ..session import table
from ..sources import documents as D


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list fields of a step as one row of cells of its procedure's grid; what a list lacks is an empty cell."""
    s = table(spark, sf_dir, "mfg_steps")
    lists = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in ("internal_part_numbers", "tooling", "figure_references")])
    head = F.array(F.concat(F.coalesce("action_verb", F.lit("")), F.lit(":")), F.coalesce("instruction_text", F.lit("")))
    return s.select(F.col("procedure_id").alias("grid_id"), F.col("step_key").alias("row"), F.posexplode(F.concat(lists, head)).alias("col", "cell")).withColumn("cell", F.coalesce("cell", F.lit("")))


def form_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of procedures with the number of cells that end like a label."""
    return review.form_regions(_cells(spark, sf_dir))


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of cells, the instruction left out, that hold a part number and no prose."""
    return review.part_rows(_cells(spark, sf_dir).filter("NOT cell LIKE '% % % %'"))


def rebuilt_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of procedures: those of one width are tables of tier 1."""
    return review.rebuilt_tables(_cells(spark, sf_dir), "grid_id")


def forwarded_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles given to columns of orders by their line items, checked against a width."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_partkey") % 2).alias("seq"), (F.col("l_suppkey") % 6 - 1).cast("int").alias("col"), F.when(F.col("l_returnflag") == "A", "affected").when(F.col("l_returnflag") == "N", "replacement").otherwise("note").alias("role"), F.lit(4).alias("width"))
    return review.forwarded_roles(li).groupBy("role", "refusal").agg(F.count("*").alias("n"))


def unique_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part numbers that stand in one place of their procedure alone, with the step."""
    s = table(spark, sf_dir, "mfg_steps").select("procedure_id", F.col("step_key").alias("box"), F.explode("internal_part_numbers").alias("word"))
    return review.unique_boxes(s, s.select("procedure_id", F.col("word").alias("mpn")), "procedure_id")


def label_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the line items of an order as grids the nearest of its other items above as label."""
    li = table(spark, sf_dir, "lineitem")
    grids = li.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("grid"), (F.col("l_linenumber") * 10.0).alias("head"))
    labels = li.select(F.col("l_orderkey").alias("page"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("label"), (F.col("l_linenumber") * 10.0 + F.col("l_quantity") / 5).alias("foot"))
    return review.label_above(labels, grids, "page")


def crop_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of steps with the address of the upload of that name in their procedure, where there is one."""
    s = table(spark, sf_dir, "mfg_steps")
    e = s.select("procedure_id", "step_key", F.explode("figure_references").alias("f")).withColumn("image_path", F.concat(F.lit("out/"), F.col("f")))
    up = s.select("procedure_id", F.get("figure_references", F.lit(0)).alias("name")).filter("name IS NOT NULL").distinct().withColumn("url", F.concat(F.lit("s://"), "name"))
    return review.crops_of(e, up, "procedure_id").groupBy("procedure_id").agg(F.count("*").alias("figures"), F.count("url").alias("with_crop"))


def worst_seals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each notice the greatest counts of blank fields over its fires."""
    w = table(spark, sf_dir, "written_headers").groupBy("notice_id", "fire").agg(F.count_if(F.col("mfr").isNull()).alias("no_mfr"), F.count_if(F.col("pub_date").isNull()).alias("no_date"))
    return review.worst_seals(w, ["notice_id"], ["no_mfr", "no_date"])


def baseline_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letter pairs for one of the control pair over all documents."""
    t = F.lower(F.coalesce("text", F.lit("")))
    d = table(spark, sf_dir, "documents").select((elements.pair_count(t, "th") + elements.pair_count(t, "er")).alias("control"), *[elements.pair_count(t, p).alias(p) for p in elements.PAIR_RATIOS])
    return review.baseline_ratios(d, [*elements.PAIR_RATIOS])


def captioned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a procedure as lines on a page; those of a long duration are captions, wide gaps break a block."""
    s = table(spark, sf_dir, "mfg_steps").select("procedure_id", F.col("step_key").cast("double").alias("y"), F.concat(F.lit("s"), F.col("step_key").cast("string")).alias("text"), F.coalesce(F.col("estimated_duration_minutes") > 30, F.lit(False)).alias("is_caption"))
    return trust.rows_under_captions(s, "procedure_id", 4.0)


def registered_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as tools registered at regions, their properties as rows."""
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("src"), F.lit("IN").alias("rel"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("dst"), F.create_map(F.lit("name"), F.col("n_name"), F.lit("key"), F.col("n_nationkey").cast("string")).alias("props"))
    return review.registrations(n)


def landed_subclasses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as subclasses of their courses: landed where the course is one that slides name."""
    e = table(spark, sf_dir, "concept_records").select(F.col("id").alias("child"), F.col("course_id").alias("parent"))
    classes = table(spark, sf_dir, "slide_concepts").select(F.col("course_id").alias("id")).unionByName(table(spark, sf_dir, "concept_records").select("id"))
    return review.landed(e, classes).groupBy("landed").agg(F.count("*").alias("n"))


def excluded_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages as addresses: how many are excluded by prefix or shape."""
    d = table(spark, sf_dir, "documents").withColumn("iri", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("urn:meta:"), "source")).otherwise(F.concat_ws(":", "source", "package")))
    return review.excluded(d, "iri", ["urn:meta:"])[1]


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes around polygons of events; every fifth has no points."""
    e = table(spark, sf_dir, "events")
    pts = F.when(F.col("event_id") % 5 != 0, F.array(F.array(F.col("value"), F.col("value") * 2), F.array(F.col("user_id").cast("double"), F.col("value") / 4), F.array(F.lit(3.0), F.lit(4.0)))).otherwise(F.array().cast("array<array<double>>"))
    b = R.bounding_box(pts)
    return e.filter("value IS NOT NULL").select("event_id", *[b[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def affected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of packages that list families and models of an affected section."""
    d = table(spark, sf_dir, "documents")
    fam = F.concat(F.lit("fam"), F.col("doc_id").cast("string"))
    text = F.concat(F.when(F.col("doc_id") % 2 == 0, "Affected devices\n").otherwise("Part list (12)\n"), fam, F.lit(" / mod"), F.col("n_chars").cast("string"), F.lit("A\n"), fam, F.lit("/zz"), F.col("doc_id").cast("string"))
    return review.affected_pages(d.select("package", F.col("doc_id").alias("page"), text.alias("text")), "package").select("package", "page", "pairs", "stated", "shortfall")


def titles_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of runbooks from file names."""
    p = F.concat(F.lit("a/b/"), F.replace(F.lower("name"), F.lit(" "), F.lit("-")), F.lit(".md"))
    c = table(spark, sf_dir, "slide_concepts").filter("name IS NOT NULL")
    return c.select("concept_key", R.doc_title(p).alias("title"))


def _read(spark, sf_dir, source, key, text, parser, schema) -> DataFrame:
    return D.read_with(table(spark, sf_dir, source).select(key, text.alias("content")), key, "content", parser, schema)


def exchange_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of exchange files written from parts."""
    q = lambda c: F.concat(F.lit("'"), F.replace(F.col(c), F.lit("'"), F.lit("''")), F.lit("'"))
    text = F.concat(F.lit("ISO-10303-21;\nHEADER;\nFILE_NAME("), q("p_name"), F.lit(",'2024',("), q("p_brand"), F.lit("));\nFILE_SCHEMA(("), q("p_type"), F.lit("));\nENDSEC;\n#1=PRODUCT("), q("p_name"), F.lit(",$);\n"))
    return _read(spark, sf_dir, "part", "p_partkey", text, D.step_strings, "field string, pos int, value string")


def drawing_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of drawings written from parts."""
    text = F.concat(F.lit("0\nSECTION\n9\n$PROJECTNAME\n1\n"), "p_brand", F.lit("\n0\nATTRIB\n2\nNAME\n1\n"), "p_name", F.lit("\n0\nATTDEF\n2\nNAME\n1\nlater\n999\nremark\n0\nATTDEF\n2\nTYPE\n1\n"), "p_type", F.lit("\n0\nENDSEC\n"))
    return _read(spark, sf_dir, "part", "p_partkey", text, D.dxf_attributes, "tag string, value string")


def prompt_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of prompts written from suppliers."""
    text = F.concat(F.lit("before\n## system\nYou are "), "s_name", F.lit(".\n\n## user \n{{x}} "), F.col("s_suppkey").cast("string"))
    return _read(spark, sf_dir, "supplier", "s_suppkey", text, D.prompt_sections, "name string, body string")


def schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of schemas written from nations."""
    text = F.concat(F.lit('{"properties": {"'), "n_name", F.lit('": {"type": "object", "description": "nation", "properties": {"key": {"enum": [1, '), F.col("n_nationkey").cast("string"), F.lit(']}}}, "list": {"type": "array", "items": {"properties": {"x": {"type": ["string", "null"]}}}}}}'))
    return _read(spark, sf_dir, "nation", "n_nationkey", text, D.schema_fields, "field string, kind string, note string")


def interface_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of interface definitions written from nations."""
    text = F.concat(F.lit("module m {\n struct S"), F.col("n_nationkey").cast("string"), F.lit(" {\n  // the key\n  long k;\n  sequence<string> names; // of "), "n_name", F.lit("\n };\n};\n"))
    return _read(spark, sf_dir, "nation", "n_nationkey", text, D.idl_fields, "struct string, field string, kind string, note string")


def pipe_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written from suppliers as pipe grids."""
    text = F.concat(F.lit("<table><tr><th>Name</th><th>Key|No</th></tr><tr><td>"), "s_name", F.lit("</td><td>"), F.col("s_suppkey").cast("string"), F.lit("<br>x</td></tr></table>"))
    return _read(spark, sf_dir, "supplier", "s_suppkey", text, lambda t: [(D.markdown_grid(t),)], "grid string")


QUERIES = {f.__name__: f for f in (form_regions, part_rows, rebuilt_tables, forwarded_roles, unique_boxes, label_above, crop_addresses, worst_seals, baseline_ratios, captioned_rows, registered_tools, landed_subclasses, excluded_addresses, polygons, affected_pages, titles_of_files, exchange_files, drawing_attributes, prompt_sections, schema_fields, interface_fields, pipe_grids)}
_CELLS = """c AS (SELECT procedure_id AS grid_id, step_key AS row, unnest(range(len(l))) AS col, coalesce(unnest(l), '') AS cell FROM (SELECT procedure_id, step_key, list_concat(list_concat(list_concat(coalesce(internal_part_numbers, []), coalesce(tooling, [])), coalesce(figure_references, [])), [coalesce(action_verb, '') || ':', coalesce(instruction_text, '')]) AS l FROM mfg_steps))"""
_MPN = "(trim({0}) <> '' AND length(trim({0})) <= 48 AND length(trim({0})) - length(regexp_replace(trim({0}), '\\s', '', 'g')) <= 2 AND regexp_matches({0}, '\\d') AND NOT ends_with(trim({0}), ':'))"
_PAIR = "len(list_filter(range(1, length(t)), lambda i: substr(t, i, 2) = '{0}'))"
SQL = {
    "form_regions": f"WITH {_CELLS} SELECT grid_id, count(*) FILTER (regexp_full_match(trim(cell), '[^:]{{2,40}}:')) AS labels, count(*) FILTER (regexp_full_match(trim(cell), '[^:]{{2,40}}:')) >= 3 AS is_form FROM c GROUP BY 1",
    "part_rows": f"WITH {_CELLS} SELECT grid_id, row FROM c WHERE NOT cell LIKE '% % % %' GROUP BY ALL HAVING bool_or({_MPN.format('cell')})",
    "rebuilt_tables": f"WITH {_CELLS}, r AS (SELECT grid_id, row, count(*) AS w FROM c GROUP BY ALL) SELECT grid_id, count(*) AS rows, max(w) AS width, CASE WHEN count(DISTINCT w) = 1 THEN 1 END AS tier FROM r GROUP BY 1",
    "forwarded_roles": "WITH l AS (SELECT l_orderkey AS doc, l_partkey % 2 AS seq, l_suppkey % 6 - 1 AS col, CASE l_returnflag WHEN 'A' THEN 'affected' WHEN 'N' THEN 'replacement' ELSE 'note' END AS role FROM lineitem), r AS (SELECT role, CASE WHEN col < 0 OR col >= 4 THEN 'outside the grid' WHEN count(*) OVER (PARTITION BY doc, seq, col) > 1 THEN 'given twice' WHEN role = 'note' THEN 'no such role' END AS refusal FROM l) SELECT role, refusal, count(*) AS n FROM r GROUP BY ALL",
    "unique_boxes": "SELECT procedure_id, word AS mpn, min(step_key) AS box FROM (SELECT procedure_id, step_key, unnest(internal_part_numbers) AS word FROM mfg_steps) WHERE word IS NOT NULL AND procedure_id IS NOT NULL GROUP BY ALL HAVING count(*) = 1",
    "label_above": "SELECT g.l_orderkey AS page, g.l_linenumber AS grid, arg_max('p' || b.l_partkey, (b.l_linenumber * 10.0 + b.l_quantity / 5, 'p' || b.l_partkey)) AS label FROM lineitem g JOIN lineitem b ON g.l_orderkey = b.l_orderkey AND b.l_linenumber * 10.0 + b.l_quantity / 5 <= g.l_linenumber * 10.0 + 2 GROUP BY ALL",
    "crop_addresses": "WITH e AS (SELECT procedure_id, unnest(figure_references) AS f FROM mfg_steps), u AS (SELECT DISTINCT procedure_id, figure_references[1] AS name FROM mfg_steps WHERE figure_references[1] IS NOT NULL) SELECT e.procedure_id, count(*) AS figures, count(u.name) AS with_crop FROM e LEFT JOIN u ON u.procedure_id = e.procedure_id AND u.name = regexp_extract('out/' || e.f, '[^/\\\\]*$') GROUP BY 1",
    "worst_seals": "WITH w AS (SELECT notice_id, fire, count(*) FILTER (mfr IS NULL) AS a, count(*) FILTER (pub_date IS NULL) AS b FROM written_headers GROUP BY ALL) SELECT notice_id, max(a) AS no_mfr, max(b) AS no_date, max(a) + max(b) AS cut FROM w GROUP BY 1",
    "baseline_ratios": f"WITH t AS (SELECT lower(coalesce(text, '')) AS t FROM documents), c AS (SELECT sum({_PAIR.format('th')} + {_PAIR.format('er')}) AS control, {', '.join(f'sum({_PAIR.format(p)}) AS {p}' for p in elements.PAIR_RATIOS)} FROM t) " + " UNION ALL ".join(f"SELECT '{p}' AS pair, round({p} / control, 4) AS ratio FROM c" for p in elements.PAIR_RATIOS),
    "captioned_rows": """WITH l AS (SELECT procedure_id, step_key::DOUBLE AS y, 's' || step_key AS text, coalesce(estimated_duration_minutes > 30, false) AS cap FROM mfg_steps), g AS (SELECT *, sum(CASE WHEN cap THEN 1 ELSE 0 END) OVER w AS b, coalesce(y - lag(y) OVER w > 4, false) AND NOT cap AS far FROM l WINDOW w AS (PARTITION BY procedure_id ORDER BY y, text)),
      h AS (SELECT *, bool_or(far) OVER v AS broken, max(CASE WHEN cap THEN text END) OVER v AS c FROM g WINDOW v AS (PARTITION BY procedure_id, b ORDER BY y, text)) SELECT procedure_id, y, text, CASE WHEN NOT broken THEN c END AS caption FROM h WHERE NOT cap""",
    "registered_tools": "SELECT 'n' || n_nationkey AS src, 'IN' AS rel, 'r' || n_regionkey AS dst, unnest(['name', 'key']) AS key, unnest([n_name, CAST(n_nationkey AS VARCHAR)]) AS value FROM nation",
    "landed_subclasses": "WITH e AS (SELECT DISTINCT id AS child, course_id AS parent FROM concept_records) SELECT coalesce(child IN (SELECT id FROM concept_records WHERE id IS NOT NULL), false) AND coalesce(parent IN (SELECT course_id FROM slide_concepts WHERE course_id IS NOT NULL UNION SELECT id FROM concept_records WHERE id IS NOT NULL), false) AS landed, count(*) AS n FROM e GROUP BY 1",
    "excluded_addresses": "WITH i AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'urn:meta:' || source ELSE concat_ws(':', source, package) END AS iri FROM documents) SELECT CASE WHEN iri IS NULL OR NOT regexp_matches(iri, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'no address' WHEN starts_with(iri, 'urn:meta:') THEN 'urn:meta:' ELSE 'kept' END AS reason, count(*) AS n FROM i GROUP BY 1",
    "polygons": "SELECT event_id, " + ", ".join(f"CASE WHEN event_id % 5 <> 0 THEN {f}({a}, {b}, {c}) END AS {n}" for n, f, a, b, c in (("x1", "least", "value", "user_id::DOUBLE", "3.0"), ("y1", "least", "value * 2", "value / 4", "4.0"), ("x2", "greatest", "value", "user_id::DOUBLE", "3.0"), ("y2", "greatest", "value * 2", "value / 4", "4.0"))) + " FROM events WHERE value IS NOT NULL",
    "affected_pages": """WITH p AS (SELECT package, doc_id, (CASE WHEN length('mod' || n_chars || 'A') >= 4 THEN 1 ELSE 0 END) + (CASE WHEN length('zz' || doc_id) >= 4 THEN 1 ELSE 0 END) AS pairs, doc_id % 2 = 0 AS named, CASE WHEN doc_id % 2 <> 0 THEN 12 END AS stated FROM documents),
      w AS (SELECT *, sum(pairs) OVER v AS every, max(stated) OVER v AS cap, bool_or(named) OVER v AS any_named FROM p WINDOW v AS (PARTITION BY package)) SELECT package, doc_id AS page, pairs, stated, coalesce(every < 0.9 * cap, false) AS shortfall FROM w WHERE every >= 2 AND pairs > 0 AND (named OR stated IS NOT NULL OR any_named)""",
    "exchange_files": "SELECT CAST(NULL AS VARCHAR) AS reason, p_partkey, unnest(['FILE_SCHEMA', 'FILE_NAME', 'FILE_NAME', 'FILE_NAME', 'PRODUCT']) AS field, unnest([0, 0, 1, 2, 0]) AS pos, unnest([p_type, p_name, '2024', p_brand, p_name]) AS value FROM part",
    "drawing_attributes": "SELECT CAST(NULL AS VARCHAR) AS reason, p_partkey, unnest(['$PROJECTNAME', 'NAME', 'TYPE']) AS tag, unnest([p_brand, p_name, p_type]) AS value FROM part",
    "prompt_sections": "SELECT CAST(NULL AS VARCHAR) AS reason, s_suppkey, unnest(['system', 'user']) AS name, unnest(['You are ' || s_name || '.', '{{x}} ' || s_suppkey]) AS body FROM supplier",
    "schema_fields": "SELECT CAST(NULL AS VARCHAR) AS reason, n_nationkey, unnest([n_name, n_name || '.key', 'list', 'list[].x']) AS field, unnest(['object', 'enum', 'array', 'string|null']) AS kind, unnest(['nation', 'one of 1, ' || n_nationkey, '', '']) AS note FROM nation",
    "interface_fields": "SELECT CAST(NULL AS VARCHAR) AS reason, n_nationkey, 'm::S' || n_nationkey AS struct, unnest(['k', 'names']) AS field, unnest(['long', 'sequence<string>']) AS kind, unnest(['the key', 'of ' || n_name]) AS note FROM nation",
    "pipe_grids": "SELECT CAST(NULL AS VARCHAR) AS reason, s_suppkey, '| Name | Key\\|No |' || chr(10) || '|---|---|' || chr(10) || '| ' || s_name || ' | ' || s_suppkey || ' x |' AS grid FROM supplier",
    "titles_of_files": "SELECT concept_key, array_to_string(list_transform(string_split(regexp_replace(regexp_replace(regexp_extract('a/b/' || replace(lower(name), ' ', '-') || '.md', '[^/]*$'), '\\.[A-Za-z0-9]{1,5}$', ''), '[-_]+', ' ', 'g'), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title FROM slide_concepts WHERE name IS NOT NULL",
}
