"""Review, threading, packing, gates and recognition over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as K
from ..functions import recognise as R
from ..functions import text as X
from ..operators import concepts as C
from ..operators import graph as G
from ..operators import review as V
from ..operators import trust
from ..session import materialize, table


def threaded_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps as grids of a procedure: how each gets its columns."""
    s = table(spark, sf_dir, "mfg_steps")
    n = lambda c: F.size(F.coalesce(F.col(c), F.array()))
    g = s.select(F.col("procedure_id").alias("doc"), F.col("step_key").alias("seq"), (F.col("step_key") / 4).cast("int").alias("page"), (n("tooling") % 3).alias("width"), (n("figure_references") > 0).alias("declared"), (F.col("step_key") % 7 == 0).alias("caption"), (F.col("step_key") % 5 == 0).alias("label"), n("consumables").alias("forms"), n("internal_part_numbers").alias("mpn_rows"))
    return V.grid_outcomes(g)


def review_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of notices that somebody has to approve, with the reason of doubt."""
    return V.review_items(table(spark, sf_dir, "notice_headers"), ["notice_id"], {"mfr": ("mfr", "mfr_source"), "pub_date": ("pub_date", "pub_date_source"), "ltb": ("doc_level_ltb_date", "doc_level_ltb_date_source")})


def sourced_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of candidates that their snippets print, and those they do not."""
    c = table(spark, sf_dir, "ltb_candidates")
    return V.sourced_or_refused(c.select("candidate_id", F.col("source").alias("value")), c.select("candidate_id", F.col("snippet").alias("text")), "candidate_id")


def title_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type of each notice by the first of its titles (categories, then summary) that says anything."""
    n = table(spark, sf_dir, "notice_headers")
    t = n.select("notice_id", F.posexplode(F.concat(F.coalesce("categories", F.array().cast("array<string>")), F.array("summary"))).alias("seq", "title"))
    return V.first_title_type(t, "notice_id")


def leaf_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaves each notice could belong to, by score."""
    n = table(spark, sf_dir, "notice_headers")
    t = n.select("notice_id", F.posexplode(F.array("doc_type", "summary")).alias("seq", "title")).withColumn("is_title", F.col("seq") == 0)
    return V.leaf_candidates(t, "notice_id")


def candidate_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of each notice as one text."""
    c = table(spark, sf_dir, "ltb_candidates")
    n = F.expr("row_number() OVER (PARTITION BY notice_id ORDER BY candidate_id)")
    return V.rendered_candidates(c.withColumn("n", n), "notice_id")


def deck_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages as decks whose pages are titled by numbers."""
    s = table(spark, sf_dir, "base_sections").filter("page_start IS NOT NULL").dropDuplicates(["package_id", "page_start", "level"])
    t = s.groupBy("package_id", F.col("page_start").alias("page")).agg(F.min("level").alias("level"))
    num = F.concat_ws(".", F.col("page").cast("string"), F.when(F.col("level") > 1, "1"), F.when(F.col("level") > 2, "2"))
    return V.deck_outline(t.select("package_id", "page", F.concat(num, F.lit(" Title")).alias("title")), "package_id")


def packed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instructions packed to at most six hundred characters."""
    s = table(spark, sf_dir, "mfg_steps").select("procedure_id", F.col("step_key").alias("seq"), F.col("instruction_text").alias("text"))
    return V.packed_elements(s, "procedure_id", 600).select("procedure_id", "pack", "n")


def reused_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name most used for each concept id."""
    return V.mode_of(table(spark, sf_dir, "concept_records"), "id", "name")


def reading_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gate over the readings: identity present, dates present, revision stable."""
    w = table(spark, sf_dir, "written_headers")
    rules = {"identity_present": F.col("mfr").isNotNull() & F.col("doc_id").isNotNull(), "date_present": F.coalesce(F.trim("pub_date"), F.lit("")) != "", "zone_known": F.col("site_tz").isNotNull()}
    v = w.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), c.alias("ok")) for k, c in rules.items()])).alias("x")).select("x.*")
    return V.gate(v, ["identity_present"])


def slide_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slide edges to add where even slides are linked already; the counts must add up."""
    s = table(spark, sf_dir, "slide_concepts")
    sec = C.course_sections(s)
    have = C.members(s.filter("slide % 2 = 0").select("course_id", "slide").distinct(), sec).select("course_id", "section", "slide").distinct()
    return V.backfilled(s, sec, materialize(have, "have"))[1]


def synced_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples after every third record's are synchronised anew without its label."""
    c = table(spark, sf_dir, "concept_records").select(F.concat(F.lit("urn:c:"), "record_id").alias("uri"), "record_id", "name", "domain")
    store = G.triples_of(c, "uri", {"name": "label", "domain": "in"}, F.lit("g"))
    new = G.triples_of(c.filter("record_id % 3 = 0"), "uri", {"domain": "in"}, F.lit("g"))
    return V.wiped_and_loaded(store, new).groupBy("p").agg(F.count("*").alias("n"))


def cell_recognition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite cells, label echoes and names among parts and makers."""
    s = table(spark, sf_dir, "mfg_steps").select("step_key", F.array_join(F.filter("internal_part_numbers", lambda x: x.isNotNull()), ",\n").alias("cell")).filter("cell <> ''")
    label = F.element_at(F.array(*[F.lit(x) for x in R.LABELS]), (F.col("step_key") % len(R.LABELS) + 1).cast("int"))
    return s.select("step_key", F.size(R.composite_parts("cell")).alias("fragments"), R.is_label_echo(F.concat(F.initcap(label), F.lit(" : / "), F.lit("Rev"), F.when(F.col("step_key") % 4 == 0, F.concat(F.lit("/"), F.col("step_key").cast("string"))).otherwise(""))).alias("echo"), R.is_name_shape("cell").alias("name"))


def affected_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that name an affected section as they stand and behind a title that ends in ``Affected``, and their notice numbers."""
    d = table(spark, sf_dir, "documents")
    text = F.concat_ws(" ", F.concat("title", F.lit(" affected")), "text")
    return d.select("doc_id", R.names_affected_section("text").alias("affected"), R.names_affected_section(text).alias("titled"), R.notice_number("text").alias("number"))


def escaped_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as addresses and as literals."""
    c = table(spark, sf_dir, "concept_records")
    return c.select("record_id", R.escaped_iri("name").alias("iri"), R.escaped_literal("name").alias("literal"))


def folded_concept_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept ids by names in any presentation form; records that share one, counted."""
    c = table(spark, sf_dir, "concept_records")
    return c.groupBy(R.concept_id("domain", F.coalesce("name", "name_normalized")).alias("concept_id")).agg(F.count("*").alias("records"))


def work_package_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of work package tags chosen by part keys among all tags, some in a name space, in capitals or unknown; the tally of those that fall through."""
    tags = F.array(*[F.lit(t) for t in [*K.WP_KINDS, "nosuchwp"]])
    tag = F.element_at(tags, (F.col("p_partkey") % len([*K.WP_KINDS, 0]) + 1).cast("int"))
    tag = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("{urn:x}"), tag)).when(F.col("p_size") % 7 == 0, F.upper(tag)).otherwise(tag)
    k = K.wp_kind(tag)
    return table(spark, sf_dir, "part").groupBy(k["kind"].alias("kind"), k["fallthrough"].alias("fallthrough"), k["refused"].alias("refused")).agg(F.count("*").alias("n"))


def provenance_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance blocks of documents."""
    s = R.stamp({"source": F.col("source"), "domain": F.col("package"), "revision": F.col("page_count")})
    return table(spark, sf_dir, "documents").select("doc_id", s.alias("s")).select("doc_id", "s.*")


def kept_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates found near phrases in snippets that the candidate itself states: by phrase."""
    c = table(spark, sf_dir, "ltb_candidates").select("candidate_id", "iso")
    d = trust.scanned_dates(table(spark, sf_dir, "ltb_candidates"), "candidate_id", "snippet").withColumnRenamed("iso", "found")
    return d.join(c, "candidate_id").groupBy("phrase").agg(F.count("*").alias("dates"), F.count_if(F.col("found") == F.col("iso")).alias("stated"))


QUERIES = {f.__name__: f for f in (threaded_grids, review_items, sourced_values, title_types, leaf_candidates, candidate_blocks, deck_outlines, packed_steps, reused_names, reading_gate, slide_backfill, synced_store, cell_recognition, affected_headings, escaped_names, folded_concept_ids, work_package_kinds, provenance_stamps, kept_dates)}
_ANY = lambda terms: "(" + " OR ".join(f"contains(s, '{t}')" for t in terms) + ")"
_SIGNALS = f"""k AS (SELECT *, regexp_matches(s, '\\bpcn\\b') AS pcn, regexp_matches(s, '\\bpdn\\b') AS pdn, {_ANY(X.PCN_TERMS)} AS kp, {_ANY(X.PDN_TERMS)} AS kd FROM t), a AS (SELECT *, (pcn AND pdn) OR (pcn AND kd) OR (pdn AND kp) OR (NOT pcn AND NOT pdn AND kp AND kd) AS unclear FROM k),
  g AS (SELECT notice_id, seq, CASE WHEN unclear THEN 'ambiguous' WHEN pcn OR pdn THEN 'code' ELSE 'keyword' END AS signal, CASE WHEN unclear THEN NULL WHEN pcn THEN 'PCN' WHEN pdn THEN 'PDN' WHEN kd THEN 'PDN' ELSE 'PCN' END AS kind FROM a WHERE pcn OR pdn OR kp OR kd)"""
_LABELS = ", ".join(f"'{x}'" for x in R.LABELS)
_TAGS, _KINDS = (", ".join(f"'{x}'" for x in side) for side in zip(*K.WP_KINDS.items()))


def _affected(text: str) -> str:
    """Whether a text names an affected section, over lists of words."""
    nouns = ", ".join(f"'{n}'" for n in R.AFFECTED_NOUNS)
    head, last = "regexp_extract(w[i + {}], '^[a-z0-9_]*')", "regexp_extract(w[i], '[a-z0-9_]*$')"
    between = "regexp_full_match(w[i + 1], '[a-z][a-z0-9&/-]*') AND length(w[i + 1]) <= 15"
    forward = f"{last} = 'affected' AND ({head.format(1)} IN ({nouns}) OR ({between} AND {head.format(2)} IN ({nouns})))"
    found = f"list_filter(range(1, len(w) + 1), lambda i: coalesce({forward}, false) OR coalesce({last} IN ({nouns}) AND {head.format(1)} = 'affected', false))"
    return f"coalesce((SELECT len({found}) > 0 FROM (SELECT string_split(trim(regexp_replace(lower({text}), '\\s+', ' ', 'g')), ' ') AS w)), false)"


_IRI = "name"
for _c, _e in (("%", "%25"), (" ", "%20"), ('"', "%22"), ("<", "%3C"), (">", "%3E"), ("\\", "%5C"), ("^", "%5E"), ("`", "%60"), ("{", "%7B"), ("|", "%7C"), ("}", "%7D")):
    _IRI = f"replace({_IRI}, '{_c}', '{_e}')"
_SECS = "cs AS (SELECT DISTINCT course_id FROM slide_concepts), sec AS (SELECT course_id, 's' || k AS section, k * 20 + 1 AS start, (k + 1) * 20 AS stop FROM cs, range(6) t(k) UNION ALL SELECT course_id, 's' || (k // 2) || '_' || (k % 2), k * 10 + 1, (k + 1) * 10 FROM cs, range(12) t(k) UNION ALL SELECT course_id, 'all', 1, 0 FROM cs)"
SQL = {
    "threaded_grids": """WITH g AS (SELECT procedure_id AS doc, step_key AS seq, CAST(floor(step_key / 4) AS INT) AS page, len(coalesce(tooling, [])) % 3 AS width, len(coalesce(figure_references, [])) > 0 AS declared, step_key % 7 = 0 AS caption, step_key % 5 = 0 AS label, len(coalesce(consumables, [])) AS forms, len(coalesce(internal_part_numbers, [])) AS mpn_rows FROM mfg_steps),
      p AS (SELECT *, lag(page) OVER (PARTITION BY doc ORDER BY seq) AS pp, last_value(CASE WHEN declared THEN width END IGNORE NULLS) OVER w AS lw, last_value(CASE WHEN declared THEN seq END IGNORE NULLS) OVER w AS ls FROM g WINDOW w AS (PARTITION BY doc ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      q AS (SELECT *, max(CASE WHEN page - pp > 1 THEN seq END) OVER (PARTITION BY doc ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gap FROM p),
      o AS (SELECT *, CASE WHEN NOT declared AND NOT caption AND forms >= 3 THEN 'declined_form' WHEN declared THEN 'declared' WHEN lw = width AND (gap IS NULL OR ls >= gap) THEN 'inherited' WHEN caption THEN 'caption' WHEN label THEN 'label' WHEN mpn_rows > 0 THEN 'declined_rows' ELSE 'empty' END AS outcome FROM q)
      SELECT doc, seq, outcome, CASE WHEN outcome = 'declined_rows' THEN mpn_rows || ' rows hold part numbers' END AS reason FROM o""",
    "review_items": "SELECT notice_id, field, value, source, CASE WHEN source IS NULL THEN 'no source' WHEN NOT contains(upper(source), upper(value)) THEN 'source does not hold the value' END AS reason FROM (" + " UNION ALL ".join(f"SELECT notice_id, '{f}' AS field, {v} AS value, {v}_source AS source FROM notice_headers" for f, v in (("mfr", "mfr"), ("pub_date", "pub_date"), ("ltb", "doc_level_ltb_date"))) + ") WHERE value IS NOT NULL AND trim(value) <> ''",
    "sourced_values": "SELECT candidate_id, source AS value, coalesce(contains(snippet, source), false) AS kept, CASE WHEN NOT coalesce(contains(snippet, source), false) THEN 'not printed' END AS reason FROM ltb_candidates WHERE source IS NOT NULL",
    "candidate_blocks": "WITH c AS (SELECT notice_id, row_number() OVER (PARTITION BY notice_id ORDER BY candidate_id) AS n, coalesce(iso, '') AS iso, coalesce(source, '') AS source, coalesce(governing, '') AS governing FROM ltb_candidates) SELECT notice_id, string_agg(n || '. ' || iso || ' | ' || source || ' | ' || governing, chr(10) ORDER BY n) AS block FROM c GROUP BY 1",
    "title_types": f"WITH t AS (SELECT notice_id, unnest(range(len(l))) AS seq, lower(coalesce(unnest(l), '')) AS s FROM (SELECT notice_id, list_concat(coalesce(categories, []), [summary]) AS l FROM notice_headers)), {_SIGNALS} SELECT notice_id, arg_min(struct_pack(t := kind), seq).t AS doc_type, CASE WHEN arg_min(signal, seq) = 'ambiguous' THEN 'title-ambiguous' ELSE 'title' END AS source FROM g GROUP BY 1",
    "leaf_candidates": f"""WITH t AS (SELECT notice_id, 0 AS seq, lower(coalesce(doc_type, '')) AS s FROM notice_headers UNION ALL SELECT notice_id, 1, lower(coalesce(summary, '')) FROM notice_headers), {_SIGNALS},
      l AS (SELECT notice_id, seq, unnest(CASE WHEN signal = 'ambiguous' THEN ['pcn', 'pdn'] ELSE [lower(kind)] END) AS leaf, CASE WHEN signal = 'ambiguous' THEN 0.3 WHEN signal = 'code' THEN CASE WHEN seq = 0 THEN 0.9 ELSE 0.8 END WHEN seq = 0 THEN 0.6 ELSE 0.5 END::DOUBLE AS score FROM g),
      b AS (SELECT notice_id, leaf, score, seq FROM l QUALIFY row_number() OVER (PARTITION BY notice_id, leaf ORDER BY score DESC, seq) = 1) SELECT notice_id, row_number() OVER (PARTITION BY notice_id ORDER BY score DESC, seq, leaf) AS rank, leaf, score FROM b QUALIFY rank <= 3""",
    "packed_steps": """WITH RECURSIVE e AS (SELECT procedure_id, length(instruction_text) AS n, row_number() OVER (PARTITION BY procedure_id ORDER BY step_key) AS rn FROM mfg_steps WHERE coalesce(instruction_text, '') <> ''),
      p AS (SELECT procedure_id, rn, 0 AS pack, n AS held FROM e WHERE rn = 1 UNION ALL SELECT e.procedure_id, e.rn, CASE WHEN held + n < 600 THEN pack ELSE pack + 1 END, CASE WHEN held + n < 600 THEN held + 2 + n ELSE n END FROM p JOIN e ON e.procedure_id IS NOT DISTINCT FROM p.procedure_id AND e.rn = p.rn + 1)
      SELECT procedure_id, pack, count(*) AS n FROM p GROUP BY ALL""",
    "cell_recognition": f"""WITH c AS (SELECT step_key, array_to_string(list_filter(internal_part_numbers, lambda x: x IS NOT NULL), ',' || chr(10)) AS cell FROM mfg_steps), p AS (SELECT *, list_filter(list_transform(regexp_split_to_array(cell, ',\\s*\\n|\\n|,\\s+'), lambda x: trim(x)), lambda x: x <> '') AS parts, [{_LABELS}][step_key % {len(R.LABELS)} + 1] AS label FROM c WHERE cell <> '')
      SELECT step_key, CASE WHEN len(parts) > 1 AND len(list_filter(parts, lambda x: NOT (regexp_full_match(x, '[^\\sa-z]{{2,48}}') AND regexp_matches(x, '[0-9]')))) = 0 THEN len(parts) ELSE 1 END AS fragments, step_key % 4 <> 0 AS echo,
        trim(cell) <> '' AND len(regexp_split_to_array(trim(cell), '\\s+')) <= 6 AND regexp_matches(cell, '\\p{{L}}{{2}}') AND NOT regexp_matches(lower(cell), 'https?://|www\\.|@') AND NOT regexp_matches(cell, '[.!?]\\s+\\p{{Lu}}') AS name FROM p""",
    "deck_outlines": """WITH t AS (SELECT package_id, page_start AS page, min(level) AS level FROM base_sections WHERE page_start IS NOT NULL GROUP BY ALL), d AS (SELECT package_id, page, page || CASE WHEN level > 1 THEN '.1' ELSE '' END || CASE WHEN level > 2 THEN '.2' ELSE '' END AS number, 'Title' AS title, CASE WHEN level > 2 THEN 3 WHEN level > 1 THEN 2 ELSE 1 END AS depth FROM t)
      SELECT *, (SELECT min(b.page) FROM d b WHERE b.package_id = d.package_id AND b.page > d.page AND b.depth <= d.depth) - 1 AS end_page FROM d""",
    "reused_names": "WITH c AS (SELECT id, name, count(*) AS n FROM concept_records WHERE name IS NOT NULL GROUP BY ALL) SELECT id, name, n FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, name) = 1",
    "reading_gate": "WITH v AS (SELECT 'identity_present' AS rule, mfr IS NOT NULL AND doc_id IS NOT NULL AS ok FROM written_headers UNION ALL SELECT 'date_present', coalesce(trim(pub_date), '') <> '' FROM written_headers UNION ALL SELECT 'zone_known', site_tz IS NOT NULL FROM written_headers) SELECT rule, count(*) FILTER (NOT ok) AS failures, count(*) AS checked, rule = 'identity_present' AND count(*) FILTER (NOT ok) > 0 AS blocks FROM v GROUP BY 1",
    "slide_backfill": f"WITH {_SECS}, m AS (SELECT DISTINCT s.course_id, section, slide FROM slide_concepts s JOIN sec ON s.course_id = sec.course_id AND slide >= start AND (stop = 0 OR slide <= stop)) SELECT count(*) AS wanted, count(*) FILTER (slide % 2 <> 0) AS added, count(*) FILTER (slide % 2 = 0) AS had, true AS adds_up FROM m",
    "synced_store": "SELECT 'in' AS p, count(*) AS n FROM concept_records WHERE domain IS NOT NULL UNION ALL SELECT 'label', count(*) FROM concept_records WHERE name IS NOT NULL AND record_id % 3 <> 0",
    "affected_headings": f"SELECT doc_id, {_affected('text')} AS affected, {_affected("concat_ws(' ', title || ' affected', text)")} AS titled, nullif(regexp_extract(text, '{R.NOTICE_NUMBER}', 1), '') AS number FROM documents",
    "escaped_names": f"SELECT record_id, {_IRI} AS iri, replace(replace(replace(replace(replace(name, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') AS literal FROM concept_records",
    "work_package_kinds": f"""WITH k AS (SELECT unnest([{_TAGS}]) AS tag, unnest([{_KINDS}]) AS kind), t AS (SELECT p_size, [{_TAGS}, 'nosuchwp'][p_partkey % {len(K.WP_KINDS) + 1} + 1] AS tag FROM part), u AS (SELECT CASE WHEN p_size % 5 <> 0 AND p_size % 7 = 0 THEN upper(tag) ELSE tag END AS tag FROM t)
      SELECT kind, CASE WHEN kind = 'DataModule' THEN u.tag END AS fallthrough, kind IS NULL AS refused, count(*) AS n FROM u LEFT JOIN k ON k.tag = u.tag GROUP BY ALL""",
    "provenance_stamps": "SELECT doc_id, coalesce(source, '') AS source, '' AS kind, coalesce(package, '') AS domain, '' AS ingest_id, '' AS parser, '' AS model, '' AS policy, coalesce(CAST(page_count AS VARCHAR), '') AS revision FROM documents",
}
