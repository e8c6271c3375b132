"""Concept alignment and course roll-ups over slides and concept records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import recognise as R
from ..functions import text as X
from ..operators import concepts as C
from ..session import materialize, table


def _slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "slide_concepts")


def concept_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every aligned key with its best name and how widely it is taught."""
    return C.concept_records(_slides(spark, sf_dir)).select("key", "name", "teach_count", "n_courses", F.size("terms").alias("n_terms"))


def concept_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of mutually related concepts with their canonical names."""
    return C.aligned(_slides(spark, sf_dir))


def mutual_concept_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts that list each other."""
    return C.mutual_links(_slides(spark, sf_dir))


def blocked_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexical candidates between concepts, by blocking."""
    return C.lexical_candidates(_slides(spark, sf_dir))


def proposal_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best proposals of each course among concepts both of whose slides it has."""
    s = _slides(spark, sf_dir)
    taught = s.select("course_id", "slide", X.align_key("name").alias("key")).filter("key <> ''").groupBy("course_id", "key").agg(F.collect_set("slide").alias("slides"))
    j = C.shared_slides(C.lexical_candidates(s, C.LEAST_CONFIDENCE), materialize(taught, "taught"))
    return C.top_proposals(j, "course_id", 20).select("course_id", "a", "b", "signal", "shared", "rank")


def slide_section_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean salience and frequency of every concept in every section."""
    s = _slides(spark, sf_dir)
    return C.coverage(s, C.course_sections(s)).withColumn("score", F.round("score", 6))


def section_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten concepts that lead each section."""
    s = _slides(spark, sf_dir)
    return C.summaries(C.coverage(s, C.course_sections(s)).withColumn("score", F.round("score", 6)))


def deepest_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deepest section of every slide."""
    s = _slides(spark, sf_dir)
    return C.deepest_section(s, C.course_sections(s).filter("depth > 0"))


def section_call_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of slides by section, split for calls of eight."""
    return C.call_runs(deepest_section(spark, sf_dir))


def packed_section_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs packed into calls of at most eight slides."""
    return C.packed_calls(C.call_runs(deepest_section(spark, sf_dir)))


def concept_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept ids from domain and plain normalised names: the ASCII part of record_concept_ids, which SQL can check."""
    c = table(spark, sf_dir, "concept_records").filter(F.coalesce("name", "name_normalized").rlike(r"^[\x20-\x7e]*$"))
    norm = X.squeeze(F.lower(F.coalesce("name", "name_normalized")))
    return c.select("record_id", norm.alias("norm"), F.concat(F.lit("concept_"), F.left(F.sha2(F.concat_ws("␟", F.upper("domain"), norm), 256), F.lit(16))).alias("concept_id"))


def record_concept_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The concept id and the folded name of every record; a record without any name has the empty name."""
    c, name = table(spark, sf_dir, "concept_records"), F.coalesce("name", "name_normalized", F.lit(""))
    return c.select("record_id", R.concept_name(name).alias("norm"), R.concept_id(F.coalesce("domain", F.lit("")), name).alias("concept_id"))


def duplicate_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of concept records with one id, the one with most slides survives."""
    c = table(spark, sf_dir, "concept_records").select("id", "record_id", F.size(F.coalesce("slides", F.array())).alias("degree"))
    return C.survivors(c, "id", "degree", "record_id")


def teach_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct slides and courses that each record names, and those it has in disorder."""
    c = table(spark, sf_dir, "concept_records")
    return c.select("record_id", F.size(F.array_distinct(F.coalesce("slides", F.array()))).alias("n_slides"), F.size(F.array_distinct(F.coalesce("courses", F.array()))).alias("n_courses"), F.array_join(F.array_sort(F.array_distinct(F.coalesce("related_terms", F.array()))), "|").alias("terms"))


QUERIES = {f.__name__: f for f in (concept_inventory, concept_alignment, mutual_concept_links, blocked_candidates, proposal_topn, slide_section_rollup, section_summaries, deepest_section, section_call_runs, packed_section_calls, concept_ids, record_concept_ids, duplicate_survivors, teach_counts)}

_KEY = "trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{Nd}}]+', ' ', 'g'))"
_E = f"e AS (SELECT DISTINCT * FROM (SELECT {_KEY.format('name')} AS key, {_KEY.format('t')} AS t FROM (SELECT name, unnest(related_terms) AS t FROM slide_concepts)) WHERE key <> '' AND t <> '' AND key <> t)"
_REC = f"""r AS (SELECT *, {_KEY.format('name')} AS key FROM slide_concepts WHERE {_KEY.format('name')} <> ''), nm AS (SELECT key, name, count(*) AS n FROM r GROUP BY ALL),
  best AS (SELECT key, name FROM nm QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, length(name), name) = 1), teach AS (SELECT key, count(DISTINCT (course_id, slide)) AS teach_count, count(DISTINCT course_id) AS n_courses FROM r GROUP BY 1), {_E},
  rec AS (SELECT key, name, teach_count, n_courses, coalesce((SELECT count(*) FROM e WHERE e.key = best.key), 0) AS n_terms FROM best JOIN teach USING (key))"""
_M = "m AS (SELECT x.key AS a, x.t AS b FROM e x JOIN e y ON x.key = y.t AND x.t = y.key WHERE x.key < x.t)"
_CAND = f"""tk AS (SELECT key, list_distinct(string_split(key, ' ')) AS toks FROM rec), pl AS (SELECT key, regexp_replace(CASE WHEN regexp_matches(regexp_replace(key, 'ies$', 'y'), '[^s]s$') THEN left(regexp_replace(key, 'ies$', 'y'), length(regexp_replace(key, 'ies$', 'y')) - 1) ELSE regexp_replace(key, 'ies$', 'y') END, 'x^', '') AS p FROM rec),
  c AS (SELECT least(key, t) AS a, greatest(key, t) AS b, 0 AS o FROM e WHERE t IN (SELECT key FROM rec) UNION ALL SELECT x.key, y.key, 1 FROM pl x JOIN pl y ON x.p = y.p AND x.key < y.key
    UNION ALL SELECT least(x.key, y.key), greatest(x.key, y.key), 2 FROM rec x JOIN rec y ON x.key NOT LIKE '% %' AND length(x.key) BETWEEN 2 AND 6 AND y.key LIKE '% %' AND x.key = array_to_string(list_transform(string_split(y.key, ' '), lambda w: left(w, 1)), '')
    UNION ALL SELECT x.key, y.key, 3 FROM tk x JOIN tk y ON x.key < y.key AND len(list_filter(list_intersect(x.toks, y.toks), lambda w: length(w) >= 4)) > 0 AND len(list_intersect(x.toks, y.toks)) * 2 >= len(list_distinct(list_concat(x.toks, y.toks)))),
  cand AS (SELECT a, b, CASE min(o) WHEN 0 THEN 'term' WHEN 1 THEN 'plural' WHEN 2 THEN 'acronym' ELSE 'overlap' END AS signal, CASE min(o) WHEN 0 THEN 0.7 WHEN 1 THEN 0.8 WHEN 2 THEN 0.6 ELSE 0.4 END::DOUBLE AS confidence FROM c GROUP BY ALL)"""
_SEC = "cs AS (SELECT DISTINCT course_id FROM slide_concepts), sec AS (SELECT course_id, 's' || k AS section, 1 AS depth, k * 20 + 1 AS start, (k + 1) * 20 AS stop FROM cs, range(6) t(k) UNION ALL SELECT course_id, 's' || (k // 2) || '_' || (k % 2), 2, k * 10 + 1, (k + 1) * 10 FROM cs, range(12) t(k) UNION ALL SELECT course_id, 'all', 0, 1, 0 FROM cs)"
_IN = "s.course_id = sec.course_id AND s.slide >= sec.start AND (sec.stop = 0 OR s.slide <= sec.stop)"
_COV = f"{_SEC}, cov AS (SELECT s.course_id, section, name AS concept, round(avg(salience), 6) AS score, count(*) AS frequency FROM slide_concepts s JOIN sec ON {_IN} GROUP BY ALL)"
_DEEP = f"{_SEC}, sl AS (SELECT DISTINCT course_id, slide FROM slide_concepts), deep AS (SELECT s.course_id, s.slide, arg_max(section, depth * 10000 + start) AS section FROM sl s LEFT JOIN (SELECT * FROM sec WHERE depth > 0) sec ON {_IN} GROUP BY ALL)"
SQL = {
    "concept_inventory": f"WITH {_REC} SELECT * FROM rec",
    "mutual_concept_links": f"WITH {_E}, {_M} SELECT * FROM m",
    "concept_alignment": f"""WITH RECURSIVE {_REC}, {_M}, lk AS (SELECT a, b FROM m UNION SELECT b, a FROM m), reach AS (SELECT key AS node, key AS seen FROM rec UNION SELECT reach.node, lk.b FROM reach JOIN lk ON lk.a = reach.seen),
      comp AS (SELECT node AS key, min(seen) AS component FROM reach GROUP BY 1), pick AS (SELECT component, name, key FROM rec JOIN comp USING (key) QUALIFY row_number() OVER (PARTITION BY component ORDER BY teach_count DESC, length(name), name) = 1)
      SELECT rec.key, pick.name AS canonical, 'canonical_' || left(sha256(pick.key), 16) AS canonical_id FROM rec JOIN comp USING (key) JOIN pick USING (component)""",
    "blocked_candidates": f"WITH {_REC}, {_CAND} SELECT * FROM cand",
    "proposal_topn": f"""WITH {_REC}, {_CAND}, per AS (SELECT course_id, {_KEY.format('name')} AS key, list_distinct(list(slide)) AS sl FROM slide_concepts GROUP BY ALL), j AS (SELECT x.course_id, a, b, signal, confidence, len(list_intersect(x.sl, y.sl)) AS shared FROM cand JOIN per x ON x.key = a JOIN per y ON y.key = b AND x.course_id = y.course_id WHERE confidence >= 0.7)
      SELECT course_id, a, b, signal, shared, row_number() OVER (PARTITION BY course_id ORDER BY shared DESC, confidence DESC, a, b) AS rank FROM j QUALIFY rank <= 20""",
    "slide_section_rollup": f"WITH {_COV} SELECT * FROM cov",
    "section_summaries": f"WITH {_COV}, k AS (SELECT *, row_number() OVER (PARTITION BY course_id, section ORDER BY score DESC NULLS LAST, concept) AS r FROM cov) SELECT course_id, section, string_agg(concept, '|' ORDER BY r) AS concepts FROM k WHERE r <= 10 GROUP BY ALL",
    "deepest_section": f"WITH {_DEEP} SELECT * FROM deep",
    "section_call_runs": f"""WITH {_DEEP}, ch AS (SELECT *, CASE WHEN section IS NOT DISTINCT FROM lag(section) OVER w AND lag(slide) OVER w IS NOT NULL THEN 0 ELSE 1 END AS changed FROM deep WINDOW w AS (PARTITION BY course_id ORDER BY slide)), rn AS (SELECT *, sum(changed) OVER (PARTITION BY course_id ORDER BY slide) AS run FROM ch),
      pl AS (SELECT *, row_number() OVER (PARTITION BY course_id, run ORDER BY slide) - 1 AS nth, count(*) OVER (PARTITION BY course_id, run) AS n0 FROM rn) SELECT course_id, run, floor(nth / ceil(n0 / ceil(n0 / 8)))::BIGINT AS piece, min(slide) AS first_slide, max(slide) AS last_slide, count(*) AS n FROM pl GROUP BY ALL""",
    "concept_ids": "SELECT record_id, norm, 'concept_' || left(sha256(upper(domain) || '␟' || norm), 16) AS concept_id FROM (SELECT record_id, domain, trim(regexp_replace(lower(coalesce(name, name_normalized)), '\\s+', ' ', 'g')) AS norm FROM concept_records WHERE regexp_full_match(coalesce(name, name_normalized), '[\\x20-\\x7e]*'))",
    "duplicate_survivors": "SELECT id, arg_min(record_id, (-len(coalesce(slides, [])), record_id)) AS survivor, count(*) AS members FROM concept_records GROUP BY 1 HAVING count(*) > 1",
    "teach_counts": "SELECT record_id, len(list_distinct(coalesce(slides, []))) AS n_slides, len(list_distinct(coalesce(courses, []))) AS n_courses, array_to_string(list_sort(list_distinct(coalesce(related_terms, []))), '|') AS terms FROM concept_records",
}
SQL["packed_section_calls"] = f"""WITH RECURSIVE runs AS ({SQL["section_call_runs"]}), o AS (SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY first_slide) AS rn FROM runs),
  p AS (SELECT course_id, rn, 0::BIGINT AS call, first_slide, last_slide, n, n AS held FROM o WHERE rn = 1
    UNION ALL SELECT o.course_id, o.rn, CASE WHEN held + o.n <= 8 THEN call ELSE call + 1 END, o.first_slide, o.last_slide, o.n, CASE WHEN held + o.n <= 8 THEN held + o.n ELSE o.n END FROM p JOIN o ON o.course_id IS NOT DISTINCT FROM p.course_id AND o.rn = p.rn + 1)
  SELECT course_id, call, min(first_slide) AS first_slide, arg_max(last_slide, rn) AS last_slide, sum(n)::BIGINT AS n FROM p GROUP BY ALL"""
