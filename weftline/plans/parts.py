"""Part rows, grids, grounding and scoring over the manufacturing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import parts as P
from ..session import table


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "mfg_steps")
    return s.select("procedure_id", "step_key", F.posexplode("internal_part_numbers").alias("pos", "mpn"))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids built from procedures: a header row over the steps' first part, verb, second part and first tool."""
    s = table(spark, sf_dir, "mfg_steps")
    g = s.select("procedure_id", "step_key", F.array(F.get("internal_part_numbers", F.lit(0)), F.col("action_verb"), F.get("internal_part_numbers", F.lit(1)), F.get("internal_part_numbers", F.lit(2))).alias("cells"))
    body = g.withColumn("row", F.expr("row_number() OVER (PARTITION BY procedure_id ORDER BY step_key)")).select("procedure_id", "row", "cells")
    head = s.select("procedure_id").distinct().select("procedure_id", F.lit(0).alias("row"), F.array(F.lit("Affected Part"), F.lit("Action"), F.lit("Replacement"), F.lit("Customer Part Number")).alias("cells"))
    return head.unionByName(body).select(F.col("procedure_id").alias("grid_id"), "row", F.posexplode("cells").alias("col", "cell"))


def part_dedupe_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each part number of a procedure."""
    kept, _ = P.deduplicated(_parts(spark, sf_dir), "procedure_id", "mpn", ["step_key", "pos"])
    return kept.select("procedure_id", "step_key", "pos", F.trim("mpn").alias("mpn"))


def part_dedupe_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept, duplicate and unnumbered rows of each procedure."""
    return P.deduplicated(_parts(spark, sf_dir), "procedure_id", "mpn", ["step_key", "pos"])[1]


def grid_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header row and paired columns of every grid."""
    c = _cells(spark, sf_dir)
    return P.column_pairs(c, P.header_rows(c))


HEADER_WORDS = ("Affected Part", "Replacement", "Customer Part Number", "Generic family", "Date", "Device", "")


def order_grid_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header row and paired columns of grids whose rows are the line items of an order: any of their first six may be the header, with several affected columns, aliases, blanks and rows of different width."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    words = F.array(*[F.lit(w) for w in HEADER_WORDS])
    cells = F.transform(F.sequence(F.lit(0), F.lit(3) + F.col("p") % 3), lambda j: F.element_at(words, ((F.col("p") + j * F.col("s")) % len(HEADER_WORDS) + 1).cast("int")))
    c = li.select(F.col("l_orderkey").alias("grid_id"), (F.col("l_linenumber") - 1).alias("row"), F.posexplode(cells).alias("col", "cell"))
    return P.column_pairs(c, P.header_rows(c))


def grid_part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part rows of every grid."""
    return P.grid_parts(_cells(spark, sf_dir))


def merged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid parts merged: quotes off, first per procedure, replacement cleaned, the procedure's last load as inherited date."""
    kept, _ = P.deduplicated(P.grid_parts(_cells(spark, sf_dir)), "grid_id", "affected", ["row"])
    return kept.select("grid_id", "row", F.trim("affected").alias("affected"), P.clean_replacement("replacement").alias("replacement"), "customer")


def snippet_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where in its procedure's instructions each part number is written; value-added steps are preferred."""
    s = table(spark, sf_dir, "mfg_steps").select("procedure_id", F.col("step_key").alias("seq"), F.col("instruction_text").alias("text"), F.coalesce("is_value_added", F.lit(False)).alias("preferred"))
    return P.grounded(_parts(spark, sf_dir).filter("mpn IS NOT NULL").select("procedure_id", F.col("mpn").alias("needle")), s, "procedure_id")


def _truth(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n = table(spark, sf_dir, "notice_headers").select("notice_id", "mfr", "pub_date", "doc_id", F.coalesce("revision", F.lit("<empty>")).alias("revision"))
    w = table(spark, sf_dir, "written_headers").filter("fire = 1")
    first = w.groupBy("notice_id").agg(F.min_by(F.struct("mfr", "pub_date", "doc_id", "revision"), "header_id").alias("r")).select("notice_id", "r.*")
    return n, first


def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of the first fire against the notices, by column and in all."""
    return P.row_scores(*_truth(spark, sf_dir), "notice_id", ["mfr", "pub_date", "doc_id", "revision"])


def set_identity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part numbers named in instructions against those listed, per procedure."""
    s = table(spark, sf_dir, "mfg_steps")
    said = s.select("procedure_id", F.explode(F.regexp_extract_all("instruction_text", F.lit(r"[A-Z]{2,3}-\d{4}-\d{3}"), 0)).alias("mpn"))
    return P.set_scores(_parts(spark, sf_dir), said, "procedure_id", "mpn")


def header_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the first fire's maker compares with the notice's: verdicts counted."""
    t, g = _truth(spark, sf_dir)
    j = t.select("notice_id", F.col("mfr").alias("want")).join(g.select("notice_id", F.col("mfr").alias("have")), "notice_id", "left")
    v = P.header_verdict(F.col("want"), F.col("have"), F.array(F.upper("want")), lambda c: X.without_suffix(X.component_key(c)))
    return j.groupBy(v.alias("verdict")).agg(F.count("*").alias("n"))


def run_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fire: records, and how many carry each flag."""
    w = table(spark, sf_dir, "written_headers")
    return flags(w)


def flags(w: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")).isin("", "-", "n/a")
    return w.groupBy("fire").agg(F.count("*").alias("records"), F.countDistinct("notice_id").alias("notices"), F.count_if(blank("mfr")).alias("no_mfr"), F.count_if(blank("pub_date")).alias("no_date"), F.count_if(blank("revision")).alias("no_revision"), F.count_if(blank("doc_level_ltb_date")).alias("no_ltb"))


def worst_across_fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per flag the fire with the highest count (the first on ties), its denominator, and whether all fires agree."""
    r = flags(table(spark, sf_dir, "written_headers"))
    long = r.select("fire", "records", F.explode(F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).alias("n")) for c in ("no_mfr", "no_date", "no_revision", "no_ltb")])).alias("x")).select("fire", "records", "x.*")
    g = long.groupBy("flag").agg(F.max_by(F.struct("fire", "n", "records"), F.struct("n", -F.col("fire"))).alias("w"), (F.countDistinct("n", "records") == 1).alias("agree"))
    return g.select("flag", F.col("w.fire").alias("fire"), F.col("w.n").alias("n"), F.col("w.records").alias("records"), "agree")


def readiness_posture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared sources against the documents in store: INGESTED, ABSENT, or UNATTRIBUTED where undeclared."""
    want = table(spark, sf_dir, "source_targets").select("source", "max_repeats")
    have = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("docs"))
    j = want.join(have, "source", "full_outer")
    return j.select("source", F.when(F.col("max_repeats").isNull(), "UNATTRIBUTED").when(F.col("docs").isNull(), "ABSENT").otherwise("INGESTED").alias("posture"), F.coalesce("docs", F.lit(0)).alias("docs"))


def text_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct tokens of each instruction, and whether one is part-shaped."""
    s = table(spark, sf_dir, "mfg_steps")
    toks = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all("instruction_text", F.lit(r"[A-Za-z0-9][A-Za-z0-9./+_-]*"), 0), lambda t: F.regexp_replace(t, r"[./_-]+$", ""))))
    return s.select("step_key", F.array_join(toks, " ").alias("tokens"), F.exists(toks, lambda t: t.rlike(r"^[A-Z]{2,3}-\d{4}-\d{3}$")).alias("names_part"))


QUERIES = {f.__name__: f for f in (part_dedupe_first_wins, part_dedupe_tallies, grid_columns, order_grid_columns, grid_part_rows, merged_parts, snippet_grounding, scorecard, set_identity_score, header_verdicts, run_rates, worst_across_fires, readiness_posture, text_tokens)}

_P = "p AS (SELECT procedure_id, step_key, unnest(range(len(internal_part_numbers))) AS pos, unnest(internal_part_numbers) AS mpn FROM mfg_steps)"
_R = "r AS (SELECT *, row_number() OVER (PARTITION BY procedure_id, trim(mpn) ORDER BY step_key, pos) AS rn FROM p WHERE trim(coalesce(mpn, '')) <> '')"
_MPN = "(trim({0}) <> '' AND length(trim({0})) <= 48 AND length(trim({0})) - length(regexp_replace(trim({0}), '\\s', '', 'g')) <= 2 AND regexp_matches({0}, '\\d') AND NOT ends_with(trim({0}), ':'))"
_BODY = "b AS (SELECT procedure_id AS grid_id, row_number() OVER (PARTITION BY procedure_id ORDER BY step_key) AS row, trim(internal_part_numbers[1]) AS affected, CASE WHEN " + _MPN.format("internal_part_numbers[2]") + " THEN trim(internal_part_numbers[2]) END AS replacement, CASE WHEN " + _MPN.format("internal_part_numbers[3]") + " THEN trim(internal_part_numbers[3]) END AS customer FROM mfg_steps)"
_PARTS = f"WITH {_BODY} SELECT grid_id, row, affected, replacement, customer FROM b WHERE {_MPN.format('affected')}"
_N = "trim(regexp_replace(upper(coalesce({0}, '')), '\\s+', ' ', 'g'))"
_G = "g AS (SELECT notice_id, mfr, pub_date, doc_id, revision FROM written_headers WHERE fire = 1 QUALIFY row_number() OVER (PARTITION BY notice_id ORDER BY header_id) = 1), t AS (SELECT notice_id, mfr, pub_date, doc_id, coalesce(revision, '<empty>') AS revision FROM notice_headers)"
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", t.{c} AS want, CASE WHEN g.notice_id IS NULL THEN NULL ELSE coalesce(g.{c}, '') END AS have FROM t LEFT JOIN g USING (notice_id)" for c in ("mfr", "pub_date", "doc_id", "revision"))
_SUF = "regexp_replace(nullif(trim(regexp_replace(regexp_replace(lower({0}), '[.,'']', '', 'g'), '\\s+', ' ', 'g')), ''), ' (" + "|".join(X.CORPORATE) + ")$', '')"
_FLAGS = "f AS (SELECT fire, count(*) AS records, count(DISTINCT notice_id) AS notices, " + ", ".join(f"count(*) FILTER (coalesce(trim({c}), '') IN ('', '-', 'n/a')) AS {n}" for c, n in (("mfr", "no_mfr"), ("pub_date", "no_date"), ("revision", "no_revision"), ("doc_level_ltb_date", "no_ltb"))) + " FROM written_headers GROUP BY 1)"
SQL = {
    "part_dedupe_first_wins": f"WITH {_P}, {_R} SELECT procedure_id, step_key, pos, trim(mpn) AS mpn FROM r WHERE rn = 1",
    "part_dedupe_tallies": f"WITH {_P}, {_R} SELECT procedure_id, count(DISTINCT nullif(trim(coalesce(mpn, '')), '')) AS kept, count(nullif(trim(coalesce(mpn, '')), '')) - count(DISTINCT nullif(trim(coalesce(mpn, '')), '')) AS duplicate, count(*) FILTER (trim(coalesce(mpn, '')) = '') AS no_mpn FROM p GROUP BY 1",
    "grid_columns": "SELECT DISTINCT procedure_id AS grid_id, 0 AS header_row, 0 AS affected, 2 AS replacement, 3 AS customer FROM mfg_steps",
    "order_grid_columns": f"""WITH l AS (SELECT l_orderkey AS grid_id, l_linenumber - 1 AS row, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY ALL), e AS (SELECT grid_id, row, p, s, unnest(range(0, 4 + p % 3)) AS col FROM l),
      c AS (SELECT grid_id, row, col, (p + col * s) % 7 AS k FROM e), r AS (SELECT *, CASE k WHEN 0 THEN 'a' WHEN 1 THEN 'r' WHEN 2 THEN 'c' WHEN 3 THEN 'x' WHEN 5 THEN 'a' END AS role FROM c),
      g AS (SELECT grid_id, row, count(*) FILTER (k <> 6) AS filled, count(*) FILTER (role IN ('a', 'r')) AS score FROM r WHERE row < 6 GROUP BY ALL), h AS (SELECT grid_id, row AS header_row FROM g WHERE filled >= 2 AND score > 0 QUALIFY row_number() OVER (PARTITION BY grid_id ORDER BY score DESC, row) = 1),
      t AS (SELECT r.grid_id, header_row, col, role FROM r JOIN h ON r.grid_id = h.grid_id AND r.row = h.header_row), n AS (SELECT *, (SELECT min(b.col) FROM t b WHERE b.grid_id = t.grid_id AND b.col > t.col AND b.role = 'a') AS stop FROM t WHERE role = 'a')
      SELECT grid_id, header_row, col AS affected, (SELECT min(b.col) FROM t b WHERE b.grid_id = n.grid_id AND b.col > n.col AND b.role = 'r' AND b.col < coalesce(n.stop, 99)) AS replacement, (SELECT min(b.col) FROM t b WHERE b.grid_id = n.grid_id AND b.col > n.col AND b.role = 'c' AND b.col < coalesce(n.stop, 99)) AS customer FROM n""",
    "grid_part_rows": _PARTS,
    "merged_parts": f"SELECT grid_id, row, affected, CASE WHEN NOT contains(replacement, ',') THEN replacement END AS replacement, customer FROM ({_PARTS}) QUALIFY row_number() OVER (PARTITION BY grid_id, affected ORDER BY row) = 1",
    "snippet_grounding": f"""WITH {_P}, n AS (SELECT DISTINCT procedure_id, mpn AS needle FROM p WHERE mpn IS NOT NULL), h AS (SELECT n.procedure_id, needle, step_key, is_value_added FROM n LEFT JOIN mfg_steps s ON s.procedure_id = n.procedure_id AND {_N.format('needle')} <> '' AND contains({_N.format('instruction_text')}, {_N.format('needle')})),
      g AS (SELECT procedure_id, needle, count(step_key) AS candidate_count, count(*) FILTER (step_key IS NOT NULL AND is_value_added) AS liked, min(step_key) AS a, min(CASE WHEN is_value_added THEN step_key END) AS l FROM h GROUP BY ALL)
      SELECT procedure_id, needle, CASE WHEN candidate_count = 0 THEN 'not_found' WHEN candidate_count = 1 THEN 'unique' WHEN liked > 0 THEN 'region_preferred' ELSE 'ambiguous' END AS status, CASE WHEN candidate_count = 0 THEN 0.0 WHEN candidate_count = 1 THEN 1.0 WHEN liked > 0 THEN 0.7 ELSE 0.4 END::DOUBLE AS confidence, candidate_count, CASE WHEN candidate_count > 1 AND liked > 0 THEN l ELSE a END AS first_seq FROM g""",
    "scorecard": f"""WITH {_G}, l AS ({_LONG}), b AS (SELECT "column", CASE WHEN have IS NULL THEN 'n' WHEN want = '<empty>' THEN CASE WHEN have = '' THEN 'm' ELSE 'e' END WHEN have = '' THEN 'v' WHEN have = want THEN 'm' ELSE 'x' END AS k FROM l WHERE want IS NOT NULL AND want <> '')
      SELECT coalesce("column", '(all)') AS "column", count(*) FILTER (k = 'm') AS "match", count(*) FILTER (k = 'x') AS mismatch, count(*) FILTER (k = 'e') AS expected_empty_got_value, count(*) FILTER (k = 'v') AS expected_value_got_empty, count(*) FILTER (k = 'n') AS not_exported, count(*) AS asserted, count(*) FILTER (k = 'm') / count(*) AS rate FROM b GROUP BY ROLLUP ("column")""",
    "set_identity_score": f"""WITH {_P}, t AS (SELECT DISTINCT procedure_id, mpn FROM p WHERE mpn IS NOT NULL), s AS (SELECT DISTINCT procedure_id, unnest(regexp_extract_all(instruction_text, '[A-Z]{{2,3}}-\\d{{4}}-\\d{{3}}')) AS mpn FROM mfg_steps), j AS (SELECT coalesce(t.procedure_id, s.procedure_id) AS procedure_id, t.mpn AS tm, s.mpn AS sm FROM t FULL JOIN s ON t.procedure_id = s.procedure_id AND t.mpn = s.mpn)
      SELECT procedure_id, count(*) FILTER (tm = sm) AS exact, count(*) FILTER (sm IS NULL) AS missing, count(*) FILTER (tm IS NULL) AS spurious, count(*) FILTER (sm IS NOT NULL AND regexp_matches(sm, '[\\n\\r\\t,]|  ')) AS malformed FROM j GROUP BY 1""",
    "header_verdicts": f"""WITH {_G} SELECT CASE WHEN t.mfr IS NULL THEN 'pending' WHEN coalesce(trim(g.mfr), '') = '' THEN 'absent' WHEN g.mfr = t.mfr THEN 'exact' WHEN g.mfr = upper(t.mfr) THEN 'alias' WHEN {_SUF.format('g.mfr')} = {_SUF.format('t.mfr')} THEN 'misformatted' ELSE 'wrong' END AS verdict, count(*) AS n FROM t LEFT JOIN g USING (notice_id) GROUP BY 1""",
    "run_rates": f"WITH {_FLAGS} SELECT * FROM f",
    "worst_across_fires": f"""WITH {_FLAGS}, l AS ({' UNION ALL '.join(f"SELECT fire, records, '{c}' AS flag, {c} AS n FROM f" for c in ('no_mfr', 'no_date', 'no_revision', 'no_ltb'))}) SELECT flag, arg_max(fire, n * 100 - fire) AS fire, max(n) AS n, arg_max(records, n * 100 - fire) AS records, count(DISTINCT (n, records)) = 1 AS agree FROM l GROUP BY 1""",
    "readiness_posture": "SELECT source, CASE WHEN max_repeats IS NULL THEN 'UNATTRIBUTED' WHEN docs IS NULL THEN 'ABSENT' ELSE 'INGESTED' END AS posture, coalesce(docs, 0) AS docs FROM (SELECT source, max_repeats FROM source_targets) FULL JOIN (SELECT source, count(*) AS docs FROM documents GROUP BY 1) USING (source)",
    "text_tokens": "WITH t AS (SELECT step_key, list_sort(list_distinct(list_transform(regexp_extract_all(instruction_text, '[A-Za-z0-9][A-Za-z0-9./+_-]*'), lambda x: regexp_replace(x, '[./_-]+$', '')))) AS k FROM mfg_steps) SELECT step_key, array_to_string(k, ' ') AS tokens, len(list_filter(k, lambda x: regexp_matches(x, '^[A-Z]{2,3}-\\d{4}-\\d{3}$'))) > 0 AS names_part FROM t",
}
