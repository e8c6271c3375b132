"""Header trust, nearest dates and as-of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import trust as T
from ..session import table


def dated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates near last-time-buy phrases in the snippets."""
    return T.scanned_dates(table(spark, sf_dir, "ltb_candidates"), "candidate_id", "snippet")


def reading_agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the notice's maker agrees with each fire's reading."""
    n = table(spark, sf_dir, "notice_headers").select("notice_id", T.reading_key("mfr").alias("a"))
    w = table(spark, sf_dir, "written_headers").select("notice_id", "fire", T.reading_key("mfr").alias("b"))
    return w.join(n, "notice_id").groupBy("fire").agg(F.count_if(T.readings_agree("a", "b")).alias("agree"), F.count("*").alias("n"))


def recovered_makers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maker most readings of a notice print."""
    return T.recovered(table(spark, sf_dir, "written_headers"), "notice_id", "mfr")


def header_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which source decides a notice's maker; every third text layer counts as degraded."""
    w = table(spark, sf_dir, "written_headers")
    pick = lambda fire, name: w.filter(F.col("fire") == fire).groupBy("notice_id").agg(F.min_by("mfr", "header_id").alias(name))
    layer = pick(1, "printed").join(pick(2, "witness"), "notice_id", "full_outer").withColumn("degraded", F.col("notice_id") % 3 == 0)
    return T.header_branches(table(spark, sf_dir, "notice_headers").select("notice_id", F.col("mfr").alias("model")), layer, "notice_id")


def asof_previous_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every purchase the value of the user's last click within a day."""
    e = table(spark, sf_dir, "events")
    first, second = "click", "purchase"
    return T.as_of(e.filter(F.col("event_type") == second).select("event_id", "user_id", "ts"), e.filter(F.col("event_type") == first).select("user_id", "ts", "value"), "user_id", "ts", "value", "1 DAY")


def corroborated_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed part numbers against the tokens of their procedure's instructions."""
    s = table(spark, sf_dir, "mfg_steps")
    parts = s.select("procedure_id", F.explode("internal_part_numbers").alias("mpn")).filter("mpn IS NOT NULL")
    words = s.select("procedure_id", F.explode(F.regexp_extract_all("instruction_text", F.lit(r"[A-Za-z0-9][A-Za-z0-9/-]+"), 0)).alias("token"))
    return T.corroborated(parts, words, "procedure_id")


def witnessed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed part numbers against the whole folded text of their procedure's instructions."""
    s = table(spark, sf_dir, "mfg_steps")
    parts = s.select("procedure_id", F.explode("internal_part_numbers").alias("mpn")).filter("mpn IS NOT NULL")
    return T.witnessed(parts, s.select("procedure_id", F.col("instruction_text").alias("text")), "procedure_id")


def inherited_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps as grids of as many columns as they have tools; those with figures declare a header."""
    s = table(spark, sf_dir, "mfg_steps").select("procedure_id", F.col("step_key").alias("seq"), F.size(F.coalesce("tooling", F.array())).alias("width"), F.get("figure_references", F.lit(0)).alias("header"))
    return T.inherited_headers(s, "procedure_id")


def completed_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes and words laid out from line items: how many words each box cuts and where its edges go."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    boxes = li.filter("l_linenumber = 1").dropDuplicates(["l_orderkey"]).select(F.col("l_orderkey").alias("page"), F.lit(1).alias("box_id"), F.lit(10.0).alias("x1"), F.lit(0.0).alias("y1"), F.lit(40.0).alias("x2"), F.lit(50.0).alias("y2"))
    words = li.select(F.col("l_orderkey").alias("page"), F.col("l_quantity").alias("x1"), (F.col("l_linenumber") * 5.0).alias("y1"), (F.col("l_quantity") + 6).alias("x2"), (F.col("l_linenumber") * 5.0 + 4).alias("y2"))
    return T.completed_boxes(boxes, words, "page")


QUERIES = {f.__name__: f for f in (dated_phrases, reading_agreements, recovered_makers, header_branches, asof_previous_event, corroborated_parts, witnessed_parts, inherited_headers, completed_boxes)}
_F = "nullif(regexp_replace(trim(regexp_replace(lower({0}), '\\s+', ' ', 'g')), '^[^\\p{{L}}\\p{{Nd}}]+|[^\\p{{L}}\\p{{Nd}}]+$', '', 'g'), '')"
_SUB = "regexp_matches({long}, array_to_string(list_transform(string_split({short}, ''), lambda c: regexp_escape(c)), '.*'))"


def _agree(a: str, b: str) -> str:
    s, lg = f"(CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END)", f"(CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END)"
    return f"coalesce({a} = {b} OR (length({s}) >= 2 AND starts_with({lg}, {s} || ' ')) OR (length({a}) <> length({b}) AND length({s}) >= 4 AND {_SUB.format(long=lg, short=s)}), false)"


SQL = {
    "reading_agreements": f"WITH j AS (SELECT fire, {_F.format('n.mfr')} AS a, {_F.format('w.mfr')} AS b FROM written_headers w JOIN notice_headers n USING (notice_id)) SELECT fire, count(*) FILTER ({_agree('a', 'b')}) AS agree, count(*) AS n FROM j GROUP BY 1",
    "recovered_makers": f"WITH r AS (SELECT notice_id, mfr AS v, {_F.format('mfr')} AS k FROM written_headers), g AS (SELECT notice_id, k, count(*) AS votes, arg_max(v, (length(v), v)) AS v FROM r WHERE k IS NOT NULL GROUP BY ALL) SELECT notice_id, arg_max(v, (votes, length(k), k)) AS value, max(votes) AS votes, CASE WHEN count(*) = 1 THEN 1 WHEN max(votes) * 2 > sum(votes) THEN 2 ELSE 3 END AS tier FROM g GROUP BY 1",
    "header_branches": f"""WITH p AS (SELECT notice_id, arg_min(struct_pack(m := mfr), header_id).m AS printed FROM written_headers WHERE fire = 1 GROUP BY 1), q AS (SELECT notice_id, arg_min(struct_pack(m := mfr), header_id).m AS witness FROM written_headers WHERE fire = 2 GROUP BY 1),
      j AS (SELECT n.notice_id, mfr AS model, printed, witness, coalesce(n.notice_id % 3 = 0 AND (p.notice_id IS NOT NULL OR q.notice_id IS NOT NULL), false) AS degraded, {_F.format('mfr')} AS m, {_F.format('printed')} AS p, {_F.format('witness')} AS w FROM notice_headers n LEFT JOIN p USING (notice_id) LEFT JOIN q USING (notice_id)),
      b AS (SELECT *, CASE WHEN NOT degraded AND p IS NOT NULL THEN CASE WHEN {_agree('m', 'p')} THEN 'printed_agrees' ELSE 'printed_wins' END WHEN m IS NULL THEN CASE WHEN w IS NOT NULL THEN 'filled_from_witness' ELSE 'absent' END WHEN {_agree('m', 'w')} THEN 'witness_agrees' WHEN w IS NOT NULL THEN 'withdrawn_disagrees' ELSE 'withdrawn_uncorroborated' END AS branch FROM j)
      SELECT notice_id, CASE WHEN starts_with(branch, 'printed') THEN printed WHEN branch = 'filled_from_witness' THEN witness WHEN branch = 'witness_agrees' THEN model END AS value, branch FROM b""",
    "asof_previous_event": "WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), r AS (SELECT user_id, ts, value FROM events WHERE event_type = 'click') SELECT event_id, l.user_id, l.ts, CASE WHEN r.ts >= l.ts - INTERVAL 1 DAY THEN r.value END AS value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts",
    "corroborated_parts": """WITH p AS (SELECT DISTINCT procedure_id, mpn FROM (SELECT procedure_id, unnest(internal_part_numbers) AS mpn FROM mfg_steps) WHERE mpn IS NOT NULL), w AS (SELECT DISTINCT procedure_id, unnest(regexp_extract_all(instruction_text, '[A-Za-z0-9][A-Za-z0-9/-]+')) AS token FROM mfg_steps)
      SELECT procedure_id, mpn, CASE WHEN EXISTS (SELECT 1 FROM w WHERE w.procedure_id = p.procedure_id AND token = mpn) THEN 'kept' WHEN length(mpn) >= 4 AND EXISTS (SELECT 1 FROM w WHERE w.procedure_id = p.procedure_id AND left(token, 2) = left(mpn, 2) AND length(token) - length(mpn) BETWEEN 1 AND 3 AND """ + _SUB.format(long="token", short="mpn") + ") THEN 'suspect' ELSE 'unseen' END AS verdict FROM p",
    "inherited_headers": "WITH g AS (SELECT procedure_id, step_key AS seq, len(coalesce(tooling, [])) AS width, figure_references[1] AS header FROM mfg_steps), l AS (SELECT *, last_value(CASE WHEN header IS NOT NULL THEN header END IGNORE NULLS) OVER w AS lh, last_value(CASE WHEN header IS NOT NULL THEN width END IGNORE NULLS) OVER w AS lw FROM g WINDOW w AS (PARTITION BY procedure_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT procedure_id, seq, width, header, CASE WHEN header IS NULL AND lw = width THEN lh END AS inherited FROM l",
    "completed_boxes": """WITH b AS (SELECT DISTINCT l_orderkey AS page FROM lineitem WHERE l_linenumber = 1), j AS (SELECT b.page, l_quantity AS wx1, l_quantity + 6 AS wx2, l_linenumber * 5.0 AS wy1, l_linenumber * 5.0 + 4 AS wy2 FROM b LEFT JOIN lineitem l ON l.l_orderkey = b.page), k AS (SELECT *, wy2 > 1 AND wy1 < 49 AND wx1 < 9.5 AND wx2 > 10.5 AS l, wy2 > 1 AND wy1 < 49 AND wx1 < 39.5 AND wx2 > 40.5 AS r FROM j)
      SELECT page, 1 AS box_id, greatest(coalesce(min(wx1) FILTER (l), 10.0), -26.0)::DOUBLE AS x1, least(coalesce(max(wx2) FILTER (r), 40.0), 76.0)::DOUBLE AS x2, count(*) FILTER (l OR r) AS cut FROM k GROUP BY 1""",
}
