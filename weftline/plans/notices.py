"""Identity, recognition and agreement of notices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.identity import agreement, notice_keys, revision_relations, stability
from ..session import table

SUFFIX = "incorporated|inc|corporation|corp|company|co|limited|ltd|llc|gmbh|plc"
KEY_SQL = rf"""
  SELECT notice_id,
    nullif(regexp_replace(nullif(trim(regexp_replace(regexp_replace(lower(mfr), '[.,'']', '', 'g'), '\s+', ' ', 'g')), ''), ' ({SUFFIX})$', ''), '') AS mfr_key,
    nullif(trim(regexp_replace(regexp_replace(lower(doc_id), '[.,'']', '', 'g'), '\s+', ' ', 'g')), '') AS doc_key,
    nullif(regexp_replace(trim(regexp_replace(regexp_replace(lower(revision), '[,'']', '', 'g'), '\s+', ' ', 'g')), '^\.+|\.+$', '', 'g'), '') AS revision_key,
    sha256(concat_ws('|', coalesce(doc_id, ''), coalesce(mfr, ''), coalesce(revision, ''), coalesce(pub_date, ''), coalesce(summary, ''))) AS content_hash
  FROM notice_headers"""


def notice_identity_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised identity of every notice, its key, and the slug of its number."""
    n = notice_keys(table(spark, sf_dir, "notice_headers"))
    return n.select("notice_id", "mfr_key", "doc_key", "revision_key", "content_hash", X.slug("doc_id").alias("slug"))


def notice_revision_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every distinct revision read of a notice relates to the others; versions are named by their first reading."""
    w = table(spark, sf_dir, "written_headers").select(F.col("header_id").alias("notice_id"), "mfr", "doc_id", "revision", "pub_date", F.lit("").alias("summary"))
    return revision_relations(notice_keys(w))


def notice_doc_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type read from code and label, whether it is known, and the signal and score of the summary as a title."""
    n = table(spark, sf_dir, "notice_headers")
    label = F.concat_ws(" ", F.get("categories", F.lit(0)), "summary")
    sig = X.title_signal(label)
    return n.select(
        "notice_id", X.doc_type("doc_type").alias("type_of_code"), X.doc_type(label).alias("type_of_label"), X.doc_type_known(label).alias("known"),
        sig["doc_type"].alias("title_type"), sig["signal"].alias("signal"), X.leaf_score(sig["signal"], F.lit(True)).alias("score"),
    )


def _like(expr: str, terms) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{t}')" for t in terms) + ")"


_S = "lower(trim(concat_ws(' ', categories[1], summary)))"
_PCN, _PDN, _KP, _KD = rf"regexp_matches({_S}, '\bpcn\b')", rf"regexp_matches({_S}, '\bpdn\b')", _like(_S, X.PCN_TERMS), _like(_S, X.PDN_TERMS)
_BOTH = f"(({_PCN} AND {_PDN}) OR ({_PCN} AND {_KD}) OR ({_PDN} AND {_KP}) OR (NOT {_PCN} AND NOT {_PDN} AND {_KP} AND {_KD}))"


def forced_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed publication dates: the date the value forces, and whether the whole value is a date."""
    w = table(spark, sf_dir, "written_headers")
    return w.select("header_id", X.forced_date("pub_date").alias("forced"), X.is_date("pub_date").alias("entirely_a_date"))


_MON = "CASE lower({0}) " + " ".join(f"WHEN '{m}' THEN {i} WHEN '{m[:3]}' THEN {i}" for i, m in enumerate(X.MONTHS, 1)) + " END"
_ISO, _DMY, _MDY, _NUM = r"^(\d{4})-(\d{2})-(\d{2})(?:[T ]\S+)?$", r"^(\d{1,2}) ([A-Za-z]+) (\d{4})$", r"^([A-Za-z]+) (\d{1,2}), (\d{4})$", r"^(\d{1,2})/(\d{1,2})/(\d{4})$"


def _ymd(y: str, m: str, d: str) -> str:
    return f"strftime(try_strptime(lpad({y}, 4, '0') || '-' || lpad(CAST({m} AS VARCHAR), 2, '0') || '-' || lpad(CAST({d} AS VARCHAR), 2, '0'), '%Y-%m-%d'), '%Y-%m-%d')"


def _g(v: str, p: str, i: int) -> str:
    return f"regexp_extract({v}, '{p}', {i})"


def forced_sql(v: str) -> str:
    a, b = f"TRY_CAST({_g(v, _NUM, 1)} AS INT)", f"TRY_CAST({_g(v, _NUM, 2)} AS INT)"
    return f"""CASE WHEN contains({v}, chr(10)) THEN NULL
      WHEN regexp_matches({v}, '{_ISO}') THEN {_ymd(_g(v, _ISO, 1), _g(v, _ISO, 2), _g(v, _ISO, 3))}
      WHEN regexp_matches({v}, '{_DMY}') THEN {_ymd(_g(v, _DMY, 3), _MON.format(_g(v, _DMY, 2)), _g(v, _DMY, 1))}
      WHEN regexp_matches({v}, '{_MDY}') THEN {_ymd(_g(v, _MDY, 3), _MON.format(_g(v, _MDY, 1)), _g(v, _MDY, 2))}
      WHEN regexp_matches({v}, '{_NUM}') THEN CASE WHEN {a} = {b} THEN {_ymd(_g(v, _NUM, 3), a, b)} WHEN {a} > 12 AND {b} <= 12 THEN {_ymd(_g(v, _NUM, 3), b, a)} WHEN {b} > 12 AND {a} <= 12 THEN {_ymd(_g(v, _NUM, 3), a, b)} END END"""


def effective_ltb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last-time-buy date of each candidate: its own, else the notice's; inherited or not."""
    c, n = table(spark, sf_dir, "ltb_candidates"), table(spark, sf_dir, "notice_headers").select("notice_id", "doc_level_ltb_date")
    own, doc = F.nullif(F.trim("iso"), F.lit("")), F.nullif(F.trim("doc_level_ltb_date"), F.lit(""))
    j = c.select("candidate_id", "notice_id", "iso").join(n, "notice_id", "left")
    return j.select("candidate_id", F.coalesce(own, doc).alias("ltb"), (own.isNull() & doc.isNotNull()).alias("inherited"))


def written_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per notice and field: do the readings of the fires agree, disagree, or is one blank."""
    w = table(spark, sf_dir, "written_headers")
    return agreement(w.select("notice_id", "fire", "mfr", "doc_id", "revision"), ["mfr", "doc_id", "revision"])


def identity_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per notice: whether its identity is the same in all fires, and which half of it moved."""
    return stability(table(spark, sf_dir, "written_headers"), 3)


def identity_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity keys of the first fire that more than one file carries."""
    w = table(spark, sf_dir, "written_headers").filter("fire = 1")
    k = F.concat_ws("␟", F.coalesce(X.without_suffix(X.component_key("mfr")), F.lit("")), F.coalesce(X.component_key("doc_id"), F.lit("")), F.coalesce(X.revision_key("revision"), F.lit("")))
    return w.groupBy(k.alias("notice_key")).agg(F.countDistinct("file_name").alias("files")).filter("files > 1")


def content_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices whose content hash occurs more than once, by hash: copies and the first of them."""
    n = notice_keys(table(spark, sf_dir, "notice_headers"))
    return n.groupBy("content_hash").agg(F.count("*").alias("copies"), F.min("notice_id").alias("first_id")).filter("copies > 1")


_WKEY = KEY_SQL.replace("notice_id,", "notice_id, fire, file_name,", 1).replace("sha256(concat_ws('|', coalesce(doc_id, ''), coalesce(mfr, ''), coalesce(revision, ''), coalesce(pub_date, ''), coalesce(summary, ''))) AS content_hash", "1 AS x").replace("FROM notice_headers", "FROM written_headers")

QUERIES = {
    "notice_identity_keys": notice_identity_keys, "notice_revision_pairs": notice_revision_pairs, "notice_doc_types": notice_doc_types, "forced_dates": forced_dates,
    "effective_ltb": effective_ltb, "written_agreement": written_agreement, "identity_stability": identity_stability, "identity_collapse": identity_collapse, "content_copies": content_copies,
}

SQL = {
    "notice_identity_keys": f"""SELECT k.*, CASE WHEN s = '' THEN 'unknown' ELSE s END AS slug FROM ({KEY_SQL}) k JOIN (
        SELECT notice_id, regexp_replace(regexp_replace(regexp_extract(coalesce(doc_id, ''), '([^/]*)$', 1), '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM notice_headers) USING (notice_id)""",
    "notice_revision_pairs": f"""WITH k AS ({KEY_SQL.replace("notice_id,", "header_id AS notice_id,", 1).replace("coalesce(summary, '')", "''").replace("FROM notice_headers", "FROM written_headers")}), v AS (
        SELECT mfr_key, doc_key, revision_key, min(notice_id) AS id, count(*) AS copies FROM k WHERE mfr_key IS NOT NULL AND doc_key IS NOT NULL GROUP BY ALL),
      o AS (SELECT *, CASE WHEN regexp_matches(revision_key, '^\\d+(\\.\\d+)*$') THEN list_transform(string_split(revision_key, '.'), lambda x: CAST(x AS INT)) END AS nums, CASE WHEN regexp_matches(revision_key, '^[a-z]$') THEN revision_key END AS letter FROM v),
      p AS (SELECT a.id AS notice_a, b.id AS notice_b, a.copies AS copies_a, b.copies AS copies_b, a.nums AS na, b.nums AS nb, a.letter AS la, b.letter AS lb FROM o a JOIN o b ON a.mfr_key = b.mfr_key AND a.doc_key = b.doc_key AND a.id < b.id)
      SELECT notice_a, notice_b, copies_a, copies_b, CASE WHEN na IS NOT NULL AND nb IS NOT NULL THEN
          CASE WHEN list_resize(na, 8, 0) = list_resize(nb, 8, 0) THEN 'duplicate_copy' WHEN list_resize(na, 8, 0) > list_resize(nb, 8, 0) THEN 'supersedes' ELSE 'superseded_by' END
        WHEN la IS NOT NULL AND lb IS NOT NULL THEN CASE WHEN la > lb THEN 'supersedes' ELSE 'superseded_by' END ELSE 'revision_order_unknown' END AS relation FROM p""",
    "notice_doc_types": f"""SELECT notice_id,
        CASE WHEN lower(trim(coalesce(doc_type, ''))) = 'pcn' THEN 'PCN' WHEN lower(trim(coalesce(doc_type, ''))) = 'pdn' THEN 'PDN' WHEN {_like("lower(trim(coalesce(doc_type, '')))", X.PDN_TERMS)} THEN 'PDN' ELSE 'PCN' END AS type_of_code,
        CASE WHEN {_S} = 'pcn' THEN 'PCN' WHEN {_S} = 'pdn' THEN 'PDN' WHEN {_KD} THEN 'PDN' ELSE 'PCN' END AS type_of_label,
        {_S} IN ('pcn', 'pdn') OR {_KD} OR {_KP} AS known,
        CASE WHEN {_BOTH} THEN NULL WHEN {_PCN} THEN 'PCN' WHEN {_PDN} THEN 'PDN' WHEN {_KD} THEN 'PDN' WHEN {_KP} THEN 'PCN' END AS title_type,
        CASE WHEN {_BOTH} THEN 'ambiguous' WHEN {_PCN} OR {_PDN} THEN 'code' WHEN {_KP} OR {_KD} THEN 'keyword' END AS signal,
        CASE WHEN {_BOTH} THEN 0.3 WHEN {_PCN} OR {_PDN} THEN 0.9 WHEN {_KP} OR {_KD} THEN 0.6 END::DOUBLE AS score FROM notice_headers""",
    "forced_dates": f"""SELECT header_id, {forced_sql('pub_date')} AS forced, coalesce({forced_sql('trim(pub_date)')}, CASE WHEN regexp_matches(trim(pub_date), '{_NUM}') THEN {_ymd(_g('trim(pub_date)', _NUM, 3), _g('trim(pub_date)', _NUM, 1), _g('trim(pub_date)', _NUM, 2))} END) IS NOT NULL AS entirely_a_date FROM written_headers""",
    "effective_ltb": "SELECT candidate_id, coalesce(nullif(trim(iso), ''), nullif(trim(doc_level_ltb_date), '')) AS ltb, nullif(trim(iso), '') IS NULL AND nullif(trim(doc_level_ltb_date), '') IS NOT NULL AS inherited FROM ltb_candidates LEFT JOIN (SELECT notice_id, doc_level_ltb_date FROM notice_headers) USING (notice_id)",
    "written_agreement": "SELECT notice_id, field, CASE WHEN count(DISTINCT v) > 1 THEN 'DISAGREE' WHEN count(v) < count(*) THEN 'BLANK' ELSE 'agree' END AS verdict, count(DISTINCT v) AS readings FROM (" + " UNION ALL ".join(f"SELECT notice_id, '{c}' AS field, nullif(trim(regexp_replace(lower({c}), '\\s+', ' ', 'g')), '') AS v FROM written_headers" for c in ("mfr", "doc_id", "revision")) + ") GROUP BY ALL HAVING count(v) > 0",
    "identity_stability": f"""WITH k AS ({_WKEY}), g AS (SELECT notice_id, count(DISTINCT fire) AS fires, count(DISTINCT coalesce(mfr_key, '')) AS m, count(DISTINCT coalesce(doc_key, '')) AS d, count(DISTINCT coalesce(revision_key, '')) AS r, bool_or(mfr_key IS NULL OR doc_key IS NULL) AS missing FROM k GROUP BY 1)
      SELECT notice_id, fires, CASE WHEN fires < 3 THEN 'ABSENT' WHEN missing OR m > 1 OR d > 1 THEN 'identity' WHEN r > 1 THEN 'revision' ELSE 'stable' END AS verdict, concat_ws(',', CASE WHEN m > 1 THEN 'mfr' END, CASE WHEN d > 1 THEN 'doc_id' END, CASE WHEN r > 1 THEN 'revision' END) AS moved FROM g""",
    "identity_collapse": f"SELECT concat_ws('␟', coalesce(mfr_key, ''), coalesce(doc_key, ''), coalesce(revision_key, '')) AS notice_key, count(DISTINCT file_name) AS files FROM ({_WKEY}) WHERE fire = 1 GROUP BY 1 HAVING count(DISTINCT file_name) > 1",
    "content_copies": f"SELECT content_hash, count(*) AS copies, min(notice_id) AS first_id FROM ({KEY_SQL}) GROUP BY 1 HAVING count(*) > 1",
}
