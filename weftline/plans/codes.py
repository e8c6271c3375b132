"""Classification of codes built from the keys of parts, orders and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as K
from ..session import table

KINDS = ["notice", "work-instruction", "manual", "course", "runbook", "vendor-mail", "forum", "test-report"]


def info_code_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of the information codes in part keys, and the tally of those that fall through."""
    k = K.info_kind(F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"))
    return table(spark, sf_dir, "part").groupBy(k["kind"].alias("kind"), k["fallthrough"].alias("fallthrough")).agg(F.count("*").alias("n"))


def module_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data module codes assembled from part keys in several spellings, made canonical, with three fields."""
    p = table(spark, sf_dir, "part")
    k = F.lpad(F.col("p_partkey").cast("string"), 8, "0")
    raw = F.concat(F.lit("dmc-mrad_a_"), k.substr(1, 2), F.when(F.col("p_partkey") % 7 == 0, " ").otherwise("-"), k.substr(3, 2), F.lit("-00-00A-"), k.substr(5, 3), F.lit("A-"), F.when(F.col("p_partkey") % 11 == 0, "?").otherwise("A"))
    c = K.canonical_dmc(raw)
    return p.select("p_partkey", c.alias("dmc"), K.dmc_field(c, "sysc").alias("sysc"), K.dmc_field(c, "info").alias("info"), K.dmc_field(c, "sssc").alias("sssc"))


def ingest_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest ids from hashes with and without prefix; others refused."""
    d = table(spark, sf_dir, "documents")
    h = F.sha2(F.col("doc_id").cast("string"), 256)
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("sha256:"), h)).when(F.col("doc_id") % 3 == 1, F.upper(h)).otherwise(F.col("package"))
    return d.select("doc_id", K.ingest_id(raw).alias("ingest_id"))


def failure_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reason codes of messages composed from event types, counted."""
    m = F.when(F.col("event_id") % 5 == 0, "object carries no registered content_kind").when(F.col("event_id") % 5 == 1, "ingest_id is not canonical").when(F.col("event_id") % 5 == 2, "sidecar manifest missing or unparseable: x").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").groupBy(K.failure_code(m).alias("code")).agg(F.count("*").alias("n"))


def content_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of documents by declaration (of every second one), else by path."""
    d = table(spark, sf_dir, "documents")
    k = K.content_kind(F.when(F.col("doc_id") % 2 == 0, F.col("source")).when(F.col("doc_id") % 5 == 0, "unheard-of"), F.concat_ws("/", F.lit("in"), "source", "package"), KINDS)
    return d.groupBy(k["kind"].alias("kind"), k["refused"].alias("refused")).agg(F.count("*").alias("n"))


def kind_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that are not processable, with the reason."""
    t = table(spark, sf_dir, "source_targets")
    have = table(spark, sf_dir, "documents").select("source").distinct().withColumn("seen", F.lit(True))
    j = t.join(have, "source", "left")
    return j.select("source", F.when(~F.col("source").isin(KINDS), "not registered").when(F.col("seen").isNull(), "no documents").alias("reason")).filter("reason IS NOT NULL")


QUERIES = {f.__name__: f for f in (info_code_kinds, module_codes, ingest_ids, failure_codes, content_kinds, kind_exclusions)}
_K = "lpad(CAST(p_partkey AS VARCHAR), 8, '0')"
_DMC = f"replace(upper('mrad-a-' || substr({_K}, 1, 2) || '-' || substr({_K}, 3, 2) || '-00-00A-' || substr({_K}, 5, 3) || 'A-' || CASE WHEN p_partkey % 11 = 0 THEN '?' ELSE 'A' END), ' ', '-')"
_MSG = "CASE event_id % 5 WHEN 0 THEN 'kind_unregistered' WHEN 1 THEN 'ingest_id_malformed' WHEN 2 THEN 'sidecar_unreadable' ELSE 'extraction_failed' END"
_IN = ", ".join(f"'{k}'" for k in KINDS)
SQL = {
    "info_code_kinds": "WITH d AS (SELECT left(lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0'), 1) AS d FROM part) SELECT CASE d WHEN '0' THEN 'DescriptiveDataModule' WHEN '2' THEN 'ProcedureDataModule' WHEN '4' THEN 'FaultIsolationDataModule' WHEN '5' THEN 'ProcedureDataModule' WHEN '7' THEN 'ProcedureDataModule' WHEN '9' THEN 'IllustratedPartsDataModule' ELSE 'DataModule' END AS kind, CASE WHEN d IN ('1', '3', '6', '8') THEN d END AS fallthrough, count(*) AS n FROM d GROUP BY ALL",
    "module_codes": f"SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN {_DMC} END AS dmc, CASE WHEN p_partkey % 11 <> 0 THEN substr({_K}, 1, 2) END AS sysc, CASE WHEN p_partkey % 11 <> 0 THEN substr({_K}, 5, 3) END AS info, CASE WHEN p_partkey % 11 <> 0 THEN substr({_K}, 4, 1) END AS sssc FROM part",
    "ingest_ids": "SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN 'sha256:' || sha256(CAST(doc_id AS VARCHAR)) END AS ingest_id FROM documents",
    "failure_codes": f"SELECT {_MSG} AS code, count(*) AS n FROM events GROUP BY 1",
    "content_kinds": f"WITH v AS (SELECT CASE WHEN doc_id % 2 = 0 THEN source WHEN doc_id % 5 = 0 THEN 'unheard-of' ELSE source END AS v FROM documents) SELECT CASE WHEN v IN ({_IN}) THEN v END AS kind, coalesce(v NOT IN ({_IN}), true) AS refused, count(*) AS n FROM v GROUP BY ALL",
    "kind_exclusions": f"SELECT source, CASE WHEN source NOT IN ({_IN}) THEN 'not registered' ELSE 'no documents' END AS reason FROM source_targets WHERE source NOT IN ({_IN}) OR source NOT IN (SELECT source FROM documents WHERE source IS NOT NULL)",
}
