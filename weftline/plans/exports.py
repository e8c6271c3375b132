"""Profile-driven exports, catalogue merges and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from ..sources import tables as S


def profile_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates exported by notice and part with notice fields, by a profile."""
    c = table(spark, sf_dir, "ltb_candidates").select("notice_id", F.col("candidate_id").alias("part_index"), F.explode(F.array(F.struct(F.lit("iso").alias("field"), F.col("iso").alias("value")), F.struct(F.lit("phrase").alias("field"), F.col("phrase").alias("value")))).alias("x")).select("notice_id", "part_index", "x.*")
    n = table(spark, sf_dir, "notice_headers").select("notice_id", "doc_id", "mfr")
    return S.exported(c, n, [("Notice", "notice", "doc_id"), ("Maker", "notice", "mfr"), ("LTB", "part", "iso"), ("Wording", "part", "phrase")])


def merged_catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as two catalogues by nation and number; the later one wins, poor ones are left out."""
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 500).cast("string").alias("entity"), F.col("c_custkey").alias("k"), F.col("c_name").alias("description"), F.when(F.col("c_acctbal") > 0, 0.9).otherwise(0.5).alias("confidence"))
    c = c.groupBy("entity").agg(F.min_by(F.struct("description", "confidence"), "k").alias("r")).select("entity", "r.*")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("entity"), F.col("s_name").alias("description"), F.when(F.col("s_acctbal") > 0, 0.95).otherwise(0.6).alias("confidence"))
    return S.merged_catalogues([c, s])


def sales_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of line items by flag and status with subtotals (an extension: grouping sets)."""
    li = table(spark, sf_dir, "lineitem")
    return li.rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.avg("l_discount"), 4).alias("disc"))


def flattened_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested header structs flattened to dotted columns, with ragged rows united."""
    n = table(spark, sf_dir, "notice_headers").select("notice_id", F.struct(F.struct("mfr", "mfr_parent").alias("maker"), "pub_date").alias("header"))
    w = table(spark, sf_dir, "written_headers").filter("fire = 1").select("notice_id", F.struct(F.struct("mfr").alias("maker"), "doc_id").alias("header"))
    return S.ragged_union([S.flattened(n, "_"), S.flattened(w, "_")])


QUERIES = {f.__name__: f for f in (profile_export, merged_catalogues, sales_totals, flattened_headers)}
SQL = {
    "profile_export": "SELECT n.notice_id, candidate_id AS part_index, n.doc_id AS Notice, n.mfr AS Maker, iso AS LTB, phrase AS Wording FROM notice_headers n LEFT JOIN ltb_candidates c USING (notice_id)",
    "merged_catalogues": "WITH c AS (SELECT CAST(c_custkey % 500 AS VARCHAR) AS entity, arg_min(c_name, c_custkey) AS description, arg_min(CASE WHEN c_acctbal > 0 THEN 0.9 ELSE 0.5 END, c_custkey) AS confidence FROM customer GROUP BY 1), s AS (SELECT CAST(s_suppkey AS VARCHAR) AS entity, s_name AS description, CASE WHEN s_acctbal > 0 THEN 0.95 ELSE 0.6 END AS confidence FROM supplier), m AS (SELECT coalesce(s.entity, c.entity) AS entity, coalesce(s.description, c.description) AS description, coalesce(s.confidence, c.confidence)::DOUBLE AS confidence FROM c FULL JOIN s USING (entity)) SELECT * FROM m WHERE confidence >= 0.85",
    "sales_totals": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(avg(l_discount), 4) AS disc FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "flattened_headers": "SELECT notice_id, mfr AS header_maker_mfr, mfr_parent AS header_maker_mfr_parent, pub_date AS header_pub_date, NULL AS header_doc_id FROM notice_headers UNION ALL SELECT notice_id, mfr, NULL, NULL, doc_id FROM written_headers WHERE fire = 1",
}
