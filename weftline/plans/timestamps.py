"""Timestamp normalisation over the tables that hold typed dates (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import normal_timestamp
from ..session import table


def typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, row_id, value, site_tz) of every typed date."""
    w = table(spark, sf_dir, "written_headers")
    c = table(spark, sf_dir, "ltb_candidates")
    stack = lambda df, key, t, x, y: df.select(
        F.col(key).alias("row_id"), "site_tz",
        F.explode(F.array(*[F.struct(F.lit(f"{t}.{k}").alias("field"), F.col(k).alias("value")) for k in (x, y)])).alias("v"),
    ).select("v.field", "row_id", "v.value", "site_tz")
    return stack(w, "header_id", "written_headers", "pub_date", "doc_level_ltb_date").unionByName(stack(c, "candidate_id", "ltb_candidates", "source", "iso"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value that states a valid date or time and is not in normal form, with its normal form.

    Nulls, blanks, placeholders and impossible dates give no row; repeated rows each give their own.
    No shuffle: one scan of each table and one Arrow-batched conversion.
    """
    v = typed_values(spark, sf_dir).filter("value IS NOT NULL")
    out = v.withColumn("normal", normal_timestamp(F.col("value"), F.col("site_tz")))
    return out.filter("normal IS NOT NULL AND normal <> value").select("field", "row_id", "normal")


QUERIES = {"p5_found": p5_found}
