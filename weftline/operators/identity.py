"""Identity of notices: keys, relations of versions, agreement and stability of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def notice_keys(headers: DataFrame) -> DataFrame:
    """``headers`` with mfr_key, doc_key, revision_key (null where absent) and the hash of what is declared."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    return (
        headers.withColumn("mfr_key", X.without_suffix(X.component_key("mfr")))
        .withColumn("doc_key", X.component_key("doc_id"))
        .withColumn("revision_key", X.revision_key("revision"))
        .withColumn("content_hash", F.sha2(F.concat_ws("|", *map(part, ("doc_id", "mfr", "revision", "pub_date", "summary"))), 256))
    )


def revision_relations(keyed: DataFrame) -> DataFrame:
    """(notice_a, notice_b, copies_a, copies_b, relation) between the distinct revisions of one notice.

    Copies (equal maker, number and revision) are collapsed to their smallest notice_id first, so only
    versions are paired. Dotted numbers compare part by part (up to eight), single letters by order,
    an absent or other revision gives revision_order_unknown; equal order is a duplicate_copy.
    """
    v = keyed.filter("mfr_key IS NOT NULL AND doc_key IS NOT NULL").groupBy("mfr_key", "doc_key", "revision_key").agg(F.min("notice_id").alias("id"), F.count("*").alias("copies"))
    nums = F.when(F.col("revision_key").rlike(r"^\d+(\.\d+)*$"), F.slice(F.concat(F.transform(F.split("revision_key", r"\."), lambda x: x.cast("int")), F.array_repeat(F.lit(0), 8)), 1, 8))
    v = v.withColumn("nums", nums).withColumn("letter", F.when(F.col("revision_key").rlike("^[a-z]$"), F.col("revision_key")))
    a, b = v.alias("a"), v.alias("b")
    j = a.join(b, (F.col("a.mfr_key") == F.col("b.mfr_key")) & (F.col("a.doc_key") == F.col("b.doc_key")) & (F.col("a.id") < F.col("b.id")))
    na, nb, la, lb = F.col("a.nums"), F.col("b.nums"), F.col("a.letter"), F.col("b.letter")
    relation = (
        F.when(na.isNotNull() & nb.isNotNull(), F.when(na == nb, "duplicate_copy").when(na > nb, "supersedes").otherwise("superseded_by"))
        .when(la.isNotNull() & lb.isNotNull(), F.when(la > lb, "supersedes").otherwise("superseded_by"))
        .otherwise("revision_order_unknown")
    )
    return j.select(F.col("a.id").alias("notice_a"), F.col("b.id").alias("notice_b"), F.col("a.copies").alias("copies_a"), F.col("b.copies").alias("copies_b"), relation.alias("relation"))


def agreement(readings: DataFrame, fields: list[str]) -> DataFrame:
    """(notice_id, field, verdict, readings): DISAGREE before BLANK before agree; all-blank fields have no row."""
    long = readings.select("notice_id", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("v")) for c in fields])).alias("x")).select("notice_id", "x.field", F.nullif(X.squeeze(F.lower("x.v")), F.lit("")).alias("v"))
    g = long.groupBy("notice_id", "field").agg(F.countDistinct("v").alias("readings"), F.count("v").alias("given"), F.count("*").alias("n")).filter("given > 0")
    return g.select("notice_id", "field", F.when(F.col("readings") > 1, "DISAGREE").when(F.col("given") < F.col("n"), "BLANK").otherwise("agree").alias("verdict"), "readings")


def stability(readings: DataFrame, fires: int) -> DataFrame:
    """(notice_id, fires, verdict, moved): stable, or which half of the identity differs between fires."""
    k = readings.select("notice_id", "fire", X.without_suffix(X.component_key("mfr")).alias("m"), X.component_key("doc_id").alias("d"), X.revision_key("revision").alias("r"))
    count = lambda c: F.countDistinct(F.coalesce(F.col(c), F.lit("")))
    g = k.groupBy("notice_id").agg(F.countDistinct("fire").alias("fires"), count("m").alias("m"), count("d").alias("d"), count("r").alias("r"), F.bool_or(F.col("m").isNull() | F.col("d").isNull()).alias("missing"))
    verdict = F.when(F.col("fires") < fires, "ABSENT").when(F.col("missing") | (F.col("m") > 1) | (F.col("d") > 1), "identity").when(F.col("r") > 1, "revision").otherwise("stable")
    moved = F.concat_ws(",", F.when(F.col("m") > 1, "mfr"), F.when(F.col("d") > 1, "doc_id"), F.when(F.col("r") > 1, "revision"))
    return g.select("notice_id", "fires", verdict.alias("verdict"), moved.alias("moved"))
