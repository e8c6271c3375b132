"""Codes and registries: information codes, work-package tags, data module codes, ingest ids, kinds, failures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Kinds by the first digit of an information code, and the families without a kind.
INFO_KINDS = {"0": "DescriptiveDataModule", "2": "ProcedureDataModule", "4": "FaultIsolationDataModule", "5": "ProcedureDataModule", "7": "ProcedureDataModule", "9": "IllustratedPartsDataModule"}
UNMAPPED = ("1", "3", "6", "8")
# Work-package root tags and their kinds; those of the root kind have no kind of their own.
WP_KINDS = {
    "maintwp": "ProcedureDataModule",
    "gen.maintwp": "ProcedureDataModule",
    "genrepairwp": "ProcedureDataModule",
    "auxeqpwp": "ProcedureDataModule",
    "compchklistwp": "ProcedureDataModule",
    "destruct-materialwp": "ProcedureDataModule",
    "dmwr_operationalreqwp": "ProcedureDataModule",
    "emergencywp": "ProcedureDataModule",
    "eqploadwp": "ProcedureDataModule",
    "facilwp": "ProcedureDataModule",
    "lubewp": "ProcedureDataModule",
    "manuwp": "ProcedureDataModule",
    "mobilwp": "ProcedureDataModule",
    "opcheckwp": "ProcedureDataModule",
    "opunuwp": "ProcedureDataModule",
    "opusualwp": "ProcedureDataModule",
    "perseqpwp": "ProcedureDataModule",
    "pmcswp": "ProcedureDataModule",
    "pmi-cklistwp": "ProcedureDataModule",
    "pmiwp": "ProcedureDataModule",
    "pms-inspecwp": "ProcedureDataModule",
    "pshopanalwp": "ProcedureDataModule",
    "qawp": "ProcedureDataModule",
    "storagewp": "ProcedureDataModule",
    "surwp": "ProcedureDataModule",
    "tswp": "FaultIsolationDataModule",
    "diagnosticwp": "FaultIsolationDataModule",
    "opcheck-tswp": "FaultIsolationDataModule",
    "damage-assesswp": "FaultIsolationDataModule",
    "descwp": "DescriptiveDataModule",
    "ammo.markingwp": "DescriptiveDataModule",
    "ammowp": "DescriptiveDataModule",
    "bdar-geninfowp": "DescriptiveDataModule",
    "bdartoolswp": "DescriptiveDataModule",
    "coeibiiwp": "DescriptiveDataModule",
    "csi.wp": "DescriptiveDataModule",
    "ctrlindwp": "DescriptiveDataModule",
    "destruct-introwp": "DescriptiveDataModule",
    "dmwr_introwp": "DescriptiveDataModule",
    "dmwr_qarwp": "DescriptiveDataModule",
    "ginfowp": "DescriptiveDataModule",
    "handreceiptwp": "DescriptiveDataModule",
    "introwp": "DescriptiveDataModule",
    "macintrowp": "DescriptiveDataModule",
    "manu_items_introwp": "DescriptiveDataModule",
    "natowp": "DescriptiveDataModule",
    "oipwp": "DescriptiveDataModule",
    "pm-ginfowp": "DescriptiveDataModule",
    "pmcsintrowp": "DescriptiveDataModule",
    "pms-ginfowp": "DescriptiveDataModule",
    "ppmgeninfowp": "DescriptiveDataModule",
    "stowagewp": "DescriptiveDataModule",
    "techdescwp": "DescriptiveDataModule",
    "thrywp": "DescriptiveDataModule",
    "tsintrowp": "DescriptiveDataModule",
    "wiringwp": "DescriptiveDataModule",
    "plwp": "IllustratedPartsDataModule",
    "bulk_itemswp": "IllustratedPartsDataModule",
    "explistwp": "IllustratedPartsDataModule",
    "inventorywp": "IllustratedPartsDataModule",
    "kitswp": "IllustratedPartsDataModule",
    "mrplwp": "IllustratedPartsDataModule",
    "stl_partswp": "IllustratedPartsDataModule",
    "stlwp": "IllustratedPartsDataModule",
    "supitemwp": "IllustratedPartsDataModule",
    "aalwp": "DataModule",
    "macwp": "DataModule",
    "nsnindxwp": "DataModule",
    "orschwp": "DataModule",
    "pnindxwp": "DataModule",
    "refdesindxwp": "DataModule",
    "refwp": "DataModule",
    "substitute-matwp": "DataModule",
    "toolidwp": "DataModule",
    "torquewp": "DataModule",
    "tsindxwp": "DataModule",
    "wtloadwp": "DataModule",
    "chgwplist": "DataModule",
    "loepwp": "DataModule",
    "genwp": "DataModule",
}
DMC = r"^([A-Z0-9]+)-([A-Z])-([A-Z0-9]{2})-([A-Z0-9]{2})-([A-Z0-9]{2})-([A-Z0-9]{3})-([A-Z0-9]{4})-([A-Z])$"


def info_kind(code: Column | str) -> Column:
    """(kind, fallthrough) of an information code: families without a kind, and other characters, fall through to the root."""
    d = F.left(F.trim(F.coalesce(col(code), F.lit(""))), F.lit(1))
    kind = F.lit(None).cast("string")
    for k, v in INFO_KINDS.items():
        kind = F.when(d == k, v).otherwise(kind)
    return F.struct(F.coalesce(kind, F.lit("DataModule")).alias("kind"), F.when(kind.isNull(), F.when(d == "", F.lit("<empty>")).otherwise(d)).alias("fallthrough"))


def wp_kind(tag: Column | str) -> Column:
    """(kind, fallthrough, refused) of a work package's root tag as written in the document type.

    A name space before the tag is put aside, case counts. Tags without a kind of their own fall through to the
    root kind and are named; a tag that is not listed, or none, is refused and has no kind.
    """
    t = F.element_at(F.split(F.trim(col(tag)), "[}:]"), -1)
    kinds = F.create_map(*[F.lit(x) for pair in WP_KINDS.items() for x in pair])
    kind = F.try_element_at(kinds, t)
    return F.struct(kind.alias("kind"), F.when(kind == "DataModule", t).alias("fallthrough"), kind.isNull().alias("refused"))


def canonical_dmc(raw: Column | str) -> Column:
    """A data module code in canonical form: upper case, single dashes, no prefix or quotes; null if it is none."""
    s = F.regexp_replace(F.regexp_replace(F.upper(F.trim(col(raw))), r"^DMC-", ""), r"^[\"']+|[\"']+$", "")
    s = F.regexp_replace(s, r"[\s_]+", "-")
    return F.when(s.rlike(DMC), s)


def dmc_field(canonical: Column, name: str) -> Column:
    """One field of a canonical code."""
    at = {"mic": (1, 0, 0), "sdc": (2, 0, 0), "sysc": (3, 0, 0), "ssc": (4, 1, 1), "sssc": (4, 2, 1), "asy": (5, 0, 0), "dis": (6, 1, 2), "dvar": (6, 3, 1), "info": (7, 1, 3), "ivar": (7, 4, 1), "itemloc": (8, 0, 0)}
    g, start, n = at[name]
    part = F.regexp_extract(canonical, DMC, g)
    return part.substr(start, n) if n else part


def ingest_id(raw: Column | str) -> Column:
    """``sha256:`` and 64 hexadecimal digits; a bare hash is completed, anything else is null."""
    s = F.trim(col(raw))
    return F.when(s.rlike(r"^sha256:[0-9a-f]{64}$"), s).when(s.rlike(r"^[0-9a-fA-F]{64}$"), F.concat(F.lit("sha256:"), F.lower(s)))


def failure_code(message: Column | str) -> Column:
    """The reason code of a failure message, by the first marker that fits.

    Fixed values: the markers are the words of the messages.
    """
    m = F.coalesce(col(message), F.lit(""))
    has = m.contains
    return (
        F.when(has("carries no ") & has("registered content_kind"), "kind_unregistered").when(has("sidecar manifest missing or unparseable"), "sidecar_unreadable")
        .when(has("is a file FORMAT"), "domain_is_a_format").when(has("is a sha256 hash, not a content kind"), "content_kind_is_a_hash")
        .when(has("ingest_id") & (has("canonical") | has("sha256:") | has("not one of")), "ingest_id_malformed").otherwise("extraction_failed")
    )


def content_kind(metadata: Column | str, path: Column | str, registry: list[str]) -> Column:
    """(kind, refused): the declared kind, else the path's second segment; one lookup, no second chance.

    A declared kind that is not registered is refused; it does not fall back to the path.
    """
    value = F.coalesce(F.nullif(F.trim(col(metadata)), F.lit("")), F.try_element_at(F.split(col(path), "/"), F.lit(2)))
    known = value.isin(registry)
    return F.struct(F.when(known, value).alias("kind"), (~F.coalesce(known, F.lit(False))).alias("refused"))


def section_wpno(kind: Column | str, number: Column | str, tm: Column | str) -> Column:
    """A work package number: type, number and manual, lower case."""
    return F.lower(F.concat_ws("-", F.concat(col(kind), col(number)), col(tm)))
