"""Every p query on empty tables, on tables of nulls with extra columns, and on repeated rows."""

import pytest
from pyspark.sql import functions as F

from weftline.llm import catalogue as llm
from weftline.plans import catalogue
from weftline.session import table

NAMES = "notice_headers written_headers ltb_candidates concept_records slide_concepts mfg_steps base_sections documents canonical_terms split_limits eval_items source_targets".split()
QUERIES = {k: f for k, f in (catalogue.queries() | llm.queries()).items() if k[0] == "p" and k[1].isdigit() and k.endswith(("_found", "_mix"))}
KEYS = {"notice_id", "header_id", "candidate_id", "record_id", "concept_key", "step_key", "section_id", "doc_id", "ref_id", "item_id"}


def written(spark, small, folder, change):
    for n in NAMES:
        change(n, table(spark, small, n)).coalesce(1).write.parquet(f"file://{folder}/{n}.parquet")
    return f"file://{folder}"


@pytest.fixture(scope="module")
def empty(spark, small, tmp_path_factory):
    return written(spark, small, tmp_path_factory.mktemp("empty"), lambda n, d: d.limit(0))


@pytest.fixture(scope="module")
def nulls(spark, small, tmp_path_factory):
    def change(n, d):
        d = d.limit(6)
        d = d.select(*[F.col(c) if c in KEYS and not (n == "notice_headers" and c == "doc_id") else F.lit(None).cast(t).alias(c) for c, t in d.dtypes])
        return d.withColumns({c: F.lit("x") for c in ("key", "n", "q", "e", "word", "kind", "entry", "bucket", "score", "tokens", "count") if c not in d.columns})

    return written(spark, small, tmp_path_factory.mktemp("nulls"), change)


@pytest.fixture(scope="module")
def twice(spark, small, tmp_path_factory):
    grow = {"documents": "doc_id", "base_sections": "section_id", "concept_records": "record_id"}

    def change(n, d):
        if n not in grow:
            return d
        k = grow[n]
        return d.unionByName(d.withColumn(k, F.col(k) + 1_000_000)).withColumn("extra_" + k, F.lit(1))

    return written(spark, small, tmp_path_factory.mktemp("twice"), change)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_null_columns_and_extra_ones(spark, nulls, name):
    assert QUERIES[name](spark, nulls).count() == 0


@pytest.mark.parametrize("name", ["p2_found", "p4_found", "p6_found", "p7_found", "p9_found"])
def test_repeated_rows_are_reported_alike(spark, small, twice, name):
    once, both = QUERIES[name](spark, small), QUERIES[name](spark, twice)
    if name == "p2_found":
        kept = table(spark, small, "concept_records").count()
        assert both.count() >= once.count() * 2 and both.count() <= 2 * kept
        return
    key = {"p4_found": "section_id", "p6_found": "row_id", "p7_found": "doc_id", "p9_found": "doc_id"}[name]
    a = both.filter(F.col(key) < 1_000_000)
    b = both.filter(F.col(key) >= 1_000_000).withColumn(key, F.col(key) - 1_000_000)
    if name == "p6_found":
        a, b = a.filter("field = 'content'"), b.filter("field = 'content'")
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
