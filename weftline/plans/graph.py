"""Graph and triple queries over steps, concepts and the sales hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph as G
from ..session import table

RELATIONS = {"tooling": "USES_Tool", "consumables": "USES_Consumable", "military_and_industry_standards": "GOVERNED_Standard", "internal_part_numbers": "NEEDS_Part", "figure_references": "SHOWN_Figure"}


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edges_of(table(spark, sf_dir, "mfg_steps"), "step_id", RELATIONS)


def step_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed edges from steps to tools, consumables, standards, parts and figures."""
    return _edges(spark, sf_dir)


def step_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of those edges by label."""
    return G.nodes_of(_edges(spark, sf_dir), "Step").groupBy("label").agg(F.count("*").alias("nodes"))


def hazard_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hazards and certificates of steps, with how many steps each applies to."""
    s = table(spark, sf_dir, "mfg_steps")
    e = G.edges_of(s.select("step_id", F.array(F.lower("hazard_class")).alias("hazard"), F.array(F.lower("required_cert")).alias("cert")), "step_id", {"hazard": "APPLIES_Hazard", "cert": "REQUIRES_Certification"})
    return e.groupBy("rel", "dst").agg(F.countDistinct("src").alias("steps"))


def section_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything below every region: nations, suppliers and customers."""
    n, c, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    tag = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    e = n.select(tag("r", "n_regionkey").alias("parent"), tag("n", "n_nationkey").alias("child"))
    e = e.unionByName(c.select(tag("n", "c_nationkey").alias("parent"), tag("c", "c_custkey").alias("child"))).unionByName(s.select(tag("n", "s_nationkey").alias("parent"), tag("s", "s_suppkey").alias("child")))
    return G.reachable(e)


def edge_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edge table after steps of even keys are delivered over a store of all steps but every third: edges by relation."""
    s = table(spark, sf_dir, "mfg_steps")
    old = G.edges_of(s.filter("step_key % 3 <> 0"), "step_id", RELATIONS)
    new = G.edges_of(s.filter("step_key % 2 = 0"), "step_id", RELATIONS)
    return G.merged(old, new, ["src", "rel", "dst"]).groupBy("rel").agg(F.count("*").alias("edges"))


def stale_subtrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections kept by package after packages with an even section are rewritten with those sections only."""
    s = table(spark, sf_dir, "base_sections").select("package_id", "section_id", "node_id")
    return G.replaced_subtrees(s, s.filter("section_id % 2 = 0"), "package_id").groupBy("package_id").agg(F.count("*").alias("sections"))


def guarded_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges whose target is a known term against those refused, by relation."""
    e = G.edges_of(table(spark, sf_dir, "mfg_steps"), "step_id", {"military_and_industry_standards": "GOVERNED_Standard", "material_and_hardware_slang": "USES_Material"})
    nodes = e.select(F.col("src").alias("id")).unionByName(table(spark, sf_dir, "canonical_terms").select(F.col("term").alias("id")))
    good, bad = G.guarded(e, nodes)
    count = lambda df, n: df.groupBy("rel").agg(F.count("*").alias(n))
    return count(good, "matched").join(count(bad, "refused"), "rel", "full_outer").na.fill(0)


def _triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "concept_records").select("record_id", F.col("domain"), "name", "id", F.lit("Concept").alias("type"))
    return G.triples_of(c, "record_id", {"name": "label", "id": "sameAs", "type": "type"}, F.concat(F.lit("urn:doc:"), F.lower("domain")))


def concept_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of concept records, counted by graph and predicate."""
    return _triples(spark, sf_dir).groupBy("graph", "p").agg(F.count("*").alias("triples"), F.countDistinct("s").alias("subjects"))


def unlabelled_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels derived for concepts that have none."""
    return G.missing_labels(_triples(spark, sf_dir), "Concept", "label")


def graph_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples by graph after one domain's graph is put again from every other record."""
    t = _triples(spark, sf_dir)
    new = t.filter((F.col("graph") == "urn:doc:training") & (F.col("s").cast("long") % 2 == 0))
    return G.put_graphs(t, new).groupBy("graph").agg(F.count("*").alias("triples"))


def relinked_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept-to-course edges after duplicate ids are merged, and what the merge saves: counts by domain."""
    c = table(spark, sf_dir, "concept_records")
    e = c.select(F.col("record_id").cast("string").alias("src"), F.col("domain").alias("rel"), F.col("course_id").alias("dst"))
    keep = c.groupBy("id").agg(F.min("record_id").alias("new"))
    surv = c.join(keep, "id").select(F.col("record_id").cast("string").alias("old"), F.col("new").cast("string").alias("new"))
    return G.remapped(e, surv).groupBy("rel").agg(F.count("*").alias("edges"))


def state_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept records per course before and after duplicates of an id are dropped, where that differs."""
    c = table(spark, sf_dir, "concept_records")
    after = c.groupBy("id").agg(F.min_by("course_id", "record_id").alias("course_id"))
    return G.census(c, after, "course_id")


QUERIES = {f.__name__: f for f in (step_edges, step_nodes, hazard_edges, section_reachability, edge_merge, stale_subtrees, guarded_edges, concept_triples, unlabelled_concepts, graph_put, relinked_edges, state_census)}


def _edge_sql(lists: dict[str, str], where: str = "true") -> str:
    return "SELECT DISTINCT * FROM (" + " UNION ALL ".join(f"SELECT step_id AS src, '{r}' AS rel, trim(v) AS dst FROM (SELECT step_id, unnest({c}) AS v FROM mfg_steps WHERE {where})" for c, r in lists.items()) + ") WHERE dst IS NOT NULL AND dst <> ''"


_E = _edge_sql(RELATIONS)
_T = "t AS (SELECT DISTINCT * FROM (SELECT 'urn:doc:' || lower(domain) AS graph, CAST(record_id AS VARCHAR) AS s, unnest(['label', 'sameAs', 'type']) AS p, unnest([name, id, 'Concept']) AS o FROM concept_records) WHERE o IS NOT NULL)"
_GE = _edge_sql({"military_and_industry_standards": "GOVERNED_Standard", "material_and_hardware_slang": "USES_Material"})
SQL = {
    "step_edges": _E,
    "step_nodes": f"WITH e AS ({_E}) SELECT label, count(*) AS nodes FROM (SELECT src AS id, 'Step' AS label FROM e UNION SELECT dst, regexp_replace(rel, '^[A-Z]+_', '') FROM e) GROUP BY 1",
    "hazard_edges": "SELECT rel, dst, count(DISTINCT src) AS steps FROM (SELECT step_id AS src, 'APPLIES_Hazard' AS rel, trim(lower(hazard_class)) AS dst FROM mfg_steps UNION ALL SELECT step_id, 'REQUIRES_Certification', trim(lower(required_cert)) FROM mfg_steps) WHERE dst IS NOT NULL AND dst <> '' GROUP BY ALL",
    "section_reachability": "WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier), r AS (SELECT parent AS ancestor, child AS node, 1 AS depth FROM e UNION SELECT ancestor, child, depth + 1 FROM r JOIN e ON e.parent = r.node) SELECT * FROM r",
    "edge_merge": f"SELECT rel, count(*) AS edges FROM ({_edge_sql(RELATIONS, 'step_key % 3 <> 0')} UNION {_edge_sql(RELATIONS, 'step_key % 2 = 0')}) GROUP BY 1",
    "stale_subtrees": "SELECT package_id, CASE WHEN count(*) FILTER (section_id % 2 = 0) > 0 THEN count(*) FILTER (section_id % 2 = 0) ELSE count(*) END AS sections FROM base_sections GROUP BY 1",
    "guarded_edges": f"WITH e AS ({_GE}), k AS (SELECT rel, dst IN (SELECT term FROM canonical_terms UNION SELECT src FROM e) AS good FROM e) SELECT rel, count(*) FILTER (good) AS matched, count(*) FILTER (NOT good) AS refused FROM k GROUP BY 1",
    "concept_triples": f"WITH {_T} SELECT graph, p, count(*) AS triples, count(DISTINCT s) AS subjects FROM t GROUP BY ALL",
    "unlabelled_concepts": f"WITH {_T} SELECT DISTINCT s, s AS label, regexp_matches(s, '^\\d+$') AS opaque FROM t WHERE s NOT IN (SELECT s FROM t WHERE p = 'label')",
    "graph_put": f"WITH {_T} SELECT graph, count(*) AS triples FROM t WHERE graph <> 'urn:doc:training' OR CAST(s AS BIGINT) % 2 = 0 GROUP BY 1",
    "relinked_edges": "SELECT rel, count(*) AS edges FROM (SELECT DISTINCT min(record_id) OVER (PARTITION BY id) AS src, domain AS rel, course_id AS dst FROM concept_records) GROUP BY 1",
    "state_census": "WITH b AS (SELECT course_id, count(*) AS n FROM concept_records GROUP BY 1), a AS (SELECT course_id, count(*) AS n FROM (SELECT id, arg_min(course_id, record_id) AS course_id FROM concept_records GROUP BY 1) GROUP BY 1) SELECT course_id, coalesce(b.n, 0) AS \"before\", coalesce(a.n, 0) AS \"after\" FROM b FULL JOIN a USING (course_id) WHERE coalesce(b.n, 0) <> coalesce(a.n, 0)",
}
