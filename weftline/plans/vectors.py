"""Vector queries over the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vectors as V
from ..session import table


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unit mean of every label, by dimension."""
    return V.unit_means(table(spark, sf_dir, "embeddings"), "label", "embedding").withColumn("value", F.round("value", 6))


def cosine_self_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 50 against all: the nearest must be itself."""
    e = table(spark, sf_dir, "embeddings")
    n = V.nearest(e.filter("vec_id % 50 = 0"), e, "vec_id", "embedding")
    return n.select(F.col("query").alias("vec_id"), (F.col("query") == F.col("key")).alias("found"))


def cosine_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nearest other vectors of every vector whose id is divisible by 50."""
    e = table(spark, sf_dir, "embeddings")
    n = V.nearest(e.filter("vec_id % 50 = 0"), e, "vec_id", "embedding", 4).filter("query <> key")
    r = n.withColumn("r", F.expr("row_number() OVER (PARTITION BY query ORDER BY rank)")).filter("r <= 3")
    return r.select(F.col("query").alias("vec_id"), F.col("r").alias("rank"), F.col("key").alias("neighbour"), F.round("cosine", 5).alias("cosine"))


def lost_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written (all documents) that the vector store cannot return, counted."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    return V.lost_writes(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), e, "id").agg(F.count("*").alias("lost"))


QUERIES = {f.__name__: f for f in (label_centroids, cosine_self_retrieval, cosine_neighbours, lost_vectors)}
_S = "SELECT a.vec_id, b.vec_id AS o, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS c FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0"
SQL = {
    "label_centroids": "WITH d AS (SELECT label, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, dim, avg(x) AS m FROM d GROUP BY ALL), n AS (SELECT label, sqrt(sum(m * m)) AS norm FROM m GROUP BY 1) SELECT m.label AS label, dim, round(m / norm, 6) AS value FROM m JOIN n ON m.label IS NOT DISTINCT FROM n.label",
    "cosine_self_retrieval": f"SELECT vec_id, arg_max(o, round(c, 12) * 1000000000 - o / 1000000.0) = vec_id AS found FROM ({_S}) GROUP BY 1",
    "cosine_neighbours": f"SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY round(c, 12) DESC, o) AS rank, o AS neighbour, round(c, 5) AS cosine FROM ({_S}) WHERE o <> vec_id QUALIFY rank <= 3",
    "lost_vectors": "SELECT count(*) AS lost FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings))",
}
