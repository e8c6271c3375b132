"""Property graphs and triples as tables: projections, merges, reachability, synchronisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def edges_of(rows: DataFrame, src: str, lists: dict[str, str]) -> DataFrame:
    """(src, rel, dst): one distinct edge for each non-blank entry of the array columns in ``lists`` (column -> relation)."""

    def ends(column: str, rel: str):
        return F.transform(F.coalesce(F.col(column), F.array().cast("array<string>")), lambda v: F.struct(F.lit(rel).alias("rel"), F.trim(v).alias("dst")))

    arrays = [ends(c, rel) for c, rel in lists.items()]
    return rows.select(F.col(src).cast("string").alias("src"), F.explode(F.concat(*arrays)).alias("e")).select("src", "e.rel", "e.dst").filter("dst IS NOT NULL AND dst <> ''").distinct()


def nodes_of(edges: DataFrame, source_label: str) -> DataFrame:
    """(id, label): the ends of edges, labelled by relation; a source has the given label."""
    return edges.select(F.col("src").alias("id"), F.lit(source_label).alias("label")).unionByName(edges.select(F.col("dst").alias("id"), F.regexp_replace("rel", "^[A-Z]+_", "").alias("label"))).distinct()


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with ``new`` rows put over it by key: idempotent, one row per key.

    Of new rows with one key the greatest by all columns stays, whatever the partitioning.
    """
    rest = [c for c in new.columns if c not in keys]
    one = new.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]) if rest else new.distinct()
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(one)


def replaced_subtrees(old: DataFrame, new: DataFrame, scope: str) -> DataFrame:
    """``old`` without all rows of the scopes that ``new`` touches, plus ``new``: stale rows of a rewritten document go."""
    return old.join(new.select(scope).distinct(), scope, "left_anti").unionByName(new)


def reachable(edges: DataFrame) -> DataFrame:
    """(ancestor, node, depth): every node with all nodes above it; depth is the least.

    ``edges``: (parent, child). Paths are doubled: a round joins the paths known so far with themselves, so a
    chain of any depth takes logarithmically many rounds; a cycle ends where no pair is new or shorter.
    """
    from ..session import drop, materialize

    known = materialize(edges.select(F.col("parent").alias("ancestor"), F.col("child").alias("node"), F.lit(1).alias("depth")).filter("ancestor IS NOT NULL AND node IS NOT NULL").distinct(), "reach")
    n = known.count()
    while n:
        ahead = known.select(F.col("ancestor").alias("node"), F.col("node").alias("below"), F.col("depth").alias("more"))
        longer = known.join(ahead, "node").select("ancestor", F.col("below").alias("node"), (F.col("depth") + F.col("more")).alias("depth"))
        both = known.withColumn("old", F.col("depth")).unionByName(longer.withColumn("old", F.lit(None).cast("int")))
        now = materialize(both.groupBy("ancestor", "node").agg(F.min("depth").alias("depth"), F.min("old").alias("old")), "reach")
        n = now.filter("old IS NULL OR depth < old").count()
        drop(known)
        known = now.drop("old")
        known._weftline_path = now._weftline_path
    return known


def guarded(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges both of whose ends exist, the others): matched, never created."""
    ids = nodes.select("id").distinct()
    both = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi").select(*edges.columns)
    return both, edges.join(both, edges.columns, "left_anti")


def triples_of(rows: DataFrame, subject: str, literals: dict[str, str], graph) -> DataFrame:
    """(graph, s, p, o): the non-null columns of rows as triples of a named graph per row."""
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.col(c).cast("string").alias("o")) for c, p in literals.items()])
    return rows.select(graph.alias("graph"), F.col(subject).cast("string").alias("s"), F.explode(pairs).alias("x")).select("graph", "s", "x.p", "x.o").filter("o IS NOT NULL").distinct()


def put_graphs(store: DataFrame, new: DataFrame) -> DataFrame:
    """The store after a PUT: each graph in ``new`` is replaced whole."""
    return replaced_subtrees(store, new, "graph")


def missing_labels(triples: DataFrame, kind: str, label: str) -> DataFrame:
    """(s, label, opaque): labels derived for subjects of a kind that have none."""
    typed = triples.filter((F.col("p") == "type") & (F.col("o") == kind)).select("s").distinct()
    named = triples.filter(F.col("p") == label).select("s").distinct()
    lab = X.human_label(F.regexp_extract("s", r"([^#/]*)$", 1))
    return typed.join(named, "s", "left_anti").select("s", lab["label"].alias("label"), lab["opaque"].alias("opaque"))


def census(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, before, after): counts that differ between two states."""
    b = before.groupBy(key).agg(F.count("*").alias("before"))
    a = after.groupBy(key).agg(F.count("*").alias("after"))
    j = b.join(a, key, "full_outer").select(key, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return j.filter("before <> after")


def remapped(edges: DataFrame, survivors: DataFrame) -> DataFrame:
    """Edges whose ends are replaced by their survivors (old, new); loops and repeats that arise are dropped."""
    s = survivors.select(F.col("old").alias("src"), F.col("new").alias("ns"))
    d = survivors.select(F.col("old").alias("dst"), F.col("new").alias("nd"))
    e = edges.join(s, "src", "left").join(d, "dst", "left").select(F.coalesce("ns", "src").alias("src"), "rel", F.coalesce("nd", "dst").alias("dst"))
    return e.filter("src <> dst").distinct()


def drifted(expected: DataFrame, actual: DataFrame, key: str, content: str) -> DataFrame:
    """(key, state): missing, unexpected, changed or in_sync of two sets of named contents, white space at their ends aside.

    A key that a side gives twice counts once, with its greatest content; a null content is an empty one.
    """
    side = lambda d, name: d.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.trim(F.coalesce(content, F.lit("")))).alias(name))
    j = side(expected, "_e").join(side(actual, "_a"), key, "full_outer")
    return j.select(key, F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(F.col("_e") != F.col("_a"), "changed").otherwise("in_sync").alias("state"))
