"""Connected components of a link table, by contraction.

Each round hooks every vertex to its smallest neighbour, compresses the resulting forest to its roots
by pointer doubling, relabels the edges with the roots and drops those that became loops or repeats.
At least half of the vertices that still have edges vanish in a round, so the number of rounds is
logarithmic. No vertex's neighbourhood is ever gathered in one task: minima are combined before the
shuffle, and relabelling is a join that adaptive execution splits where a hub is skewed. Every round
ends in a table written to the shared folder, so a lost executor costs no more than one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop, materialize


def _roots(parent: DataFrame) -> DataFrame:
    """Pointer doubling over (node, parent) until every parent is a root."""
    written = parent
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        jumped = materialize(
            parent.join(up, "parent", "left").select("node", F.coalesce("up", "parent").alias("parent"), (F.coalesce("up", "parent") != F.col("parent")).alias("moved")),
            "roots",
        )
        drop(written)
        parent, written = jumped.select("node", "parent"), jumped
        if jumped.filter("moved").isEmpty():
            parent._weftline_path = jumped._weftline_path
            return parent


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every vertex that occurs in ``edges``; the component is its smallest vertex.

    Null ends are ignored, loops give a component of one vertex, repeated edges and either direction
    count once, an empty table gives an empty result.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    live = materialize(pairs.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    labels = None
    for _ in range(max_rounds):
        if live.isEmpty():
            break
        both = live.union(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("parent"))
        roots = _roots(materialize(hooks, "hooks"))
        first = labels is None
        if first:
            labels = roots
        else:
            held = labels
            moved = roots.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
            labels = materialize(labels.join(moved, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent")), "labels")
            drop(held)
        ru = roots.select(F.col("node").alias("u"), F.col("parent").alias("ru"))
        rv = roots.select(F.col("node").alias("v"), F.col("parent").alias("rv"))
        before = live
        live = materialize(
            live.join(ru, "u").join(rv, "v").filter("ru <> rv").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(),
            "edges",
        )
        drop(before, *([] if first else [roots]))
    else:
        raise RuntimeError("components did not converge")
    if labels is None:
        return nodes.select("node", F.col("node").alias("component"))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("parent", "node").alias("component"))
