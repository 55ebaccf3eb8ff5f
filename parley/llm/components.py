"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ids in ``edges`` (a, b); the component is its smallest id.

    Each round hooks every id to its smallest neighbour, follows the hooks to their roots by doubling, and keeps
    only the edges between different roots. Only aggregates and joins on stored tables; nothing reaches the driver.
    """
    edges = materialize(edges.filter("a <> b").distinct(), "edges")
    found: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
        roots = materialize(hooks.select("id", F.least("id", "low").alias("root")), "hooks")
        while True:
            above = roots.select(F.col("id").alias("root"), F.col("root").alias("above"))
            further = materialize(roots.join(above, "root", "left").select("id", "root", "above"), "roots")
            # a root is an id of its own table, so every row has something above it
            roots, moved = further.select("id", F.col("above").alias("root")), further.filter("above <> root")
            if moved.isEmpty():
                break
        if found is None:
            found = roots.select("id", F.col("root").alias("component"))
        else:
            later = roots.select(F.col("id").alias("component"), "root")
            found = materialize(
                found.join(later, "component", "left").select("id", F.coalesce("root", "component").alias("component")), "components"
            )
        ends = edges.join(roots.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a")
        ends = ends.join(roots.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b")
        edges = materialize(ends.filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")) if found is None else found
