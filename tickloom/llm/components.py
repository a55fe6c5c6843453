"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.session import store


def connected_components(edges: DataFrame, name: str = "components", folder: str | None = None) -> DataFrame:
    """One row per id in ``edges`` (columns a, b): id and component, its smallest connected id.

    Every round lets each id follow its smallest neighbour, shortens the chains that arise and
    replaces ids by the ends of their chains. An id that is not the smallest around it
    disappears, so at least half of the connected ids go in every round. Rounds are written to
    the shared folder, or to ``folder`` in it, and only counts come to the driver. No edges give no rows.
    """
    edges = store(edges.select("a", "b").where("a <> b").distinct(), name, folder)
    labels = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = store(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), name, folder)
        while True:
            above = parent.select(F.col("id").alias("component"), F.col("component").alias("above"))
            parent = store(
                parent.join(above, "component").select(
                    "id", F.col("above").alias("component"), (F.col("above") != F.col("component")).alias("moved")
                ),
                name,
                folder,
            )
            if parent.where("moved").isEmpty():
                break
            parent = parent.drop("moved")
        parent = parent.select("id", "component")
        if labels is None:
            labels = parent
        else:
            new = parent.select(F.col("id").alias("component"), F.col("component").alias("above"))
            labels = labels.join(new, "component", "left").select(
                "id", F.coalesce("above", "component").alias("component")
            )
            labels = store(labels, name, folder)
        left = parent.select(F.col("id").alias("a"), F.col("component").alias("x"))
        right = parent.select(F.col("id").alias("b"), F.col("component").alias("y"))
        edges = store(
            edges.join(left, "a").join(right, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            name,
            folder,
        )
        if edges.isEmpty():
            return labels
