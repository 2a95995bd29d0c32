"""Connected components over links, by hooking each class to its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import saved


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``id, comp`` after the classes that ``links`` (``a, b``) join have become one.

    A round hooks every class to its smallest neighbour, follows the hooks one step
    further and contracts the links, so the rounds grow with the logarithm of the
    longest chain. Each round is saved in the shared folder. ``comp`` is the
    smallest class of those joined.
    """
    a = labels.select(F.col("id").alias("a"), F.col("comp").alias("x"))
    b = labels.select(F.col("id").alias("b"), F.col("comp").alias("y"))
    edges = links.select("a", "b").join(a, "a").join(b, "b").filter("x <> y").select("x", "y").distinct()
    edges = saved(edges, "edges")
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        hook = saved(both.groupBy("x").agg(F.min("y").alias("to")).filter("to < x"), "hooks")
        next_hook = hook.select(F.col("x").alias("to"), F.col("to").alias("next"))
        jump = saved(hook.join(next_hook, "to", "left").select("x", F.coalesce("next", "to").alias("to")), "jumps")
        labels = labels.join(jump, labels["comp"] == jump["x"], "left").select("id", F.coalesce("to", "comp").alias("comp"))
        labels = saved(labels, "labels")
        for end in ("x", "y"):
            moved = jump.select(F.col("x").alias(end), F.col("to").alias("_to"))
            edges = edges.join(moved, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
        edges = saved(edges.filter("x <> y").select("x", "y").distinct(), "edges")
    return labels
