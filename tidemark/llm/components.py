"""Connected components by repeated contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``root`` for every end of ``edges`` (columns a, b): equal roots are connected, the root is one of the ids.

    Each round lets every vertex point to its smallest neighbour if that is smaller, follows the pointers
    to their ends, and maps the edges to these ends; what is left is at most half as many vertices in every
    component, so there are few rounds. Each round is written to the shared folder. Nothing is collected.
    """
    edges = stored(edges.where("a <> b").select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stored(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("root")), "pointers")
        while True:
            ends = point.select(F.col("id").alias("via"), F.col("root").alias("end"))
            further = stored(point.join(ends, point["root"] == ends["via"]).select("id", "root", "end"), "pointers")
            point = further.select("id", F.col("end").alias("root"))
            if further.where("root <> end").isEmpty():
                break
        if labels is None:
            labels = point
        else:
            ends = point.select(F.col("id").alias("via"), F.col("root").alias("end"))
            labels = stored(labels.join(ends, labels["root"] == ends["via"], "left").select("id", F.coalesce("end", "root").alias("root")), "labels")
        at_a = point.select(F.col("id").alias("a"), F.col("root").alias("to_a"))
        at_b = point.select(F.col("id").alias("b"), F.col("root").alias("to_b"))
        mapped = edges.join(at_a, "a").join(at_b, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = stored(mapped.where("a <> b").distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
