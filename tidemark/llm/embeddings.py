"""Embedding near-dedup: a small-world graph per shard, every shard queried, audits, verified cosine, components.

Equal vectors of a label are one class. The classes of a label are dealt at random into shards of about
``SHARD``; a graph is built for each shard, and each shard's vectors are a block of queries to every shard of the label (each two
shards once). A block first audits its beam: up to ``AUDIT`` of its queries are compared with the whole shard, and the beam is
doubled until the recall holds, in the end to the whole shard. Of the links of a block, a task hands on counts
and a spanning forest, never all pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and those without a label, have no
links and are components of their own; so are vectors of different dimension to each other; repeated
rows are linked with each other; a null id is the component of its own or the smallest other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.hnsw import Graph
from tidemark.llm.store import stored

LEAST = 0.93
SHARD = 2_000
BEAM = 32
AUDIT = 128
RECALL = 0.995


def _unit(blob: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(blob, np.float64).reshape(rows, -1)


def _forest(n: int, pairs: list[tuple[int, np.ndarray]]) -> list[int]:
    """Root of each of n nodes under the links (one node, its partners)."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, others in pairs:
        for b in others.tolist():
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [root(x) for x in range(n)]


def near_duplicates(vectors: DataFrame, least: float = LEAST, shard: int = SHARD, beam: int = BEAM, audit: int = AUDIT, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("class", F.when(fine & F.col("label").isNotNull(), F.xxhash64("label", F.to_json(F.struct("v")))))
    classes = rows.where("class is not null").groupBy("class", "label", F.size("v").alias("dim")).agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.any_value("v").alias("v"))
    classes = stored(classes, "vector-classes")
    shards = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).alias("shards"))
    dealt = classes.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "class"), F.col("shards")))
    label = vectors.schema["label"].dataType.simpleString()

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("class", ignore_index=True)
        v = np.array(part["v"].tolist(), np.float64)
        v /= np.abs(v).max(axis=1, keepdims=True)  # no overflow in the norm
        graph = Graph(v / np.linalg.norm(v, axis=1, keepdims=True))
        spread = np.linspace(0, len(part) - 1, min(audit, len(part))).astype(int)
        own = {
            "classes": part["class"].to_numpy(np.int64).tobytes(), "counts": part["n"].to_numpy(np.int64).tobytes(), "vectors": graph.vectors.tobytes(),
            "layers": [x.tobytes() for x in graph.layers], "entry": graph.entry, "beam": graph.audited(graph.vectors[spread], least, beam, recall, spread),
        }
        return pd.DataFrame([{**part[["label", "dim", "shard", "shards"]].iloc[0].to_dict(), **own}])

    graph_columns = "classes binary, counts binary, vectors binary, layers array<binary>, entry int, beam int"
    # Dealt anew by shard: the join before leaves all shards of a label in one task.
    by_shard = dealt.repartition("label", "dim", "shard").groupBy("label", "dim", "shard")
    graphs = stored(by_shard.applyInPandas(build, f"label {label}, dim int, shard long, shards long, {graph_columns}"), "graphs")
    blocks = graphs.select("label", "dim", F.col("shard").alias("block"), F.col("classes").alias("q_classes"), F.col("counts").alias("q_counts"), F.col("vectors").alias("queries"))
    # Each two shards of a label once; a row is an index and a block of queries, of bounded size.
    asked = graphs.join(blocks, ["label", "dim"]).where("block >= shard")

    def ask(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in part.itertuples():
            ids, q_ids = np.frombuffer(r.classes, np.int64), np.frombuffer(r.q_classes, np.int64)
            counts, q_counts = np.frombuffer(r.counts, np.int64), np.frombuffer(r.q_counts, np.int64)
            graph = Graph.__new__(Graph)
            graph.vectors, graph.entry = _unit(r.vectors, len(ids)), int(r.entry)
            graph.layers = [np.frombuffer(x, np.int32).reshape(len(ids), -1) for x in r.layers]
            graph._top, graph._seen, graph._mark = len(graph.layers) - 1, np.zeros(len(ids), np.int64), 0
            queries, own = _unit(r.queries, len(q_ids)), r.shard == r.block
            spread = np.linspace(0, len(q_ids) - 1, min(audit, len(q_ids))).astype(int)
            width = int(r.beam) if own else graph.audited(queries[spread], least, int(r.beam), recall)
            n, pairs = len(ids), []
            met = np.zeros(n + (0 if own else len(q_ids)), np.int64)
            found = [graph.within(q, least, width) for q in queries]
            if own:
                # A link counts for both ends, whichever of them found it.
                a = np.repeat(np.arange(n), [len(f) for f in found])
                b = np.concatenate(found) if found else np.empty(0, np.int64)
                keys = np.unique(np.minimum(a, b)[a != b] * n + np.maximum(a, b)[a != b])
                a, b = keys // n, keys % n
                np.add.at(met, a, counts[b])
                np.add.at(met, b, counts[a])
                pairs = [(int(x), np.array([y])) for x, y in zip(a, b, strict=True)]
            else:
                for k, f in enumerate(found):
                    if len(f):
                        met[n + k] += counts[f].sum()
                        met[f] += q_counts[k]
                        pairs.append((n + k, f))
            roots = _forest(len(met), pairs)
            every = ids if own else np.concatenate([ids, q_ids])
            linked = np.flatnonzero(met)
            out.append(pd.DataFrame({"class": every[linked], "links": met[linked], "root": every[np.array(roots, np.int64)[linked]]}))
        return pd.concat(out)

    met = stored(asked.repartition("label", "dim", "shard", "block").groupBy("label", "dim", "shard", "block").applyInPandas(ask, "class long, links long, root long"), "vector-links")
    links = met.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("class").alias("a"), F.col("root").alias("b")))
    rooted = classes.select("class", "first_id", "n").join(roots, classes["class"] == roots["id"], "left").withColumn("root", F.coalesce("root", "class"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = stored(rooted.join(smallest, "root").join(links, "class", "left").select("class", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "vector-classes")
    out = rows.select("vec_id", "class").join(result, "class", "left")
    own_id = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), own_id.alias("component_id"), F.col("vec_id").eqNullSafe(own_id).alias("kept"))
