"""Connected components of an edge table, by randomised contraction.

Every round each node points at the smallest node of its closed neighbourhood, where
"smallest" is taken after an exclusive-or with that round's random mask. The pointed-at
nodes become the nodes of the next, smaller graph. A fresh order per round keeps long
chains from shrinking by one node a round: the expected number of rounds is logarithmic.
All steps are hash aggregates on plain longs and equi-joins; nothing reaches the driver
but one row count a round.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, materialise


def connected_components(edges: DataFrame, left: str, right: str, seed: int = 7) -> DataFrame:
    """(node, component) for each node of `edges`; `component` is one node of its component.

    Node ids are longs that look random (hashes or fingerprints), so that the masked
    orders of different rounds are unrelated. Edges with a null end and self loops are
    ignored; repeated edges count once; no edges give an empty result.
    """
    draw = random.Random(seed)
    spark = edges.sparkSession
    graph = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v"))
    graph = materialise(graph.where("u <> v").distinct(), "edges")
    labels = spark.createDataFrame([], "node long, component long")
    parents: list[DataFrame] = []
    while not graph.isEmpty():
        mask = F.lit(draw.getrandbits(64) - 2**63).cast("long")
        both = graph.unionAll(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.min(F.col("v").bitwiseXOR(mask)).alias("m"))
        parent = best.select("u", F.least("m", F.col("u").bitwiseXOR(mask)).bitwiseXOR(mask).alias("p"))
        parents.append(materialise(parent, "parents"))
        of_u = parents[-1].select("u", F.col("p").alias("pu"))
        of_v = parents[-1].select(F.col("u").alias("v"), F.col("p").alias("pv"))
        smaller = graph.join(of_u, "u").join(of_v, "v").where("pu <> pv")
        smaller = smaller.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
        done, graph = graph, materialise(smaller, "edges")
        drop_scratch(done)
    for k, parent in enumerate(parents):
        if k == 0:
            labels = parent.select(F.col("u").alias("node"), F.col("p").alias("component"))
        else:
            step = parent.select(F.col("u").alias("component"), "p")
            labels = labels.join(step, "component", "left").select("node", F.coalesce("p", "component").alias("component"))
    return labels
