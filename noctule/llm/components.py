"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import materialize


def components(edges: DataFrame) -> DataFrame:
    """Label every node of ``edges`` (BIGINT ``a``, ``b``): rows of ``node`` and ``label``, the least node it is connected with.

    Nodes are renamed by a 64-bit bijection, so that ids in a chain do not make chains of steps. Each round every
    node joins its least neighbour and edges are contracted; a fixed share of nodes goes each round. All
    rounds are equi-joins and aggregates over written tables.
    """
    spark = edges.sparkSession
    e = edges.select(F.xxhash64("a").alias("u"), F.xxhash64("b").alias("v")).where("u <> v").distinct()
    names = materialize(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.xxhash64("node").alias("label")), "nodes")
    labels = names
    while True:
        counts: dict[str, int] = {}
        e = materialize(e, "edges", counts)
        if not counts["edges"]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("to"))
        step = materialize(step, "steps")
        # two steps at once halve the rounds
        far = step.alias("x").join(step.alias("y"), F.col("x.to") == F.col("y.u")).select(F.col("x.u").alias("u"), F.col("y.to").alias("to"))
        step = materialize(far, "steps")
        labels = materialize(labels.join(step, labels["label"] == step["u"], "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        left, right = step.select("u", F.col("to").alias("tu")), step.select(F.col("u").alias("v"), F.col("to").alias("tv"))
        e = e.join(left, "u").join(right, "v").where("tu <> tv").select(F.least("tu", "tv").alias("u"), F.greatest("tu", "tv").alias("v")).distinct()
    least = materialize(labels.groupBy("label").agg(F.min("node").alias("least")), "least")
    return labels.join(least, "label").select("node", F.col("least").alias("label"))
