"""Connected components of links between small integers, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.session import checkpoint_dir, merging

#: More rounds than any sensible chain of links needs; reached only by a fault.
MOST_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node in ``links``.

    Each round gives a node the smallest label among its neighbours and itself, then the label of
    that label, so the rounds grow with the logarithm of a chain's length as a rule. Neighbours'
    labels are combined map-side first: a node with very many links is no hot task. Lineage is
    cut by a checkpoint in the shared folder each round. Null ends are ignored; no links, no rows.
    """
    spark = links.sparkSession
    checkpoint_dir(spark)
    pairs = links.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x IS NOT NULL AND y IS NOT NULL AND x <> y")
    edges = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct().checkpoint()
    labels = edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select("node", F.least("node", "m").alias("label"), F.lit(True).alias("moved")).checkpoint()
    for _ in range(MOST_ROUNDS):
        near = edges.join(merging(labels.select(F.col("node").alias("y"), "label")), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(merging(near), "node", "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("new"))
        of = labels.select(F.col("node").alias("new"), F.col("label").alias("beyond"))
        labels = (
            nearer.join(merging(of), "new", "left")
            .select("node", F.least("new", F.coalesce("beyond", "new")).alias("now"), "label")
            .select("node", F.col("now").alias("label"), (F.col("now") < F.col("label")).alias("moved"))
            .checkpoint()
        )
        if labels.where("moved").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components aren't stable after {MOST_ROUNDS} rounds")
