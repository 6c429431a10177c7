"""Graph operators on edge tables (a, b)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def directed(edges: DataFrame) -> DataFrame:
    """Both directions of each edge."""
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def degrees(edges: DataFrame) -> DataFrame:
    return directed(edges).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("degree"))


def max_degree(edges: DataFrame) -> DataFrame:
    """One row: degree, the largest of any node; 0 without edges."""
    return degrees(edges).agg(F.coalesce(F.max("degree"), F.lit(0)).alias("degree"))


def cut(frame: DataFrame) -> DataFrame:
    """Cuts the lineage by a checkpoint in the cluster's shared folder."""
    context = frame.sparkSession.sparkContext
    if not context.getConf().get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None:
        local = context.getConf().get("spark.master", "").startswith("local")
        context.setCheckpointDir("file:///tmp/checkpoints" if local else frame.sparkSession.conf.get("spark.sql.warehouse.dir"))
    return frame.checkpoint()


def connected_components(edges: DataFrame, cut=cut) -> DataFrame:
    """node, component (smallest node): point nodes at their smallest neighbour, follow the pointers to
    their ends by doubling, rename the edges, and repeat until none is left.

    Every round at least halves the nodes of each component, also along chains.  Loops, repeated edges and nulls
    are ignored; no edges give no rows.  `cut` says how intermediate tables are kept; nothing is collected.
    """
    rest = cut(edges.where("a <> b").select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b")).distinct())
    names = None
    while not rest.isEmpty():
        hook = directed(rest).groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component"))
        hook = cut(hook)
        while True:
            step = hook.select(F.col("node").alias("component"), F.col("component").alias("next"))
            further = cut(hook.join(step, "component").select("node", F.col("component").alias("before"), F.col("next").alias("component")))
            if further.where("component <> before").isEmpty():
                break
            hook = further.drop("before")
        if names is None:
            names = hook
        else:
            step = hook.select(F.col("node").alias("component"), F.col("component").alias("next"))
            names = cut(names.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component")))
        ends = rest.join(hook.select(F.col("node").alias("a"), F.col("component").alias("x")), "a").join(hook.select(F.col("node").alias("b"), F.col("component").alias("y")), "b")
        rest = cut(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return names if names is not None else edges.sparkSession.createDataFrame([], "node long, component long")
