"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import hand_over


def components(edges: DataFrame) -> DataFrame:
    """(v, component) for every end of ``edges`` (a, b): the least vertex that v reaches.

    Every round gives a vertex the least label among its neighbours and then the label of that
    label, so the rounds grow with the logarithm of the longest way. A round's labels are
    written to the shared folder; only one count per round comes to the driver. Sums per vertex
    are combined before the shuffle, and joins on a vertex of many edges can be split.
    """
    both = hand_over(
        edges.select("a", "b")
        .unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b")
        .distinct(),
        "edges",
    )
    labels = hand_over(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("l")).withColumnRenamed("a", "v"),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("b"), "l"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("l").alias("m"))
        )
        least = labels.join(near, "v").select(
            "v", F.col("l").alias("was"), F.least("l", "m").alias("l")
        )
        step = labels.select(F.col("v").alias("l"), F.col("l").alias("further"))
        new = hand_over(
            least.join(step, "l").select("v", "was", F.least("l", "further").alias("l")), "labels"
        )
        labels = new.select("v", "l")
        if new.where("l <> was").isEmpty():
            return labels.select("v", F.col("l").alias("component"))
