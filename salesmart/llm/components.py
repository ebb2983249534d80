"""Distributed union-find: connected components of a table of links by hooking, pointer jumping and contraction.

Every step is a join or a grouped minimum over staged tables, so a hub with many links is combined map-side or split;
nothing is collected. A round halves the number of roots that still have links at least, so rounds are logarithmic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import release, stage, staged_so_far


def _to_roots(up: DataFrame) -> DataFrame:
    """Pointers (node, up) to smaller nodes, followed to the end."""
    while True:
        above = up.select(F.col("node").alias("up"), F.col("up").alias("further"))
        if up.join(above, "up", "left_semi").isEmpty():
            return up
        up = stage(up.join(above, "up", "left").select("node", F.coalesce("further", "up").alias("up")), "up")


def components(links: DataFrame) -> DataFrame:
    """links: columns a, b (not null; loops and repeated links do no harm). Returns (node, label): every node with a
    link, and the smallest node of its component; also for an empty table."""
    spark, since = links.sparkSession, staged_so_far()
    both = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stage(both.distinct(), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("label"))
    while not edges.isEmpty():
        up = _to_roots(stage(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "hooks"))
        labels = labels.join(up.select(F.col("node").alias("label"), "up"), "label", "left")
        labels = stage(labels.select("node", F.coalesce("up", "label").alias("label")), "labels")
        for end in ("a", "b"):
            edges = edges.join(up.select(F.col("node").alias(end), "up"), end, "left") \
                .withColumn(end, F.coalesce("up", end)).drop("up")
        edges = stage(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .distinct(), "edges")
        release(spark, since, keep=2)  # the labels and the contracted edges
    return labels
