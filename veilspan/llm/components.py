"""Connected components of a links table by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan.llm.common import discard, hot_limit, materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that a link touches; component is its smallest node.

    Each round takes the smallest label among a node and its neighbours and then
    jumps to the label's own label, which halves paths. Labels only fall, so the
    loop ends when none changes. Hubs are no hot keys: min() is combined before its
    shuffle, and the labels of nodes with very many links (HOT_SHARE at most) are
    broadcast to their links instead of shuffling the links to them. Every round is
    written to the shared folder, so a lost executor costs a round at most.
    """
    edges = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    edges = materialize(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    degrees = edges.groupBy(F.col("y").alias("node")).agg(F.count("*").alias("n"))
    hubs = materialize(degrees.where(F.col("n") > hot_limit(edges.count())).select("node"), "hubs")
    some = not hubs.isEmpty()
    labels = materialize(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("component")), "labels")
    plain = edges.join(F.broadcast(hubs), edges.y == hubs.node, "left_anti") if some else edges
    to_hubs = edges.join(F.broadcast(hubs), edges.y == hubs.node, "left_semi") if some else None
    while True:
        near = plain.join(labels, plain.y == labels.node).select("x", "component")
        if some:
            known = labels.join(F.broadcast(hubs), "node", "left_semi")
            near = near.unionByName(to_hubs.join(F.broadcast(known), to_hubs.y == known.node).select("x", "component"))
        near = near.groupBy("x").agg(F.min("component").alias("seen"))
        low = labels.join(near, labels.node == near.x, "left").select("node", F.col("component").alias("was"), F.least("component", "seen").alias("to"))
        low = materialize(low, "lower")
        out = materialize(_jumped(low, labels), "labels")
        discard(low)
        discard(labels)
        labels = out
        if out.where("was <> component").isEmpty():
            return labels.select("node", "component")


def _jumped(low: DataFrame, labels: DataFrame) -> DataFrame:
    """Every node with the label of its label; labels of very many nodes are broadcast to them."""
    jump = labels.select(F.col("node").alias("to"), F.col("component").alias("further"))
    held = low.groupBy("to").agg(F.count("*").alias("n"))
    hot = materialize(held.where(F.col("n") > hot_limit(low.count())).select("to").join(jump, "to"), "hot")
    out = low.join(F.broadcast(hot.select("to")), "to", "left_anti").join(jump, "to", "left") if not hot.isEmpty() else low.join(jump, "to", "left")
    if not hot.isEmpty():
        out = out.unionByName(low.join(F.broadcast(hot), "to"))
    return out.select("node", "was", F.least("to", "further").alias("component"))
