"""Connected components of links, by contraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factview.llm.common import checked


#: Steps that take nodes by number, which ends most graphs of near copies; later ones are random in turn.
BY_NUMBER = 4


def _place(step: int) -> Callable[[Column], Column]:
    """A node's place in the order of a step."""
    return (lambda c: F.xxhash64(c, F.lit(step))) if step >= BY_NUMBER and step % 2 else (lambda c: c)


def connected(edges: DataFrame) -> DataFrame:
    """(node, comp) for each end of an edge (a, b); comp is the smallest node of its component.

    Each step moves every node to its neighbour that comes first in an order
    and keeps the edges between different nodes that then remain. The first
    orders are by number: stars around their smallest node vanish at once.
    Then every second one is random, so that chains of any labelling halve. Steps are checkpointed; no more than whether edges are left reaches
    the driver. Nulls and loops are ignored; no edges give no rows.
    """
    left = checked(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps: list[DataFrame] = []
    while not left.isEmpty():
        place = _place(len(steps))
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(place(F.col("b")).alias("h"), F.col("b"))).alias("m"))
        step = checked(first.select("node", F.when(F.col("m.h") < place(F.col("node")), F.col("m.b")).otherwise(F.col("node")).alias("comp")))
        steps.append(step)
        one = step.select(F.col("node").alias("a"), F.col("comp").alias("x"))
        two = step.select(F.col("node").alias("b"), F.col("comp").alias("y"))
        moved = left.join(one, "a").join(two, "b").where("x <> y")
        left = checked(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    labels = steps[0]
    for step in steps[1:]:
        further = step.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        labels = labels.join(further, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp"))
    labels = checked(labels) if len(steps) > 1 else labels
    if len(steps) <= BY_NUMBER:  # each component has then ended at its smallest node
        return labels
    smallest = labels.groupBy("comp").agg(F.min("node").alias("first"))
    return checked(labels.join(smallest, "comp").select("node", F.col("first").alias("comp")))


def merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``labels`` (node, comp) with the components that further edges join; each node not in it is its own."""
    if labels is None:
        return connected(edges)
    at = lambda end: labels.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
    lifted = edges.join(at("a"), "a", "left").join(at("b"), "b", "left")
    lifted = lifted.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    step = connected(lifted)
    moved = labels.join(step.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp", "left")
    moved = moved.select("node", F.coalesce("next", "comp").alias("comp"))
    return checked(moved.unionByName(step.join(labels.select("node"), "node", "left_anti")))
