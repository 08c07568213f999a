"""Connected components over an edge table, by contraction: every node steps to its smallest neighbour, edges follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.llm.common import Scratch

#: Rounds, each of which at least halves the nodes that have edges; more raise rather than give a partial answer.
ROUNDS = 60


def settled(step: DataFrame, work: Scratch) -> DataFrame:
    """(node, up) followed to its end: up is a node that steps to itself. Each jump doubles the way."""
    for _ in range(ROUNDS):
        nxt = step.join(step.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("up").alias("was"), F.col("top").alias("up"))
        nxt = work.written(nxt, "cc-steps")
        work.drop("cc-steps", keep=1)
        step = nxt.select("node", "up")
        if nxt.filter("was <> up").isEmpty():
            return step
    raise RuntimeError("components: not settled")


def components(edges: DataFrame, work: Scratch) -> DataFrame:
    """(node, comp) for every node of edges (a, b): comp is the smallest node that it can reach.

    A round takes each node's smallest neighbour, by an aggregate that sums up before the shuffle, and moves the edges to
    where their ends went; equal ones merge and loops go, so later rounds have few rows. Every round is written to the
    shared folder: a lost executor costs one round at most.
    """
    e = work.written(edges.select("a", "b").unionAll(edges.select("b", "a")).filter("a <> b").distinct(), "cc-edges")
    labels = None
    for _ in range(ROUNDS):
        step = work.written(e.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("up")), "cc-steps")
        step = settled(step, work)
        if labels is None:
            labels = work.written(step.withColumnRenamed("up", "comp"), "cc-labels")
        else:
            s = step.select(F.col("node").alias("comp"), "up")
            labels = work.written(labels.join(s, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "cc-labels")
        to = lambda c: step.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up"))
        e = work.written(e.join(to("a"), "a").join(to("b"), "b").filter("a_up <> b_up").select(F.col("a_up").alias("a"), F.col("b_up").alias("b")).distinct(), "cc-edges")
        work.drop("cc-edges", "cc-labels", keep=1)
        if e.isEmpty():
            work.drop("cc-edges", "cc-steps")
            return labels
    raise RuntimeError("components: not settled")
