"""Two loops over edge tables: connected components, and the greedy maximal independent set. Rounds are checkpointed."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 60
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names; where a session in one JVM names none, one of its own."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or _own.get(sc.applicationId)
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = _own[sc.applicationId] = tempfile.mkdtemp(prefix="spark-splicedf-", dir="/tmp")
    return found.rstrip("/")


def _cut(df: DataFrame) -> DataFrame:
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder, which columns and packing make some times smaller than a checkpoint."""
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _roots(step: DataFrame) -> DataFrame:
    """(node, to) with to followed to its end; to is never above node. Each look doubles the way, so looks are few."""
    for _ in range(ROUNDS):
        on = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        step = stored(step.join(on, "to").select("node", F.col("next").alias("to"), (F.col("next") < F.col("to")).alias("moved")))
        if step.filter("moved").isEmpty():
            return step.select("node", "to")
    raise RuntimeError("connected_components: not settled")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable; isolated nodes are their own component.

    A round leads every node to the smallest of its neighbours, that one to its own, until none is smaller, and leaves of
    the graph the edges between these ends. Two rounds at least halve it, so later ones cost little.
    """
    e, levels = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), []
    for _ in range(ROUNDS):
        e = stored(e.distinct())
        if e.isEmpty():
            break
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = _roots(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("to")))
        levels.append(to)
        x, y = (to.select(F.col("node").alias(k), F.col("to").alias(f"to_{k}")) for k in "ab")
        d = e.join(x, "a").join(y, "b").filter("to_a <> to_b")
        e = d.select(F.greatest("to_a", "to_b").alias("a"), F.least("to_a", "to_b").alias("b"))
    else:
        raise RuntimeError("connected_components: not settled")
    comp = None
    for to in reversed(levels):
        on = comp if comp is None else comp.select(F.col("node").alias("to"), F.col("to").alias("end"))
        comp = to if on is None else to.join(on, "to", "left").select("node", F.coalesce("end", "to").alias("to"))
    labels = nodes.select("node").distinct()
    return labels.withColumn("comp", F.col("node")) if comp is None else labels.join(comp, "node", "left").select("node", F.coalesce("to", "node").alias("comp"))


def greedy_mis(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The nodes (node, priority) that a pass in order of (priority desc, node asc) keeps, dropping neighbours of kept ones.

    A round keeps every node that outranks all its remaining neighbours and drops their neighbours; that yields the same
    set as the pass, in as many rounds as the longest descending path, not as many as nodes. An edge is held once, from
    the lower node to the one that outranks it.
    """
    x, y = (nodes.select(F.col("node").alias(k), F.struct((-F.col("priority")).alias("p"), F.col("node").alias("n")).alias(f"r_{k}")) for k in "ab")
    ranked = edges.select("a", "b").join(x, "a").join(y, "b").filter("r_a <> r_b")
    below = F.col("r_a") > F.col("r_b")
    e = stored(ranked.select(F.when(below, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(below, F.col("b")).otherwise(F.col("a")).alias("b")))
    left, kept = nodes.select("node").distinct(), None
    for _ in range(ROUNDS):
        left = stored(left)
        if left.isEmpty():
            return left if kept is None else kept
        win = stored(left.join(e.select(F.col("a").alias("node")), "node", "left_anti"))
        kept = win if kept is None else kept.unionAll(win)
        gone = e.join(win.withColumnRenamed("node", "b"), "b", "left_semi").select(F.col("a").alias("node")).unionAll(win)
        left = left.join(gone, "node", "left_anti")
        e = stored(e.join(gone.withColumnRenamed("node", "a"), "a", "left_anti").join(gone.withColumnRenamed("node", "b"), "b", "left_anti"))
    raise RuntimeError("greedy_mis: not settled")
