"""Queries that select models: requirements, coding requirements, the best of each sublocus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.operators import evidence, graph, intervals, loci
from splicedf.plans.evaluation import VERIFIED, verified
from splicedf.plans.loci import mis
from splicedf.plans.models import isl
from splicedf.plans.registry import query


@query("SELECT t.tid, CASE WHEN coalesce(l.k, 0) = 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(o.n, 0) / CAST(l.k AS DOUBLE) END AS proportion FROM transcript t LEFT JOIN (SELECT tid, count(*) AS n FROM checked WHERE verified GROUP BY 1) o ON t.tid = o.tid LEFT JOIN (SELECT gid, count(*) AS k FROM (SELECT DISTINCT gid, s, e FROM checked WHERE verified) GROUP BY 1) l ON t.gid = l.gid", VERIFIED)
def metrics_locus_verified(t) -> DataFrame:
    good = verified(t).filter("verified")
    own = good.groupBy("tid").agg(F.count(F.lit(1)).alias("n"))
    locus = good.select("gid", "s", "e").distinct().groupBy("gid").agg(F.count(F.lit(1)).alias("k"))
    d = t.transcript.select("tid", "gid").join(own, "tid", "left").join(locus, "gid", "left").na.fill(0, ["n", "k"])
    return d.select("tid", F.when(F.col("k") == 0, 1.0).otherwise(F.col("n") / F.col("k")).alias("proportion"))


@query("SELECT c.tid, c.s, c.e FROM cds c JOIN transcript t ON c.tid = t.tid WHERE t.n_exons >= 2 AND t.cdna >= 300")
def cds_requirements(t) -> DataFrame:
    """Models that fail the section lose their coding segments; they stay as models."""
    section = {"parameters": {"n_exons": {"operator": "ge", "value": 2}, "cdna": {"operator": "ge", "value": 300}}}
    good = t.transcript.filter(evidence.requirement(section)).select("tid")
    return t.cds.join(good, "tid", "left_semi").select("tid", "s", "e")


@query("SELECT o_orderkey AS tid FROM orders WHERE (CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_totalprice AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) / CAST(100 AS DOUBLE) > 1000 AND coalesce(CAST(NULL AS DOUBLE), CAST(5 AS DOUBLE)) >= 5")
def requirement_attribute(t) -> DataFrame:
    """Attributes are text; each use names its type, what stands for a missing one, and whether it is in percent."""
    o = t.spark.read.parquet(f"{t.sf_dir}/orders.parquet")
    tpm = F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice").cast("string"))
    d = o.select(F.col("o_orderkey").alias("tid"), F.create_map(F.lit("tpm"), tpm).alias("attributes"))
    return d.filter((evidence.attribute("tpm", 0.0, percentage=True) > 1000) & (evidence.attribute("cov", 5.0) >= 5)).select("tid")


SUBLOCI = "mono AS (SELECT * FROM transcript WHERE n_exons = 1), " + isl("mono", "chrom, strand", "s - top < 1") + ", share AS (SELECT DISTINCT a.tid AS a, b.tid AS b FROM intron a JOIN intron b ON a.chrom = b.chrom AND a.strand = b.strand AND a.s = b.s AND a.e = b.e), step2 AS (SELECT DISTINCT x.a, y.b FROM share x JOIN share y ON x.b = y.a), step4 AS (SELECT DISTINCT x.a, y.b FROM step2 x JOIN step2 y ON x.b = y.a), step8 AS (SELECT DISTINCT x.a, y.b FROM step4 x JOIN step4 y ON x.b = y.a), reach AS (SELECT DISTINCT x.a, y.b FROM step8 x JOIN step8 y ON x.b = y.a), sub AS MATERIALIZED (SELECT a AS tid, min(b) AS sublocus FROM reach GROUP BY a UNION ALL SELECT tid, min(tid) OVER (PARTITION BY chrom, strand, island) FROM isl)"


@query(" UNION ALL ".join(f"SELECT node AS tid FROM win{i}" for i in range(7)), SUBLOCI + ", " + mis("SELECT tid AS node, cdna AS p FROM transcript JOIN sub USING (tid)", "SELECT a.tid AS a, b.tid AS b FROM transcript a JOIN sub x ON a.tid = x.tid JOIN sub y ON x.sublocus = y.sublocus JOIN transcript b ON b.tid = y.tid WHERE a.tid <> b.tid AND a.s <= b.e AND b.s <= a.e", 7))
def monosubloci(t) -> DataFrame:
    """The best models of each sublocus that do not overlap, by spliced length."""
    d = t.transcript.join(loci.subloci(t.transcript, t.intron), "tid").select("sublocus", "tid", "s", "e", "cdna")
    pair = intervals.join_overlap(d.drop("cdna"), d.drop("cdna"), ("sublocus",)).filter("tid_a < tid_b")
    return graph.greedy_mis(d.select(F.col("tid").alias("node"), F.col("cdna").alias("priority")), pair.select(F.col("tid_a").alias("a"), F.col("tid_b").alias("b"))).withColumnRenamed("node", "tid")
