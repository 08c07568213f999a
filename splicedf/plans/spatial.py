"""Queries over intervals: joins, clusters, neighbours, loci."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import graph, intervals, model
from splicedf.plans.models import SITE, isl
from splicedf.plans.registry import query

PAIR = "SELECT a.tid AS tid_a, b.tid AS tid_b, a.chrom, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS overlap"
PRED, REF = "(SELECT * FROM transcript WHERE NOT is_ref)", "(SELECT * FROM transcript WHERE is_ref)"


def sides(t):
    x = t.transcript.select("chrom", "tid", "s", "e", "is_ref")
    return x.filter("NOT is_ref").drop("is_ref"), x.filter("is_ref").drop("is_ref")


@query(f"{PAIR} FROM {PRED} a JOIN {REF} b ON a.chrom = b.chrom AND a.s <= b.e AND b.s <= a.e")
def join_overlap(t) -> DataFrame:
    return intervals.join_overlap(*sides(t)).select("tid_a", "tid_b", "chrom", "overlap")


@query(f"SELECT a.tid AS tid_a, b.tid AS tid_b, greatest(0, greatest(a.s, b.s) - least(a.e, b.e)) AS distance FROM {PRED} a JOIN {REF} b ON a.chrom = b.chrom AND greatest(a.s, b.s) - least(a.e, b.e) <= 500")
def join_within_distance(t) -> DataFrame:
    return intervals.join_within_distance(*sides(t), distance=500).select("tid_a", "tid_b", "distance")


@query(f"SELECT a.tid AS tid_a, b.tid AS tid_b FROM {PRED} a JOIN {REF} b ON a.chrom = b.chrom AND a.s >= b.s AND a.e <= b.e")
def join_contained(t) -> DataFrame:
    return intervals.join_contained(*sides(t)).select("tid_a", "tid_b")


def nearest(up: bool) -> str:
    gap = "a.s - b.e" if up else "b.s - a.e"
    return f"SELECT gid_a, gid_b, distance FROM (SELECT a.gid AS gid_a, b.gid AS gid_b, {gap} AS distance, row_number() OVER (PARTITION BY a.gid ORDER BY {gap}, b.s, b.e, b.gid) AS nth FROM gene a JOIN gene b ON a.chrom = b.chrom AND {gap} BETWEEN 1 AND 2500) WHERE nth <= 2"


@query(nearest(True))
def join_nearest_upstream(t) -> DataFrame:
    g = t.gene.select("chrom", "gid", "s", "e")
    return intervals.join_nearest(g, g, True, 2).select("gid_a", "gid_b", "distance")


@query(nearest(False))
def join_nearest_downstream(t) -> DataFrame:
    g = t.gene.select("chrom", "gid", "s", "e")
    return intervals.join_nearest(g, g, False, 2).select("gid_a", "gid_b", "distance")


@query("""SELECT gid, chrom, prev_gid, greatest(0, s - pe) AS prev_distance, next_gid, greatest(0, ns - e) AS next_distance FROM
  (SELECT *, max(e) OVER w1 AS pe, (max(struct_pack(e := e, g := gid)) OVER w1).g AS prev_gid, lead(gid) OVER w2 AS next_gid, lead(s) OVER w2 AS ns FROM gene
   WINDOW w1 AS (PARTITION BY chrom ORDER BY s, e, gid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), w2 AS (PARTITION BY chrom ORDER BY s, e, gid))""")
def gene_flank_distances(t) -> DataFrame:
    d = intervals.gene_flank_distances(t.gene)  # greatest() skips nulls in both engines; a missing neighbour is 0 away
    return d


@query("SELECT chrom, gid, distance FROM (SELECT chrom, gid, lead(s) OVER (PARTITION BY chrom ORDER BY s, e, gid) - e AS distance FROM gene) WHERE distance IS NOT NULL")
def intergenic_distances(t) -> DataFrame:
    return intervals.intergenic_distances(t.gene)


@query("SELECT tid, chrom, CAST(island AS BIGINT) AS cluster FROM isl", isl("transcript", "chrom", "s - top < 400"))
def gap_cluster(t) -> DataFrame:
    return intervals.gap_cluster(t.transcript, ["chrom"], 400).select("tid", "chrom", "cluster")


@query("SELECT chrom, CAST(island AS BIGINT) AS superlocus, min(s) AS s, max(e) AS e, count(*) AS n FROM isl GROUP BY chrom, island", isl("transcript", "chrom", "s - top < 400"))
def superloci(t) -> DataFrame:
    d = intervals.gap_cluster(t.transcript, ["chrom"], 400)
    return d.groupBy("chrom", F.col("cluster").alias("superlocus")).agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count(F.lit(1)).alias("n"))


@query("SELECT tid, chrom, strand, CAST(island AS BIGINT) AS superlocus FROM isl", isl("transcript", "chrom, strand", "s - top < 400"))
def superloci_stranded(t) -> DataFrame:
    return intervals.gap_cluster(t.transcript, ["chrom", "strand"], 400).select("tid", "chrom", "strand", F.col("cluster").alias("superlocus"))


@query("SELECT gid, CAST(sum(greatest(0, e - greatest(s - 1, coalesce(top, s - 1)))) AS BIGINT) AS bases FROM isl0 GROUP BY gid", isl("exon", "gid", "true"))
def interval_union_length(t) -> DataFrame:
    return intervals.interval_union_length(t.exon, ["gid"])


@query("SELECT a.tid AS tid_a, b.tid AS tid_b, count(*) AS n FROM intron a JOIN intron b ON a.chrom = b.chrom AND a.strand = b.strand AND a.s = b.s AND a.e = b.e AND a.tid < b.tid GROUP BY 1, 2")
def join_shared_intron(t) -> DataFrame:
    a, b = (t.intron.select("chrom", "strand", "s", "e", F.col("tid").alias(f"tid_{k}")) for k in "ab")
    return a.join(b, ["chrom", "strand", "s", "e"]).filter("tid_a < tid_b").groupBy("tid_a", "tid_b").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT a.tid AS tid_a, b.tid AS tid_b, count(*) AS n FROM site a JOIN site b ON a.chrom = b.chrom AND a.strand = b.strand AND a.pos = b.pos AND a.kind = b.kind AND a.tid < b.tid GROUP BY 1, 2", SITE)
def join_shared_splice(t) -> DataFrame:
    a, b = (model.splice_sites(t.intron).withColumnRenamed("tid", f"tid_{k}") for k in "ab")
    return a.join(b, ["chrom", "strand", "pos", "kind"]).filter("tid_a < tid_b").groupBy("tid_a", "tid_b").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT a.tid AS tid_a, a.pos AS pos_a, min(abs(a.pos - b.pos)) AS distance FROM site a JOIN site b ON a.chrom = b.chrom AND a.strand = b.strand AND a.kind = b.kind AND abs(a.pos - b.pos) <= 20
  WHERE a.tid % 3 <> 0 AND b.tid % 3 = 0 GROUP BY 1, 2, a.kind""", SITE)
def join_fuzzy_junction(t) -> DataFrame:
    x = model.splice_sites(t.intron).select("chrom", "strand", "kind", "tid", F.col("pos").alias("s"), F.col("pos").alias("e"))
    d = intervals.join_overlap(x.filter("tid % 3 <> 0"), x.filter("tid % 3 = 0"), ("chrom", "strand", "kind"), width=64, slack=20)
    return d.groupBy("tid_a", F.col("s_a").alias("pos_a"), "kind").agg(F.min(F.abs(F.col("s_a") - F.col("s_b"))).alias("distance")).drop("kind")


@query("""SELECT n.node, min(least(n.node, coalesce(r.b, n.node))) AS comp FROM (SELECT DISTINCT gid AS node FROM gene) n LEFT JOIN reach r ON n.node = r.a GROUP BY n.node""",
       isl("gene", "chrom", "s <= top") + ", reach AS (SELECT gid AS a, min(gid) OVER (PARTITION BY chrom, island) AS b FROM isl)")
def connected_components(t) -> DataFrame:
    """Overlapping genes of a chromosome are linked."""
    g = t.gene.select("chrom", "gid", "s", "e")
    e = intervals.join_overlap(g, g).filter("gid_a < gid_b").select(F.col("gid_a").alias("a"), F.col("gid_b").alias("b"))
    return graph.connected_components(g.select(F.col("gid").alias("node")), e)


@query()
def select_best_nonoverlapping(t) -> DataFrame:
    """The choice among all transcripts, in as many rounds as it takes; tests have it by brute force."""
    x = t.transcript.select("chrom", "strand", "tid", "s", "e", "cdna")
    e = intervals.join_overlap(x, x, ("chrom", "strand")).filter("tid_a < tid_b").select(F.col("tid_a").alias("a"), F.col("tid_b").alias("b"))
    return graph.greedy_mis(x.select(F.col("tid").alias("node"), F.col("cdna").alias("priority")), e)


@query("SELECT tid, chrom, strand, prefix || '.' || chrom || 'G' || CAST(n AS VARCHAR) AS final_id FROM (SELECT tid, chrom, strand, 'locus' AS prefix, row_number() OVER (PARTITION BY chrom ORDER BY s, e, tid) AS n FROM transcript)")
def locus_gene_numbering(t) -> DataFrame:
    """All models, numbered along their chromosomes."""
    d = model.numbered(t.transcript.select("tid", "chrom", "strand", "s", "e"), ["chrom"], "e", "tid")
    return d.select("tid", "chrom", "strand", F.concat(F.lit("locus."), "chrom", F.lit("G"), F.col("n").cast("string")).alias("final_id"))


@query("SELECT a.tid AS tid_a, b.tid AS tid_b, a.gid FROM transcript a JOIN transcript b ON a.gid = b.gid AND a.tid < b.tid AND a.s <= b.e AND b.s <= a.e")
def pair_graph(t) -> DataFrame:
    x = t.transcript.select("gid", "tid", "s", "e")
    return intervals.join_overlap(x, x, ("gid",)).filter("tid_a < tid_b").select("tid_a", "tid_b", "gid")


@query("SELECT tid, s, e FROM m a WHERE is_ref OR NOT EXISTS (SELECT 1 FROM m b WHERE b.chrom = a.chrom AND b.strand = a.strand AND b.chain = a.chain AND b.s <= a.s AND b.e >= a.e AND (b.s < a.s OR b.e > a.e OR b.is_ref OR b.tid < a.tid))",
       "chain AS (SELECT tid, string_agg(s || '-' || e, ',' ORDER BY s) AS chain FROM intron GROUP BY tid), m AS (SELECT t.tid, t.chrom, t.strand, t.s, t.e, t.is_ref, c.chain FROM transcript t JOIN chain c ON t.tid = c.tid)")
def reduce_identical_chains(t) -> DataFrame:
    """Of models with one intron chain those go that lie within another one, or equal it; models of the reference stay."""
    c = model.intron_chain(t.intron).select("tid", "chain")
    w = Window.partitionBy("chrom", "strand", "chain").orderBy("s", F.desc("e"), F.desc("is_ref"), "tid").rowsBetween(Window.unboundedPreceding, -1)
    d = t.transcript.join(c, "tid").withColumn("top", F.max("e").over(w))
    return d.filter(F.col("is_ref") | F.col("top").isNull() | (F.col("top") < F.col("e"))).select("tid", "s", "e")
