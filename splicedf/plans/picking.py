"""Queries of the steps between comparison and choice; the SQL counts introns and bases of each pair instead of borders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import compare, evidence, picking, sequence
from splicedf.plans.comparison import pair_sql, sides
from splicedf.plans.loci import INTRON_ENDS, ORF, hinted, orfs
from splicedf.plans.models import SPAN, isl
from splicedf.plans.registry import query

WITHIN = """near AS (SELECT a.tid AS tid_a, b.tid AS tid_b, a.is_ref AS ref_a, b.is_ref AS ref_b, a.cdna AS bases, a.n_exons - 1 AS n FROM transcript a JOIN transcript b ON a.chrom = b.chrom AND a.strand = b.strand AND a.s >= b.s AND a.e <= b.e AND a.tid <> b.tid),
shared AS (SELECT p.tid_a, p.tid_b, sum(greatest(0, least(x.e, y.e) - greatest(x.s, y.s) + 1)) AS bases FROM near p JOIN exon x ON x.tid = p.tid_a JOIN exon y ON y.tid = p.tid_b GROUP BY 1, 2),
common AS (SELECT p.tid_a, p.tid_b, count(*) AS n FROM near p JOIN intron x ON x.tid = p.tid_a JOIN intron y ON y.tid = p.tid_b AND x.s = y.s AND x.e = y.e GROUP BY 1, 2),
inside AS MATERIALIZED (SELECT p.* FROM near p JOIN shared x USING (tid_a, tid_b) LEFT JOIN common c USING (tid_a, tid_b) WHERE x.bases = p.bases AND coalesce(c.n, 0) = p.n),
gone AS (SELECT i.tid_a FROM inside i LEFT JOIN inside o ON o.tid_a = i.tid_b AND o.tid_b = i.tid_a WHERE NOT i.ref_a AND (i.ref_b OR i.tid_b < i.tid_a OR o.tid_a IS NULL))"""


@query("SELECT tid FROM transcript WHERE tid NOT IN (SELECT tid_a FROM gone)", WITHIN)
def reduce_contained(t) -> DataFrame:
    return picking.reduce_contained(t.transcript, t.exon)


FIRST = "prim AS (SELECT tid FROM (SELECT tid, row_number() OVER (PARTITION BY gid ORDER BY cdna DESC, tid) AS k FROM transcript) WHERE k = 1)"
SOLID = {"parameters": {"n_exons": {"operator": "ge", "value": 3}, "cdna": {"operator": "ge", "value": 500}}}


@query("SELECT tid_a AS tid, tid_b AS fragment_of, ccode AS code, distance FROM (SELECT *, row_number() OVER (PARTITION BY tid_a ORDER BY distance, n_f1 DESC, tid_b) AS k FROM coded WHERE ccode IN ('p', 'P', 'x', 'X', 'i', 'm', '_', 'e', 'o')) WHERE k = 1",
       FIRST + ", " + pair_sql(2000, "tid IN (SELECT tid FROM prim) AND NOT (n_exons >= 3 AND cdna >= 500)", "tid IN (SELECT tid FROM prim) AND n_exons >= 3 AND cdna >= 500"))
def fragments(t) -> DataFrame:
    """The longest model of each gene stands for its locus; those that fail the section are putative fragments."""
    w = Window.partitionBy("gid").orderBy(F.desc("cdna"), "tid")
    first = t.transcript.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")
    ok = evidence.requirement(SOLID)
    side = lambda d: (d, *[x.join(d.select("tid"), "tid", "left_semi") for x in (t.exon, t.intron)])
    return picking.fragments(compare.compare_pairs(side(first.filter(~ok)), side(first.filter(ok)), distance=2000))


def best_pair(key: str, level: str) -> str:
    order = "CASE WHEN top > 0 THEN 0 ELSE distance END, ccode IN ('x', 'X', 'P', 'p'), j_f1 DESC, e_f1 DESC, n_f1 DESC, tid_a, tid_b"
    return f"SELECT '{level}' AS level, {key} AS key, tid_a, tid_b, ccode FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS k FROM (SELECT c.*, g.gid, max(greatest(j_f1, e_f1, n_f1)) OVER (PARTITION BY {key}) AS top FROM coded c JOIN transcript g ON g.tid = c.tid_b)) WHERE k = 1"


@query(best_pair("tid_b", "transcript") + " UNION ALL " + best_pair("gid", "gene"), pair_sql(2000))
def best_refmap(t) -> DataFrame:
    """Both levels choose among the pairs themselves."""
    p = compare.compare_pairs(*sides(t), distance=2000).join(t.transcript.select(F.col("tid").alias("tid_b"), "gid"), "tid_b")
    one, gene = picking.best_refmap(p, "tid_b"), picking.best_refmap(p, "gid")
    return one.select(F.lit("transcript").alias("level"), "*").unionByName(gene.select(F.lit("gene").alias("level"), "*"))


STOPS = SPAN + """, stop AS (SELECT x.tid, greatest(x.s, CASE WHEN x.strand = '-' THEN p.cs - 3 ELSE p.ce + 1 END) AS s, least(x.e, CASE WHEN x.strand = '-' THEN p.cs - 1 ELSE p.ce + 3 END) AS e FROM exon x JOIN span p ON x.tid = p.tid WHERE x.tid % 2 = 0),
segment AS (SELECT tid, s, e FROM cds UNION ALL SELECT tid, s, e FROM stop WHERE s <= e), """ + isl("segment", "tid", "s <= top + 1")


@query("SELECT tid, min(s) AS s, max(e) AS e FROM isl GROUP BY tid, island", STOPS)
def stop_codon_fix(t) -> DataFrame:
    """Models of even number carry their stop codon beside the coding part."""
    span = t.cds.groupBy("tid").agg(F.min("s").alias("cs"), F.max("e").alias("ce"))
    d = t.exon.filter("tid % 2 = 0").join(span, "tid")
    stop = d.selectExpr("tid", "greatest(s, if(strand = '-', cs - 3, ce + 1)) AS s", "least(e, if(strand = '-', cs - 1, ce + 3)) AS e").filter("s <= e")
    return picking.stop_codon_fix(t.cds, stop)


@query("""SELECT t.tid, CASE WHEN n_exons > 1 THEN CAST(coalesce(own, 0) AS DOUBLE) / (n_exons - 1) ELSE CAST(0 AS DOUBLE) END AS canonical_intron_proportion, n_exons > 1 AND coalesce(other, 0) > 0 AS suspicious_splicing, n_exons > 1 AND coalesce(own, 0) = 0 AS only_non_canonical_splicing
  FROM transcript t LEFT JOIN (SELECT tid, count(CASE WHEN hint = strand THEN 1 END) AS own, count(CASE WHEN hint <> strand THEN 1 END) AS other FROM hinted GROUP BY tid) h ON t.tid = h.tid""", INTRON_ENDS)
def metrics_splicing(t) -> DataFrame:
    return picking.splicing_metrics(t.transcript, sequence.strand_check(hinted(t)))


PLACED = ORF + """, place AS (SELECT tid, e - s + 1 AS n, coalesce(sum(e - s + 1) OVER (PARTITION BY tid ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM exon),
parts AS (SELECT g.tid, g.s, g.e, g.n, g.k, count(*) AS num FROM good g JOIN place p ON p.tid = g.tid AND g.s <= p.before + p.n AND g.e > p.before GROUP BY 1, 2, 3, 4, 5),
most AS (SELECT tid, max(num) AS num FROM parts GROUP BY tid)"""


@query("""SELECT t.tid, coalesce(p.n, 0) AS selected_cds_length, coalesce(p.num, 0) AS selected_cds_num, CAST(coalesce(p.n, 0) AS DOUBLE) / t.cdna AS selected_cds_fraction, CAST(coalesce(p.num, 0) AS DOUBLE) / t.n_exons AS selected_cds_number_fraction,
  coalesce(m.num, 0) AS highest_cds_exon_number, CAST(coalesce(m.num, 0) AS DOUBLE) / t.n_exons AS selected_cds_exons_fraction, coalesce((t.tid + p.s) % 2 = 0, false) AS has_start_codon, coalesce((t.tid + p.e) % 3 <> 1, false) AS has_stop_codon,
  coalesce((t.tid + p.s) % 2 = 0 AND (t.tid + p.e) % 3 <> 1, false) AS is_complete FROM transcript t LEFT JOIN parts p ON t.tid = p.tid AND p.k = 1 LEFT JOIN most m ON t.tid = m.tid""", PLACED)
def metrics_cds_selected(t) -> DataFrame:
    d = orfs(t).withColumns({"has_start": F.expr("(tid + s) % 2 = 0"), "has_stop": F.expr("(tid + e) % 3 <> 1")})
    return picking.selected_metrics(t.exon, d)


@query()
def as_redundant(t) -> DataFrame:
    """Models of a gene beside its longest, without those that repeat a longer one that stays."""
    w = Window.partitionBy("gid").orderBy(F.desc("cdna"), "tid")
    rest = t.transcript.withColumn("_k", F.row_number().over(w)).filter("_k > 1").drop("_k")
    side = (rest, *[x.join(rest.select("tid"), "tid", "left_semi") for x in (t.exon, t.intron)])
    return picking.as_redundant(rest.select("tid", F.col("gid").alias("locus"), F.col("cdna").alias("score")), compare.compare_pairs(side, side))
