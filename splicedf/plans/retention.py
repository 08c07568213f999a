"""Queries of retained introns. Every seventh model has its exons joined two by two, so that some exons span introns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import evidence, graph, retention
from splicedf.plans.registry import query

JOINED = """mexon AS MATERIALIZED (SELECT tid, gid, chrom, strand, min(s) AS s, max(e) AS e FROM (SELECT *, CASE WHEN tid % 7 = 0 THEN row_number() OVER (PARTITION BY tid ORDER BY s) // 2 ELSE row_number() OVER (PARTITION BY tid ORDER BY s) END AS g FROM exon) GROUP BY tid, gid, chrom, strand, g),
mtx AS (SELECT tid, min(s) AS ts, max(e) AS te, sum(e - s + 1) AS cdna, min(gid) AS gid FROM mexon GROUP BY tid),
mcds AS (SELECT * FROM (SELECT x.tid, x.gid, x.strand, greatest(x.s, t.ts + 30 + x.tid % 20) AS s, least(x.e, t.te - 30 - x.tid % 25) AS e FROM mexon x JOIN mtx t USING (tid) WHERE x.tid % 4 <> 0) WHERE s <= e),
mspan AS (SELECT tid, min(s) AS low, max(e) AS high FROM mcds GROUP BY tid),
adj AS MATERIALIZED (SELECT DISTINCT gid, strand, a_s, e + 1 AS i_s, b_s - 1 AS i_e, a_s AS x, e AS a_e, b_s, b_e FROM (SELECT gid, strand, s AS a_s, e, lead(s) OVER w AS b_s, lead(e) OVER w AS b_e FROM mexon WINDOW w AS (PARTITION BY tid ORDER BY s)) WHERE b_s IS NOT NULL),
follow AS (SELECT DISTINCT a.gid, a.strand, a.i_s, a.i_e, b.i_s AS j_s, b.i_e AS j_e FROM adj a JOIN adj b ON a.gid = b.gid AND a.strand = b.strand AND a.b_s = b.a_s AND a.b_e = b.a_e),
reach AS MATERIALIZED (WITH RECURSIVE r AS (SELECT DISTINCT gid, strand, i_s, i_e, i_s AS j_s, i_e AS j_e FROM adj UNION SELECT r.gid, r.strand, r.i_s, r.i_e, f.j_s, f.j_e FROM r JOIN follow f ON r.gid = f.gid AND r.strand = f.strand AND r.j_s = f.i_s AND r.j_e = f.i_e) SELECT * FROM r),
lefts AS (SELECT DISTINCT a.gid, a.strand, a.a_s AS at, r.j_s AS i_s, r.j_e AS i_e FROM adj a JOIN reach r ON a.gid = r.gid AND a.strand = r.strand AND a.i_s = r.i_s AND a.i_e = r.i_e),
rights AS (SELECT DISTINCT a.gid, a.strand, a.b_e AS at, r.i_s, r.i_e FROM adj a JOIN reach r ON a.gid = r.gid AND a.strand = r.strand AND a.i_s = r.j_s AND a.i_e = r.j_e),
inner0 AS (SELECT tid, gid, strand, e + 1 AS s, lead(s) OVER (PARTITION BY tid ORDER BY s) - 1 AS e FROM mcds),
inners AS (SELECT DISTINCT c.gid, c.strand, c.s AS i_s, c.e AS i_e FROM inner0 c JOIN adj a ON a.gid = c.gid AND a.strand = c.strand AND a.i_s = c.s AND a.i_e = c.e),
x0 AS (SELECT x.tid, x.gid, x.strand, x.s, x.e, x.s = t.ts AS ol, x.e = t.te AS orr, p.low, p.high, c.s AS cs, c.e AS ce, coalesce(CASE WHEN x.strand = '-' THEN p.high < x.e ELSE p.low > x.s END, false) AS early FROM mexon x JOIN mtx t USING (tid) LEFT JOIN mspan p USING (tid) LEFT JOIN mcds c ON c.tid = x.tid AND c.s <= x.e AND c.e >= x.s),
x1 AS (SELECT * FROM x0 WHERE cs IS NULL OR cs > s OR ce < e OR ol OR orr),
frag AS (SELECT tid, s, e, s AS fs, e AS fe FROM x1 WHERE cs IS NULL AND early OR cs = s AND ce = e
  UNION ALL SELECT tid, s, e, CASE WHEN early OR strand = '-' THEN s ELSE cs - 1 END, CASE WHEN early OR strand = '-' THEN cs - 1 ELSE cs END FROM x1 WHERE cs > s
  UNION ALL SELECT tid, s, e, CASE WHEN early AND strand = '-' THEN ce + 1 ELSE ce END, CASE WHEN strand = '+' OR early THEN e ELSE ce + 1 END FROM x1 WHERE ce < e),
met AS (SELECT x.*, i.i_s, i.i_e FROM x1 x JOIN (SELECT DISTINCT gid, strand, i_s, i_e FROM adj) i ON x.gid = i.gid AND x.strand = i.strand AND i.i_s <= x.e AND i.i_e >= x.s AND (x.s < i.i_s - 1 OR x.e > i.i_e + 1)),
found AS (SELECT m.* FROM met m LEFT JOIN lefts l ON l.gid = m.gid AND l.strand = m.strand AND l.at = m.s AND l.i_s = m.i_s AND l.i_e = m.i_e LEFT JOIN rights r ON r.gid = m.gid AND r.strand = m.strand AND r.at = m.e AND r.i_s = m.i_s AND r.i_e = m.i_e WHERE (ol OR l.at IS NOT NULL) AND (orr OR r.at IS NOT NULL)),
hurt AS (SELECT DISTINCT f.tid, f.s, f.e FROM found f JOIN inners i ON i.gid = f.gid AND i.strand = f.strand AND i.i_s = f.i_s AND i.i_e = f.i_e JOIN frag g ON g.tid = f.tid AND g.s = f.s AND g.e = f.e WHERE f.low IS NOT NULL AND least(g.fe, f.i_e) - greatest(g.fs, f.i_s) > 0),
kept AS (SELECT DISTINCT f.tid, f.s, f.e, h.tid IS NOT NULL AS disrupts FROM found f LEFT JOIN hurt h ON h.tid = f.tid AND h.s = f.s AND h.e = f.e)"""


def joined(t) -> tuple[DataFrame, DataFrame]:
    """Exons and coding segments of the models, every seventh with its exons joined two by two."""
    n = F.row_number().over(Window.partitionBy("tid").orderBy("s"))
    g = F.when(F.col("tid") % 7 == 0, F.floor(n / 2)).otherwise(n)
    x = t.exon.withColumn("_g", g).groupBy("tid", "gid", "chrom", "strand", "is_ref", "source", "_g").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_g")
    # as projection.coding, but lines are filtered last: so exons and coding segments are made of the same shuffled lines
    w = Window.partitionBy("tid")
    c = x.withColumns({"ts": F.min("s").over(w), "te": F.max("e").over(w)}).selectExpr("tid", "gid", "chrom", "strand", "greatest(s, ts + 30 + tid % 20) AS s", "CASE WHEN tid % 4 <> 0 THEN least(e, te - 30 - tid % 25) END AS e")
    return x, c.filter("s <= e")


@query("SELECT tid, s, e FROM kept", JOINED)
def retained_introns(t) -> DataFrame:
    return retention.retained_introns(*joined(t), "gid").select("tid", "s", "e")


@query("SELECT tid, bool_or(disrupts) AS disrupted FROM kept GROUP BY tid", JOINED)
def cds_disrupted_by_ri(t) -> DataFrame:
    return retention.retained_introns(*joined(t), "gid").groupBy("tid").agg(F.bool_or("disrupts").alias("disrupted"))


@query("SELECT t.tid, count(k.s) AS retained_intron_num, CAST(coalesce(sum(k.e - k.s + 1), 0) AS DOUBLE) / min(t.cdna) AS retained_fraction, coalesce(bool_or(k.disrupts), false) AS cds_disrupted_by_ri FROM mtx t LEFT JOIN kept k USING (tid) GROUP BY t.tid", JOINED)
def metrics_retained(t) -> DataFrame:
    x, c = joined(t)
    return retention.metrics_retained(x, retention.retained_introns(x, c, "gid"))


@query()
def as_remove_retained(t) -> DataFrame:
    """Isoforms beside the longest model of each gene, without retained introns and what they disrupt; as it takes rounds,
    tests have it by brute force."""
    m = graph.stored(retention.models(*joined(t), "gid"))
    cdna = F.aggregate("xs", F.lit(0).cast("long"), lambda n, x: n + x.e - x.s + 1)
    first = evidence.choose_best(m.select("tid", "locus", cdna.alias("cdna")), ["locus"], "cdna")
    return retention.remove_retained(m, first, keep_retained=False)
