"""Queries of the choice of models from end to end, and of reading frames on sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splicedf.operators import evidence, frames, loci as locus_steps, picking, sequence
from splicedf.plans.loci import CANDIDATES, CDNA, CODE, CODING, ORF, PRIMARY, dna, orfs, primaries
from splicedf.plans.models import isl
from splicedf.plans.registry import query

SHARED = {"parameters": {"exon_fraction": {"operator": "ge", "value": 0.3}, "n_exons": {"operator": "ge", "value": 2}}}


@query()
def requirements_filter(t) -> DataFrame:
    """Models with two exons or more and at least 0.3 of the exons of their gene, counted among those that stay."""

    def measure(left: DataFrame) -> DataFrame:
        x = t.exon.join(left.select("tid"), "tid", "left_semi")
        own = x.groupBy("gid", "tid").agg(F.count(F.lit(1)).alias("n_exons"))
        of = x.select("gid", "s", "e").distinct().groupBy("gid").agg(F.count(F.lit(1)).alias("k"))
        return left.select("tid", "is_ref").join(own.join(of, "gid").select("tid", "n_exons", (F.col("n_exons") / F.col("k")).alias("exon_fraction")), "tid")

    return picking.requirements_filter(t.transcript.select("tid", "is_ref"), evidence.requirement(SHARED), measure).select("tid")


@query("SELECT gid, tid FROM (SELECT gid, tid, row_number() OVER (PARTITION BY gid ORDER BY is_ref DESC, cdna DESC, tid) AS k FROM transcript) WHERE k = 1")
def reference_update(t) -> DataFrame:
    return picking.prefer_reference(t.transcript, "gid", "cdna")


@query("SELECT gid, tid FROM (SELECT gid, tid, row_number() OVER (PARTITION BY gid ORDER BY cdna DESC, tid) AS k FROM transcript WHERE is_ref) WHERE k = 1")
def only_reference_update(t) -> DataFrame:
    return picking.prefer_reference(t.transcript, "gid", "cdna", only_reference=True)


@query("SELECT c.tid, c.locus FROM cand c JOIN transcript a ON a.tid = c.tid JOIN transcript p ON p.tid = c.locus WHERE c.n_loci = 1 AND a.cdna >= 0.5 * p.cdna", CANDIDATES)
def as_min_score(t) -> DataFrame:
    c = locus_steps.as_candidates(t.transcript, primaries(t)).filter("n_loci = 1")
    return picking.as_min_score(c, t.transcript.select("tid", F.col("cdna").alias("score")))


@query("SELECT tid, min(tid) OVER (PARTITION BY chrom, strand, island) AS holder FROM isl", PRIMARY + ", " + isl("primary0", "chrom, strand", "s <= top + 400"))
def monoholders(t) -> DataFrame:
    return picking.monoholders(primaries(t), 400)


@query()
def loci(t) -> DataFrame:
    """From models to primary ones: subloci, scores, choice, holders, scores anew, choice; tests have it by brute force."""

    def score(group: str) -> Column:
        return evidence.score(F.col("cdna"), [group], "max") + evidence.score(F.col("n_exons"), [group], "min")

    return picking.loci(t.transcript, locus_steps.subloci(t.transcript, t.intron), score, 0)


@query("SELECT p.tid AS locus, p.chrom, p.strand, least(p.s, coalesce(min(i.s), p.s)) AS s, greatest(p.e, coalesce(max(i.e), p.e)) AS e, count(i.tid) AS n_isoforms, p.cdna AS score FROM primary0 p LEFT JOIN (SELECT c.locus, t.* FROM cand c JOIN transcript t USING (tid) WHERE c.n_loci = 1) i ON i.locus = p.tid GROUP BY p.tid, p.chrom, p.strand, p.s, p.e, p.cdna", CANDIDATES)
def pick_report(t) -> DataFrame:
    """A row a locus: its primary model, its bounds with the isoforms, their number, the score."""
    top = primaries(t)
    c = locus_steps.as_candidates(t.transcript, top).filter("n_loci = 1").select("tid", "locus")
    own = c.join(t.transcript.select("tid", "s", "e"), "tid").groupBy("locus").agg(F.min("s").alias("_s"), F.max("e").alias("_e"), F.count(F.lit(1)).alias("n"))
    d = top.withColumnRenamed("tid", "locus").join(own, "locus", "left")
    return d.select("locus", "chrom", "strand", F.least("s", "_s").alias("s"), F.greatest("e", "_e").alias("e"), F.coalesce("n", F.lit(0)).alias("n_isoforms"), F.col("cdna").alias("score"))


UNION = ORF + """, tops AS (SELECT *, max(e) OVER (PARTITION BY tid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM good),
cover AS (SELECT tid, count(*) AS n, max(e - s + 1) AS longest, sum(greatest(0, e - greatest(s - 1, coalesce(top, s - 1)))) AS bases FROM tops GROUP BY tid)"""


@query("SELECT tid, n AS number_internal_orfs, CAST(CASE WHEN n > 1 THEN bases - longest ELSE 0 END AS BIGINT) AS cds_not_maximal, CASE WHEN n > 1 THEN bases - longest ELSE 0 END / CAST(bases AS DOUBLE) AS cds_not_maximal_fraction FROM cover", UNION)
def metrics_cds_not_maximal(t) -> DataFrame:
    return picking.frame_metrics(orfs(t))


@query("""SELECT t.tid, coalesce(g.s - 1, 0) AS selected_start_distance_from_tss, coalesce(t.cdna - g.e, 0) AS selected_end_distance_from_tes, CASE WHEN g.tid IS NULL THEN 0 ELSE greatest(0, t.cdna - x.n - g.e) END AS selected_end_distance_from_junction
  FROM transcript t JOIN (SELECT tid, e - s + 1 AS n, row_number() OVER (PARTITION BY tid ORDER BY CASE WHEN strand = '-' THEN s ELSE -s END) AS k FROM exon) x ON x.tid = t.tid AND x.k = 1 LEFT JOIN good g ON g.tid = t.tid AND g.k = 1""", ORF)
def metrics_distances_selected(t) -> DataFrame:
    return picking.frame_distances(t.exon, orfs(t))


def protein_sql(source: str, keys: str) -> str:
    """Proteins of rows (keys, seq): three letters at a time."""
    at = " + ".join(f"(strpos('TCAG', substr(seq, k * 3 + {i}, 1)) - 1) * {m}" for i, m in ((1, 16), (2, 4), (3, 1)))
    return f"protein AS MATERIALIZED (SELECT {keys}, coalesce(string_agg(substr('{CODE}', CAST({at} AS INT) + 1, 1), '' ORDER BY k), '') AS aa FROM (SELECT {keys}, seq, unnest(range(0, length(seq) // 3)) AS k FROM {source}) GROUP BY {keys})"


def sequences(t) -> DataFrame:
    return sequence.cdna_sequence(dna(t.exon))


def phased(t) -> DataFrame:
    """Two frames a model with phases; the first of every ninth model goes past the end."""
    return orfs(t).select("tid", "s", F.expr("IF(tid % 9 = 0, e + 5000, e)").alias("e"), F.expr("CAST(tid % 3 AS INT)").alias("phase"))


FRAMES = CDNA + ", " + ORF + ", fr AS (SELECT g.tid, g.s, CASE WHEN g.tid % 9 = 0 THEN g.e + 5000 ELSE g.e END AS e, g.tid % 3 AS phase, c.seq AS whole FROM good g JOIN cdna c USING (tid)), cut AS (SELECT tid, s, substr(whole, s + phase, greatest(e - s + 1 - phase, 0)) AS seq FROM fr), " + protein_sql("cut", "tid, s")


@query("""SELECT f.tid, f.s, CASE WHEN f.s < 1 OR f.e > length(whole) OR f.s > f.e THEN 'bounds' WHEN (f.e - f.s + 1 - f.phase) % 3 <> 0 AND f.e < length(whole) THEN 'length' WHEN strpos(aa, '*') BETWEEN 1 AND length(aa) - 1 THEN 'stop' ELSE 'valid' END AS reason,
  substr(whole, f.s + f.phase, 3) = 'ATG' AS has_start, coalesce(aa[-1] = '*', false) AS has_stop FROM fr f LEFT JOIN protein p ON p.tid = f.tid AND p.s = f.s""", FRAMES)
def orf_validate(t) -> DataFrame:
    return frames.orf_validate(phased(t).join(sequences(t), "tid")).select("tid", "s", "reason", "has_start", "has_stop")


STARTS = CDNA + ", " + ORF + """, fr AS (SELECT g.tid, g.s, g.e, c.seq FROM good g JOIN cdna c USING (tid)),
up AS (SELECT tid, s, k, substr(seq, s - 3 * k, 3) AS codon FROM (SELECT *, unnest(range(1, (s - 1) // 3 + 1)) AS k FROM fr)),
hit AS (SELECT tid, s, min(k) AS k FROM up WHERE codon IN ('ATG', 'TAA', 'TAG', 'TGA') GROUP BY 1, 2),
down AS (SELECT tid, s, min(k) AS k FROM (SELECT *, unnest(range(1, CAST(floor(0.2 * ((e - s + 1) // 3)) AS BIGINT) + 1)) AS k FROM fr) WHERE substr(seq, s + 3 * k, 3) = 'ATG' GROUP BY 1, 2)"""


@query("""SELECT f.tid, f.s AS was, CASE WHEN substr(f.seq, f.s, 3) = 'ATG' THEN f.s WHEN f.s > 3 THEN CASE WHEN h.k IS NOT NULL THEN f.s - 3 * h.k ELSE 1 END WHEN d.k IS NOT NULL THEN f.s + 3 * d.k ELSE 1 END AS s,
  CASE WHEN substr(f.seq, f.s, 3) = 'ATG' OR f.s > 3 AND h.k IS NOT NULL OR f.s <= 3 AND d.k IS NOT NULL THEN 0 ELSE CAST((f.s - 1) % 3 AS INT) END AS phase, coalesce(substr(f.seq, f.s, 3) <> 'ATG' AND f.s > 3 AND substr(f.seq, f.s - 3 * h.k, 3) <> 'ATG', false) AS stopped
  FROM fr f LEFT JOIN hit h ON h.tid = f.tid AND h.s = f.s LEFT JOIN down d ON d.tid = f.tid AND d.s = f.s""", STARTS)
def orf_start_adjust(t) -> DataFrame:
    return frames.orf_start_adjust(orfs(t).select("tid", "s", "e").join(sequences(t), "tid")).select("tid", "was", "s", "phase", "stopped")


@query("""SELECT r.tid, CASE WHEN length(r.seq) % 3 = 0 AND coalesce(strpos(aa, '*') NOT BETWEEN 1 AND length(aa) - 1, true) THEN 'keep' WHEN r.tid % 2 = 0 THEN 'strip' ELSE 'reject' END AS verdict FROM read r LEFT JOIN protein p ON p.tid = r.tid""", CODING + ", " + protein_sql("read", "tid"))
def orf_check(t) -> DataFrame:
    """Models of even number may lose a faulty coding part, others are rejected."""
    seq = sequence.cdna_sequence(dna(t.cds))
    return frames.orf_check(seq.select("tid", F.expr("substr(seq, CAST(1 + tid % 3 AS INT))").alias("seq")), F.col("tid") % 2 == 0)
