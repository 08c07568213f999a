"""Queries of the parting of chimeras: three frames a model, hits on three targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.operators import chimeras
from splicedf.operators.graph import _cut
from splicedf.plans.registry import query

#: Models of this source are not split.
SKIP = "src3"


def frames(t) -> DataFrame:
    some = F.expr("array(struct(31L AS s, cdna div 3 - 10 AS e), struct(cdna div 3 + 5 - 15 * (tid % 2) AS s, 2 * cdna div 3 AS e), struct(2 * cdna div 3 + 20 AS s, cdna - 10 AS e))")
    # a condition on sources would be asked of the lines, so that frames and hits had models of their own
    return t.transcript.select("tid", F.inline(F.when(F.col("source") != SKIP, some))).filter("s < e")


def hits(t) -> DataFrame:
    """HSPs on three targets, with places on the target and a match."""
    n = "(qend - qstart) div 3 + 1"
    d = t.hsp.withColumn("ts", F.expr("CAST(1 + (target * 37 + n) % 60 AS BIGINT)"))
    return d.selectExpr(
        "query AS tid", "target % 3 AS target", "CAST(60 + target % 3 * 30 AS BIGINT) AS tlen", "qstart AS qs", "qend AS qe", "ts", f"ts + {n} AS te", "CAST(concat('1e-', nlog) AS DOUBLE) AS evalue", "bitscore AS bits", f"left(repeat('AC+ |_D', 40), CAST({n} AS INT)) AS match"
    )


def evidence(t) -> DataFrame:
    return chimeras.frame_evidence(frames(t), hits(t))


FRAMES = f"""fr AS MATERIALIZED (SELECT * FROM (SELECT tid, 31 AS s, cdna // 3 - 10 AS e FROM transcript WHERE source <> '{SKIP}' UNION ALL SELECT tid, cdna // 3 + 5 - 15 * (tid % 2), 2 * cdna // 3 FROM transcript WHERE source <> '{SKIP}' UNION ALL SELECT tid, 2 * cdna // 3 + 20, cdna - 10 FROM transcript WHERE source <> '{SKIP}') WHERE s < e),
ch AS MATERIALIZED (SELECT query AS tid, target % 3 AS target, 60 + target % 3 * 30 AS tlen, qstart AS qs, qend AS qe, 1 + (target * 37 + n) % 60 AS ts, 1 + (target * 37 + n) % 60 + (qend - qstart) // 3 + 1 AS te, CAST('1e-' || nlog AS DOUBLE) AS evalue, bitscore AS bits, left(repeat('AC+ |_D', 40), CAST((qend - qstart) // 3 + 1 AS INT)) AS match FROM hsp),
fd AS MATERIALIZED (SELECT f.tid, f.s, f.e, c.target, c.qs, c.qe, c.ts, c.te, c.tlen FROM fr f JOIN ch c ON c.tid = f.tid WHERE evalue <= 1e-6 AND least(f.e, qe) - greatest(f.s, qs) >= CAST(0.5 AS DOUBLE) * (f.e + 1 - f.s)),
fn AS (SELECT f.tid, f.s, f.e, (SELECT count(DISTINCT target) FROM fd WHERE fd.tid = f.tid AND fd.s = f.s AND fd.e = f.e) AS hits FROM fr f),
fl AS MATERIALIZED (SELECT *, lag(hits) OVER w AS before, lag(s) OVER w AS os, lag(e) OVER w AS oe FROM fn WINDOW w AS (PARTITION BY tid ORDER BY s, e)),
ev AS MATERIALIZED (SELECT l.tid, l.s, l.e, l.hits, l.before, EXISTS (SELECT 1 FROM fd a JOIN fd b ON a.tid = b.tid AND a.target = b.target WHERE a.tid = l.tid AND a.s = l.s AND a.e = l.e AND b.s = l.os AND b.e = l.oe
  AND (least(a.qe, b.qe) >= greatest(a.qs, b.qs) OR least(a.te, b.te) >= greatest(a.ts, b.ts) AND CAST(least(a.te, b.te) - greatest(a.ts, b.ts) AS DOUBLE) / a.tlen < CAST(0.8 AS DOUBLE))) AS joined FROM fl l)"""


def decided_sql(mode: str) -> str:
    rule = {"NOSPLIT": "false", "SPLIT": "true"}.get(mode, f"CASE WHEN hits = 0 AND before = 0 THEN {str(mode != 'STRINGENT').lower()} WHEN hits = 0 OR before = 0 THEN {str(mode == 'PERMISSIVE').lower()} ELSE NOT joined END")
    return f"SELECT tid, s, e, part, min(s) OVER (PARTITION BY tid, part) AS from_, last_value(e) OVER (PARTITION BY tid, part ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS to_ FROM (SELECT tid, s, e, CAST(1 + sum(CASE WHEN before IS NOT NULL AND {rule} THEN 1 ELSE 0 END) OVER (PARTITION BY tid ORDER BY s, e) AS INT) AS part FROM ev)"


@query(" UNION ALL ".join(f"SELECT '{m}' AS mode, tid, s, e, part, from_, to_ FROM ({decided_sql(m)})" for m in chimeras.MODES), FRAMES)
def chimera_decide(t) -> DataFrame:
    """The parts of every model under each of the five modes, on one table of evidence."""
    e = _cut(evidence(t))
    each = [chimeras.chimera_decide(e, m).withColumn("mode", F.lit(m)) for m in chimeras.MODES]
    return reduce(DataFrame.unionByName, each).withColumnsRenamed({"from": "from_", "to": "to_"})


SPLITS = (
    FRAMES
    + f""", de AS MATERIALIZED ({decided_sql("LENIENT")}), pt AS (SELECT tid, part, min(from_) AS f, min(to_) AS t, max(part) OVER (PARTITION BY tid) AS n FROM de GROUP BY tid, part), pm AS MATERIALIZED (SELECT * FROM pt WHERE n > 1),
tx AS (SELECT x.*, coalesce(sum(e - s + 1) OVER (PARTITION BY tid ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM exon x),
tb AS (SELECT x.tid, x.strand, x.s, x.e, p.part, off + 1 AS ts, off + e - s + 1 AS te, p.f, p.t, p.part > 1 AS l, p.part < p.n AS r FROM tx x JOIN pm p ON p.tid = x.tid),
ab AS (SELECT *, CASE WHEN NOT l THEN ts WHEN te = f THEN greatest(ts, f - 1) ELSE greatest(ts, f) END AS a, CASE WHEN NOT r THEN te WHEN ts = t THEN least(te, t + 1) ELSE least(te, t) END AS b FROM tb),
sx AS MATERIALIZED (SELECT tid, part, a, b, CAST(CASE WHEN strand = '-' THEN e - (b - ts) ELSE s + a - ts END AS BIGINT) AS s, CAST(CASE WHEN strand = '-' THEN e - (a - ts) ELSE s + b - ts END AS BIGINT) AS e FROM ab WHERE a <= b),
sp AS (SELECT tid, part, min(a) AS a, max(b) AS b, min(s) AS s, max(e) AS e FROM sx GROUP BY tid, part),
clash AS MATERIALIZED (SELECT DISTINCT p.tid FROM sp p JOIN sp q ON p.tid = q.tid AND p.part = q.part + 1 WHERE least(p.e, q.e) > greatest(p.s, q.s))"""
)


@query("""SELECT tid, part, 'exon' AS feature, s, e FROM sx WHERE tid NOT IN (SELECT tid FROM clash) UNION ALL SELECT d.tid, d.part, 'frame', CAST(least(d.s, p.b) - p.a + 1 AS BIGINT), CAST(least(d.e, p.b) - p.a + 1 AS BIGINT) FROM de d JOIN sp p ON p.tid = d.tid AND p.part = d.part WHERE d.tid NOT IN (SELECT tid FROM clash)
  UNION ALL SELECT tid, NULL, 'stripped', NULL, NULL FROM clash""", SPLITS)
def chimera_split(t) -> DataFrame:
    """Exons and frames of the parts, and the models whose parts collide."""
    exons, orfs, stripped = chimeras.chimera_split(t.exon, _cut(chimeras.chimera_decide(evidence(t), chimeras.LENIENT)))
    none = [F.lit(None).cast(k).alias(c) for c, k in (("part", "int"), ("s", "long"), ("e", "long"))]
    out = exons.withColumn("feature", F.lit("exon")).unionByName(orfs.withColumn("feature", F.lit("frame"))).unionByName(stripped.select("tid", *none, F.lit("stripped").alias("feature")))
    return out.select("tid", "part", "feature", "s", "e")


HITS = (
    FRAMES
    + f""", de AS ({decided_sql("LENIENT")}), pm AS (SELECT DISTINCT tid, part, from_ AS f, to_ AS t FROM de), re AS (SELECT tid, target, min(qs) AS rs, max(qe) AS re FROM ch GROUP BY 1, 2),
ph AS MATERIALIZED (SELECT c.*, p.part FROM ch c JOIN re USING (tid, target) JOIN pm p ON p.tid = c.tid WHERE least(re, t) > greatest(rs, f) AND least(qe, t) - greatest(qs, f) >= CAST(0.5 AS DOUBLE) * (t + 1 - f)),
qa AS (SELECT tid, part, target, min(s) AS query_start, max(e) AS query_end, CAST(sum(e - s + 1) AS BIGINT) AS query_aligned FROM (SELECT tid, part, target, g, min(qs) AS s, max(qe) AS e FROM (SELECT *, sum(CASE WHEN qs < top THEN 0 ELSE 1 END) OVER (PARTITION BY tid, part, target ORDER BY qs, qe) AS g FROM (SELECT *, max(qe) OVER (PARTITION BY tid, part, target ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM ph)) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
ta AS (SELECT tid, part, target, min(s) AS target_start, max(e) AS target_end, CAST(sum(e - s + 1) AS BIGINT) AS target_aligned FROM (SELECT tid, part, target, g, min(ts) AS s, max(te) AS e FROM (SELECT *, sum(CASE WHEN ts < top THEN 0 ELSE 1 END) OVER (PARTITION BY tid, part, target ORDER BY ts, te) AS g FROM (SELECT *, max(te) OVER (PARTITION BY tid, part, target ORDER BY ts, te ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM ph)) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
st AS (SELECT tid, part, target, qs, regexp_replace(match, '[^A-Za-z|+_]', '', 'g') AS m FROM ph), ps AS (SELECT tid, part, target, qs + i - 1 AS at_, substr(m, CAST(i AS INT), 1) AS c FROM (SELECT *, unnest(range(1, length(m) + 1)) AS i FROM st)),
pc AS (SELECT tid, part, target, count(DISTINCT at_) AS p, count(DISTINCT CASE WHEN c <> '+' THEN at_ END) AS i FROM ps WHERE c <> '_' GROUP BY 1, 2, 3)"""
)


@query("""SELECT h.*, query_start, query_end, query_aligned, target_start, target_end, target_aligned, CAST(coalesce(i, 0) * 100 AS DOUBLE) / query_aligned AS identity, CAST(coalesce(p, 0) * 100 AS DOUBLE) / query_aligned AS positives
  FROM (SELECT tid, part, target, max(bits) AS bits, min(evalue) AS evalue, count(*) AS n_hsps FROM ph GROUP BY 1, 2, 3) h JOIN qa USING (tid, part, target) JOIN ta USING (tid, part, target) LEFT JOIN pc USING (tid, part, target)""", HITS)
def chimera_hits(t) -> DataFrame:
    """All of it is by model, so that lines are brought together by model and stay there."""
    return chimeras.chimera_hits(hits(t), chimeras.chimera_decide(evidence(t), chimeras.LENIENT))
