"""Queries that compare a prediction with a reference, pair by pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.operators import compare
from splicedf.plans.registry import query

COUNTS = ("n_common", "e_common", "j_common", "i_common")


def pair_sql(distance: int, a: str = "NOT is_ref", b: str = "is_ref", on: str = "true", held: str = "") -> str:
    """Common table expressions up to `coded`, by correlated counts over each pair: another way than the joins. `held` makes a
    table held (tid_a, tid_b) of the only pairs that count."""
    which = f"held h JOIN ta a ON a.tid = h.tid_a JOIN tb b ON b.tid = h.tid_b WHERE {on}" if held else f"ta a JOIN tb b ON a.chrom = b.chrom AND greatest(a.s, b.s) - least(a.e, b.e) <= {distance} AND {on}"
    ends = lambda t: f"SELECT s AS pos, 0 AS side FROM intron WHERE tid = p.{t} UNION SELECT e, 1 FROM intron WHERE tid = p.{t}"
    return f"""ta AS (SELECT * FROM transcript WHERE {a}), tb AS (SELECT * FROM transcript WHERE {b}),{held and " " + held + ","}
pair AS (SELECT a.tid AS tid_a, b.tid AS tid_b, a.s AS s_a, a.e AS e_a, b.s AS s_b, b.e AS e_b, a.n_exons AS n_exons_a, b.n_exons AS n_exons_b, a.cdna AS cdna_a, b.cdna AS cdna_b, a.strand AS strand_a, b.strand AS strand_b,
  greatest(0, greatest(a.s, b.s) - least(a.e, b.e)) AS distance FROM {which}),
exa AS (SELECT p.tid_a, p.tid_b, CAST(sum(greatest(0, least(x.e, y.e) - greatest(x.s, y.s) + 1)) AS BIGINT) AS n_common, count(CASE WHEN x.s = y.s AND x.e = y.e THEN 1 END) AS e_common FROM pair p JOIN exon x ON x.tid = p.tid_a JOIN exon y ON y.tid = p.tid_b GROUP BY 1, 2),
site AS (SELECT DISTINCT * FROM (SELECT tid, s AS pos, 0 AS side FROM intron UNION ALL SELECT tid, e, 1 FROM intron)),
ends AS (SELECT tid, count(*) AS j, min(pos) AS low, max(pos) AS high FROM site GROUP BY tid),
jun AS (SELECT p.tid_a, p.tid_b, count(*) AS j_common FROM pair p JOIN site x ON x.tid = p.tid_a JOIN site y ON y.tid = p.tid_b AND x.pos = y.pos AND x.side = y.side GROUP BY 1, 2),
ints AS (SELECT p.tid_a, p.tid_b, count(CASE WHEN x.s = y.s AND x.e = y.e THEN 1 END) AS i_common, count(CASE WHEN least(x.e, y.e) - greatest(x.s, y.s) > 0 THEN 1 END) AS i_touch FROM pair p JOIN intron x ON x.tid = p.tid_a JOIN intron y ON y.tid = p.tid_b GROUP BY 1, 2),
fresh AS (SELECT p.tid_a, p.tid_b, count(CASE WHEN x.pos > n.low AND x.pos < n.high THEN 1 END) AS new_inside, count(CASE WHEN x.pos > p.s_b AND x.pos < p.e_b THEN 1 END) AS new_within
  FROM pair p JOIN ends n ON n.tid = p.tid_b JOIN (SELECT DISTINCT tid, pos FROM site) x ON x.tid = p.tid_a LEFT JOIN (SELECT DISTINCT tid, pos FROM site) y ON y.tid = p.tid_b AND y.pos = x.pos WHERE y.pos IS NULL GROUP BY 1, 2),
lost AS (SELECT p.tid_a, p.tid_b, count(*) AS missed FROM pair p JOIN ends n ON n.tid = p.tid_a JOIN intron y ON y.tid = p.tid_b LEFT JOIN intron x ON x.tid = p.tid_a AND x.s = y.s AND x.e = y.e
  WHERE x.tid IS NULL AND ((p.s_a < y.s AND y.e < n.low) OR (p.e_a > y.e AND y.s > n.high)) GROUP BY 1, 2),
mono AS (SELECT tid_a, tid_b, count(*) AS m_n, max(CASE WHEN k = 1 THEN over END) AS m_first, max(CASE WHEN k = 2 THEN over END) AS m_second, max(CASE WHEN k = 1 THEN n END) AS m_len FROM
  (SELECT p.tid_a, p.tid_b, least(y.e, p.e_a) - greatest(y.s, p.s_a) AS over, y.e - y.s + 1 AS n, row_number() OVER (PARTITION BY p.tid_a, p.tid_b ORDER BY y.s) AS k FROM pair p JOIN intron y ON y.tid = p.tid_b AND least(y.e, p.e_a) - greatest(y.s, p.s_a) > 0 WHERE p.n_exons_a = 1) GROUP BY 1, 2),
wide AS (SELECT p.*, coalesce(x.n_common, 0) AS n_common, coalesce(x.e_common, 0) AS e_common, coalesce(j.j_common, 0) AS j_common, coalesce(i.i_common, 0) AS i_common, coalesce(i.i_touch, 0) AS i_touch, coalesce(f.new_inside, 0) AS new_inside, coalesce(f.new_within, 0) AS new_within,
  coalesce(l.missed, 0) AS missed, coalesce(m.m_n, 0) AS m_n, coalesce(m.m_first, 0) AS m_first, coalesce(m.m_second, 0) AS m_second, coalesce(m.m_len, 0) AS m_len, coalesce(na.j, 0) AS j_a, coalesce(nb.j, 0) AS j_b
  FROM pair p LEFT JOIN exa x USING (tid_a, tid_b) LEFT JOIN jun j USING (tid_a, tid_b) LEFT JOIN ints i USING (tid_a, tid_b) LEFT JOIN fresh f USING (tid_a, tid_b) LEFT JOIN lost l USING (tid_a, tid_b) LEFT JOIN mono m USING (tid_a, tid_b)
  LEFT JOIN ends na ON na.tid = p.tid_a LEFT JOIN ends nb ON nb.tid = p.tid_b),
share AS (SELECT *, n_common / CAST(cdna_a AS DOUBLE) AS n_prec, n_common / CAST(cdna_b AS DOUBLE) AS n_recall, e_common / CAST(n_exons_a AS DOUBLE) AS e_prec, e_common / CAST(n_exons_b AS DOUBLE) AS e_recall,
  CASE WHEN n_exons_a = 1 AND n_exons_b = 1 AND n_common > 0 THEN CAST(1 AS DOUBLE) WHEN j_a > 0 THEN j_common / CAST(j_a AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS j_prec, CASE WHEN n_exons_a = 1 AND n_exons_b = 1 AND n_common > 0 THEN CAST(1 AS DOUBLE) WHEN j_b > 0 THEN j_common / CAST(j_b AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS j_recall FROM wide),
rated AS (SELECT *, {", ".join(f"CASE WHEN {k}_recall + {k}_prec > 0 THEN 2 * {k}_recall * {k}_prec / ({k}_recall + {k}_prec) ELSE CAST(0 AS DOUBLE) END AS {k}_f1" for k in "nej")} FROM share),
code0 AS (SELECT *, CASE
  WHEN n_exons_a > 1 AND n_exons_b > 1 AND j_common = j_a AND j_common = j_b THEN CASE WHEN strand_a = strand_b THEN '=' ELSE 'c' END
  WHEN n_exons_a = 1 AND n_exons_b = 1 AND n_f1 >= 0.8 THEN '_'
  WHEN s_a > e_b OR e_a < s_b THEN CASE WHEN strand_a = strand_b THEN 'p' ELSE 'P' END
  WHEN n_exons_a > 1 AND n_exons_b > 1 THEN CASE
    WHEN j_common = 0 AND n_common = 0 THEN CASE WHEN s_b < s_a AND s_a < e_b THEN 'I' ELSE 'rI' END
    WHEN j_common = 0 THEN CASE WHEN i_touch > 0 THEN 'h' ELSE 'o' END
    WHEN j_common < j_a AND j_common < j_b THEN 'j'
    WHEN j_common = j_b THEN CASE WHEN new_inside > 0 THEN 'j' WHEN new_within > 0 THEN 'J' ELSE 'n' END
    WHEN i_common < n_exons_a - 1 THEN 'j' WHEN n_common = cdna_a THEN 'c' WHEN missed > 0 THEN 'j' ELSE 'C' END
  WHEN n_exons_a = 1 AND n_exons_b = 1 THEN CASE WHEN n_common = cdna_a THEN 'c' ELSE 'm' END
  WHEN n_exons_a = 1 THEN CASE WHEN n_common = cdna_a THEN 'c' WHEN n_common = 0 THEN 'i' WHEN m_n = 1 AND m_first > 10 AND m_first < m_len AND s_b < s_a AND e_a < e_b OR m_n = 2 AND (m_first >= 10 OR m_second >= 10) THEN 'e' ELSE 'g' END
  WHEN n_common = cdna_b THEN 'n' WHEN n_common > 0 THEN 'G' WHEN least(e_a, e_b) - greatest(s_a, s_b) > 0 THEN 'ri' ELSE 'p' END AS code FROM rated),
coded AS (SELECT *, CASE WHEN strand_a = strand_b OR code IN ('u', 'i', 'I', 'p', 'P', 'x') THEN code WHEN code IN ('e', 'g', 'c', 'm', '_', 'C') THEN 'x' ELSE 'X' END AS ccode FROM code0)"""


def best_sql(key: str, other: str) -> str:
    return f"best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY j_f1 DESC, n_f1 DESC, distance, ccode IN ('x', 'X'), {other}) AS k FROM near) WHERE k = 1)"


def sides(t) -> tuple:
    """Predicted and reference models; their exons are written once and read from there."""
    t.keep("exon")
    pick = lambda c: (t.transcript.filter(c), t.exon.filter(c), t.intron.filter(c))
    return pick("NOT is_ref"), pick("is_ref")


@query("SELECT tid_a, tid_b, distance, n_common, e_common, j_common, i_common, n_f1, j_f1, e_f1, ccode FROM coded", pair_sql(0))
def compare_pair(t) -> DataFrame:
    return compare.compare_pairs(*sides(t)).select("tid_a", "tid_b", "distance", *COUNTS, "n_f1", "j_f1", "e_f1", "ccode")


@query("SELECT tid_a, tid_b, n_common, n_prec, n_recall, n_f1 FROM rated", pair_sql(0))
def pair_nucleotide_stats(t) -> DataFrame:
    return compare.compare_pairs(*sides(t)).select("tid_a", "tid_b", "n_common", "n_prec", "n_recall", "n_f1")


@query("SELECT tid_a, tid_b, e_common, e_prec, e_recall, e_f1 FROM rated", pair_sql(0))
def pair_exon_stats(t) -> DataFrame:
    return compare.compare_pairs(*sides(t)).select("tid_a", "tid_b", "e_common", "e_prec", "e_recall", "e_f1")


@query("SELECT tid_a, tid_b, j_common, j_prec, j_recall, j_f1 FROM rated", pair_sql(0))
def pair_junction_stats(t) -> DataFrame:
    return compare.compare_pairs(*sides(t)).select("tid_a", "tid_b", "j_common", "j_prec", "j_recall", "j_f1")


@query("SELECT tid_a, tid_b, ccode FROM coded WHERE n_exons_a > 1 AND n_exons_b > 1", pair_sql(0))
def class_code_multi(t) -> DataFrame:
    return compare.compare_pairs(*sides(t)).filter("n_exons_a > 1 AND n_exons_b > 1").select("tid_a", "tid_b", "ccode")


@query("SELECT tid_a, tid_b, ccode FROM coded WHERE n_exons_a = 1 OR n_exons_b = 1", pair_sql(0))
def class_code_mono(t) -> DataFrame:
    return compare.compare_pairs(*sides(t)).filter("n_exons_a = 1 OR n_exons_b = 1").select("tid_a", "tid_b", "ccode")


@query("SELECT tid_a, tid_b, distance, ccode FROM coded WHERE distance > 0", pair_sql(2000))
def class_code_location(t) -> DataFrame:
    return compare.compare_pairs(*sides(t), distance=2000).filter("distance > 0").select("tid_a", "tid_b", "distance", "ccode")


HELD = """genes AS (SELECT CAST(gid AS VARCHAR) || strand AS gene, min(chrom) AS chrom, min(strand) AS strand, min(s) AS s, max(e) AS e FROM tb GROUP BY 1),
cand AS (SELECT a.tid AS tid_a, a.strand AS sa, g.*, greatest(0, greatest(a.s, g.s) - least(a.e, g.e)) AS d FROM ta a JOIN genes g ON a.chrom = g.chrom AND greatest(a.s, g.s) - least(a.e, g.e) <= 2000),
near0 AS MATERIALIZED (SELECT *, s || '-' || e AS place, row_number() OVER (PARTITION BY tid_a ORDER BY s, e, gene) AS k FROM (SELECT *, min(d) OVER (PARTITION BY tid_a) AS dm FROM cand) WHERE d = dm),
tally AS (SELECT tid_a, count(DISTINCT place) AS n, count(DISTINCT CASE WHEN sa = strand THEN place END) AS m, max(CASE WHEN k = 1 THEN place END) AS first_ FROM near0 GROUP BY 1),
fit AS (SELECT DISTINCT tid_a, place FROM near0 WHERE sa = strand),
choice AS (SELECT x.*, t.n, t.m, CASE WHEN d > 0 THEN 'beside' WHEN t.m > 1 THEN 'many' ELSE 'one' END AS mode FROM near0 x JOIN tally t ON t.tid_a = x.tid_a LEFT JOIN fit f ON f.tid_a = x.tid_a AND f.place = x.place WHERE CASE WHEN d > 0 THEN k = 1 WHEN t.n = 1 THEN true WHEN t.m = 0 THEN x.place = first_ ELSE f.place IS NOT NULL END),
pick AS MATERIALIZED (SELECT tid_a, gene, place, mode FROM choice WHERE mode <> 'many' OR sa = strand),
held AS (SELECT p.tid_a, b.tid AS tid_b FROM pick p JOIN tb b ON CAST(b.gid AS VARCHAR) || b.strand = p.gene)"""
BEST = "CASE WHEN mode = 'beside' THEN distance ELSE 0 END, j_f1 DESC, n_f1 DESC, distance, ccode IN ('x', 'X'), tid_b"
MATCHES = (
    pair_sql(0, held=HELD)
    + f""", m0 AS (SELECT c.*, p.gene, p.place, p.mode, b.gid AS gid_b, row_number() OVER (PARTITION BY c.tid_a, p.gene ORDER BY {BEST}) AS g FROM coded c JOIN tb b ON b.tid = c.tid_b JOIN pick p ON p.tid_a = c.tid_a AND p.gene = CAST(b.gid AS VARCHAR) || b.strand),
m1 AS (SELECT *, mode = 'many' AND j_f1 = 0 AND n_recall < CAST(0.1 AS DOUBLE) AS weak FROM m0 WHERE g = 1), m2 AS (SELECT *, row_number() OVER (PARTITION BY tid_a, place ORDER BY weak, {BEST}) AS p, row_number() OVER (PARTITION BY tid_a ORDER BY weak, {BEST}) AS t FROM m1),
m3 AS (SELECT *, mode = 'many' AND NOT weak AND p = 1 AS good FROM m2), m4 AS (SELECT *, count(CASE WHEN good THEN 1 END) OVER (PARTITION BY tid_a) AS n FROM m3),
m5 AS (SELECT *, n > 1 AS fused FROM m4 WHERE CASE WHEN n > 1 THEN good ELSE t = 1 END),
m6 AS (SELECT *, min(least(s_a, s_b)) OVER (PARTITION BY tid_a) AS low, max(greatest(e_a, e_b)) OVER (PARTITION BY tid_a) AS high FROM m5),
tm AS (SELECT m.tid_b AS ref_id, m.gid_b AS ref_gene, CASE WHEN fused THEN 'f,' || ccode ELSE coalesce(ccode, 'u') END AS ccode, a.tid, a.gid, a.n_exons AS tid_num_exons, m.n_exons_b AS ref_num_exons, {", ".join(f"coalesce({r}, CAST(0 AS DOUBLE)) AS {r}" for r in compare.RATES)}, m.distance, a.chrom || ':' || coalesce(low, a.s) || '..' || coalesce(high, a.e) AS location FROM ta a LEFT JOIN m6 m ON m.tid_a = a.tid)"""
)


@query("SELECT * FROM tm", MATCHES)
def tmap(t) -> DataFrame:
    """Every prediction's matches, a row for each gene that it fuses."""
    return compare.tmap(*sides(t))


@query("SELECT b.tid AS tid_b, x.tid_a, coalesce(x.ccode, 'NA') AS ccode, x.n_f1, x.j_f1 FROM tb b LEFT JOIN best x ON b.tid = x.tid_b", pair_sql(0) + ", near AS (SELECT * FROM coded), " + best_sql("tid_b", "tid_a"))
def refmap(t) -> DataFrame:
    return compare.refmap(compare.compare_pairs(*sides(t)), t.transcript.filter("is_ref"))


@query("SELECT ccode, count(*) AS n FROM coded GROUP BY ccode", pair_sql(0))
def class_code_counts(t) -> DataFrame:
    return compare.compare_pairs(*sides(t)).groupBy("ccode").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT tid_a, tid_b, ccode, n_f1 FROM coded WHERE tid_a <> tid_b", pair_sql(0, "is_ref", "is_ref"))
def compare_self(t) -> DataFrame:
    side = tuple(d.filter("is_ref") for d in (t.transcript, t.exon, t.intron))
    return compare.compare_self(side).select("tid_a", "tid_b", "ccode", "n_f1")
