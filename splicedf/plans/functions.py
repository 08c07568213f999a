"""Queries of helper functions and of single measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import evaluate, evidence
from splicedf.plans.evaluation import COUNTS, RATES, flags
from splicedf.plans.registry import query


@query("SELECT tid, gid, upper(source) || '.' || chrom || 'G' || gid AS name, CAST(substr(chrom, 4) AS INT) AS number, strpos(source, 'c') AS place FROM transcript")
def fn_string(t) -> DataFrame:
    """Names are put together and taken apart."""
    return t.transcript.select("tid", "gid", F.concat(F.upper("source"), F.lit("."), "chrom", F.lit("G"), F.col("gid").cast("string")).alias("name"), F.substring("chrom", 4, 9).cast("int").alias("number"), F.instr("source", "c").cast("long").alias("place"))


@query("SELECT tid, count(*) AS n, min(e - s + 1) AS shortest, max(e - s + 1) AS longest, arg_min(e - s + 1, s) AS first, string_agg(CAST(e - s + 1 AS VARCHAR), ',' ORDER BY s) AS lengths FROM exon GROUP BY tid")
def fn_array(t) -> DataFrame:
    """Exon lengths of a model as one array, in order of place."""
    d = t.exon.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("x"))
    d = d.withColumn("n_each", F.transform("x", lambda x: x.e - x.s + 1))
    return d.select("tid", F.size("x").cast("long").alias("n"), F.array_min("n_each").alias("shortest"), F.array_max("n_each").alias("longest"), F.col("n_each")[0].alias("first"), F.array_join(F.transform("n_each", lambda x: x.cast("string")), ",").alias("lengths"))


@query("SELECT tid, CASE WHEN tid % 4 = 0 THEN cdna END AS length, CAST(CASE WHEN tid % 4 = 0 THEN 2 ELSE 1 END AS INT) AS n_keys, source FROM transcript")
def fn_map(t) -> DataFrame:
    """Attributes of a model as a map; a key that it lacks is null."""
    own = F.map_filter(F.create_map(F.lit("source"), F.col("source"), F.lit("length"), F.when(F.col("tid") % 4 == 0, F.col("cdna").cast("string"))), lambda k, v: v.isNotNull())
    d = t.transcript.select("tid", own.alias("a"))
    return d.select("tid", F.element_at("a", "length").cast("long").alias("length"), F.size(F.map_keys("a")).alias("n_keys"), F.element_at("a", "source").alias("source"))


@query("SELECT x.tid, x.s, x.e, greatest(least(x.e, t.s + 999) - greatest(x.s, t.s) + 1, 0) AS common, greatest(x.s, t.s + 1000) - least(x.e, t.s + 999) - 1 AS gap, x.s >= t.s AND x.e <= t.s + 999 AS inside FROM exon x JOIN transcript t ON x.tid = t.tid")
def fn_interval(t) -> DataFrame:
    """Exons against the first thousand bases of their model: common bases, distance from what follows, containment."""
    d = t.exon.join(t.transcript.select("tid", F.col("s").alias("ts")), "tid")
    last = F.col("ts") + 999
    common = F.greatest(F.least("e", last) - F.greatest("s", "ts") + 1, F.lit(0))
    return d.select("tid", "s", "e", common.alias("common"), (F.greatest("s", last + 1) - F.least("e", last) - 1).alias("gap"), ((F.col("s") >= F.col("ts")) & (F.col("e") <= last)).alias("inside"))


@query("SELECT tid, CASE WHEN a + b > 0 THEN 2 * a * b / (a + b) ELSE CAST(0 AS DOUBLE) END AS f1 FROM (SELECT tid, (tid % 11) / CAST(10 AS DOUBLE) AS a, (cdna % 7) / CAST(7 AS DOUBLE) AS b FROM transcript)")
def fn_f1(t) -> DataFrame:
    """The harmonic mean of two rates; 0 if both are."""
    return t.transcript.select("tid", evaluate.f1((F.col("tid") % 11) / F.lit(10.0), (F.col("cdna") % 7) / F.lit(7.0)).alias("f1"))


@query(RATES, "part AS (SELECT c.*, tid % 3 = 0 AS is_ref FROM cds c), " + flags("part", "chrom, strand, s, e") + ", " + COUNTS)
def feature_confusion(t) -> DataFrame:
    """Distinct coding segments of the prediction against the reference's."""
    return evaluate.feature_confusion(t.cds.withColumn("is_ref", F.col("tid") % 3 == 0), ["chrom", "strand", "s", "e"])


ONE = "floor((CASE WHEN {hi} = {lo} THEN CAST(1 AS DOUBLE) ELSE {x} END) * 100 + CAST(0.5 AS DOUBLE)) / 100"
UP = ONE.format(hi="hi", lo="lo", x="(cdna - lo) / CAST(hi - lo AS DOUBLE)")
DOWN = ONE.format(hi="hi", lo="lo", x="1 - (cdna - lo) / CAST(hi - lo AS DOUBLE)")
NEAR = ONE.format(hi="far", lo="0", x="1 - abs(cdna - 1000) / CAST(far AS DOUBLE)")


@query(f"SELECT tid, gid, {UP} AS up, {DOWN} AS down, {NEAR} AS near FROM (SELECT *, min(cdna) OVER w AS lo, max(cdna) OVER w AS hi, max(abs(cdna - 1000)) OVER w AS far FROM transcript WINDOW w AS (PARTITION BY gid))")
def locus_rescale(t) -> DataFrame:
    """A metric rescaled within its locus by each of the three schemes."""
    s = lambda kind, value=None: evidence.score(F.col("cdna"), ["gid"], kind, value)
    return t.transcript.select("tid", "gid", s("max").alias("up"), s("min").alias("down"), s("target", 1000).alias("near"))


@query("SELECT t.tid, floor((2 * coalesce(c.n, 0) / CAST(t.cdna AS DOUBLE)) * 100 + CAST(0.5 AS DOUBLE)) / 100 AS score FROM transcript t LEFT JOIN (SELECT tid, CAST(sum(e - s + 1) AS BIGINT) AS n FROM cds GROUP BY 1) c ON t.tid = c.tid")
def score_raw(t) -> DataFrame:
    """A share, which needs no rescaling, times its multiplier; a value outside 0 to 1 is an error."""
    c = t.cds.groupBy("tid").agg(F.sum(F.col("e") - F.col("s") + 1).alias("n"))
    d = t.transcript.join(c, "tid", "left").select("tid", (F.coalesce("n", F.lit(0)) / F.col("cdna")).alias("share"))
    return d.select("tid", evidence.score_raw(F.col("share"), 2.0).alias("score"))


@query("SELECT tid, s, e FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY e - s DESC, s) AS k, arg_max(side, (e - s, -s)) OVER (PARTITION BY tid) AS best FROM frame) WHERE (n_exons > 1 AND side = '+') OR (n_exons = 1 AND side = best)",
       "frame AS (SELECT tid, n_exons, 31 AS s, cdna // 2 - 20 AS e, '+' AS side FROM transcript UNION ALL SELECT tid, n_exons, cdna // 2 + 10, cdna - 30, CASE WHEN tid % 2 = 0 THEN '-' ELSE '+' END FROM transcript)")
def orf_strand_filter(t) -> DataFrame:
    """Models of several exons keep frames of their own strand; of those of one exon the longest frame decides the strand."""
    frame = lambda s, e, side: F.struct(F.expr(s).alias("s"), F.expr(e).alias("e"), F.expr(side).alias("side"))
    both = F.array(frame("CAST(31 AS BIGINT)", "cdna div 2 - 20", "'+'"), frame("cdna div 2 + 10", "cdna - 30", "CASE WHEN tid % 2 = 0 THEN '-' ELSE '+' END"))
    d = t.transcript.select("tid", "n_exons", F.inline(both))
    best = F.first("side").over(Window.partitionBy("tid").orderBy(F.desc(F.col("e") - F.col("s")), "s"))
    d = d.withColumn("best", best)
    return d.filter("(n_exons > 1 AND side = '+') OR (n_exons = 1 AND side = best)").select("tid", "s", "e")

