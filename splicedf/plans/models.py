"""Queries over single models: bounds, introns, coding segments, edits, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import model
from splicedf.plans.registry import query

SITE = "site AS (SELECT tid, chrom, strand, s AS pos, CASE WHEN strand = '+' THEN 'donor' ELSE 'acceptor' END AS kind FROM intron UNION ALL SELECT tid, chrom, strand, e, CASE WHEN strand = '+' THEN 'acceptor' ELSE 'donor' END FROM intron)"
CHAIN = "chain AS (SELECT tid, min(chrom) AS chrom, min(strand) AS strand, string_agg(s || '-' || e, ',' ORDER BY s) AS chain, count(*) AS n_introns FROM intron GROUP BY tid)"
SPAN = "span AS (SELECT tid, min(s) AS cs, max(e) AS ce, sum(e - s + 1) AS n, count(*) AS k FROM cds GROUP BY tid)"
UTR = SPAN + """, utr0 AS (SELECT x.tid, x.s, x.e, x.strand, -1 AS way, x.s AS us, least(x.e, p.cs - 1) AS ue FROM exon x JOIN span p ON x.tid = p.tid
  UNION ALL SELECT x.tid, x.s, x.e, x.strand, 1, greatest(x.s, p.ce + 1), x.e FROM exon x JOIN span p ON x.tid = p.tid),
utr AS (SELECT tid, CASE WHEN (way < 0) = (strand = '+') THEN 'five' ELSE 'three' END AS side, us AS s, ue AS e, us = s AND ue = e AS complete FROM utr0 WHERE us <= ue)"""
ALONG = "ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
OFFSET = f"off AS (SELECT *, coalesce(CAST(sum(e - s + 1) OVER (PARTITION BY tid {ALONG}) AS BIGINT), 0) AS \"offset\" FROM exon)"
RUN = f"run AS (SELECT *, coalesce(CAST(sum(e - s + 1) OVER (PARTITION BY tid {ALONG}) AS BIGINT), 0) AS before FROM cds)"


def isl(source: str, keys: str, joins: str, name: str = "isl") -> str:
    w = f"PARTITION BY {keys} ORDER BY s, e"
    return f"{name}0 AS (SELECT *, max(e) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM {source}), {name} AS (SELECT *, sum(CASE WHEN top IS NOT NULL AND ({joins}) THEN 0 ELSE 1 END) OVER ({w}) AS island FROM {name}0)"


@query("SELECT tid, gid, chrom, strand, s, e, n_exons, cdna, is_ref, source FROM transcript")
def transcript_bounds(t) -> DataFrame:
    return t.transcript


@query("SELECT gid, chrom, s, e, n_tx, max_exons, n_coding FROM gene")
def gene_bounds(t) -> DataFrame:
    return t.gene


@query("SELECT tid, gid, chrom, strand, is_ref, s, e FROM intron")
def introns(t) -> DataFrame:
    return t.intron


@query("SELECT tid, chrom, strand, pos, kind FROM site", SITE)
def splice_sites(t) -> DataFrame:
    return model.splice_sites(t.intron)


@query("SELECT DISTINCT i.tid, i.s, i.e FROM intron i JOIN (SELECT tid, e + 1 AS s, lead(s) OVER (PARTITION BY tid ORDER BY s) - 1 AS e FROM cds) c ON i.tid = c.tid AND i.s = c.s AND i.e = c.e")
def cds_introns(t) -> DataFrame:
    return model.cds_introns(t.cds, t.intron)


@query("SELECT tid, chrom, strand, chain, n_introns FROM chain", CHAIN)
def intron_chain_key(t) -> DataFrame:
    return model.intron_chain(t.intron)


@query("SELECT tid, side, s, e, complete FROM utr", UTR)
def utr_segments(t) -> DataFrame:
    return model.utr_segments(t.exon, t.cds)


@query("SELECT tid, s, e, CAST(((-before) % 3 + 3) % 3 AS INT) AS phase FROM run", RUN)
def cds_phase(t) -> DataFrame:
    return model.cds_phase(t.cds).select("tid", "s", "e", "phase")


@query("SELECT tid, s, e, before FROM run", RUN)
def cds_running_length(t) -> DataFrame:
    return model.cds_running_length(t.cds).select("tid", "s", "e", "before")


@query('SELECT tid, s, e, "offset" FROM off', OFFSET)
def exon_cumulative_offset(t) -> DataFrame:
    return model.exon_cumulative_offset(t.exon).select("tid", "s", "e", "offset")


@query("SELECT tid, s, e, CAST(before % 3 AS INT) AS frame FROM run", RUN)
def codon_frames(t) -> DataFrame:
    return model.codon_frames(t.cds)


@query("SELECT p.tid, p.pos, o.\"offset\" + CASE WHEN o.strand = '-' THEN o.e - p.pos ELSE p.pos - o.s END + 1 AS cdna_pos FROM (SELECT tid, cs AS pos FROM span UNION ALL SELECT tid, ce FROM span) p JOIN off o ON p.tid = o.tid AND p.pos BETWEEN o.s AND o.e", OFFSET + ", " + SPAN)
def genome_to_cdna(t) -> DataFrame:
    span = t.cds.groupBy("tid").agg(F.min("s").alias("a"), F.max("e").alias("b"))
    return model.genome_to_cdna(t.exon, span.select("tid", F.explode(F.array("a", "b")).alias("pos")))


@query("""SELECT tid, CASE WHEN strand = '-' THEN e - b + 1 ELSE s + a - 1 END AS s, CASE WHEN strand = '-' THEN e - a + 1 ELSE s + b - 1 END AS e FROM
  (SELECT o.*, greatest(31 - "offset", 1) AS a, least(t.cdna // 2 - "offset", o.e - o.s + 1) AS b FROM off o JOIN transcript t ON o.tid = t.tid WHERE t.cdna // 2 > "offset" AND 31 <= "offset" + o.e - o.s + 1)""", OFFSET)
def cdna_to_genome(t) -> DataFrame:
    return model.cdna_to_genome(t.exon, t.transcript.select("tid", F.lit(31).alias("cs"), F.expr("cdna div 2").alias("ce")))


@query("SELECT tid, min(s) AS s, max(e) AS e FROM isl GROUP BY tid, island", UTR + ", seg AS (SELECT tid, s, e FROM cds UNION ALL SELECT tid, s, e FROM utr), " + isl("seg", "tid", "s <= top + 1"))
def exons_from_cds_utr(t) -> DataFrame:
    u = model.utr_segments(t.exon, t.cds)
    return model.exons_from_cds_utr(t.cds.select("tid", "s", "e").unionAll(u.select("tid", "s", "e")))[0]


@query("SELECT tid, part, s, e FROM (SELECT tid, CAST(island AS BIGINT) AS part, s, e, is_ref, sum(e - s + 1) OVER (PARTITION BY tid, island) AS n FROM isl) WHERE is_ref OR n >= 200", isl("exon", "tid", "is_ref OR s - top - 1 <= 400"))
def split_long_introns(t) -> DataFrame:
    return model.split_long_introns(t.exon, 400, 200).select("tid", "part", "s", "e")


@query("SELECT tid, min(s) AS s, max(e) AS e FROM isl GROUP BY tid, island", isl("exon", "tid", "s - top - 1 < 330"))
def merge_tiny_introns(t) -> DataFrame:
    return model.merge_tiny_introns(t.exon, 330)


@query("""SELECT tid, CASE WHEN i = 1 AND n > 1 THEN greatest(s, least(e - 99, coalesce(cs, e))) ELSE s END AS s, CASE WHEN i = n AND n > 1 THEN least(e, greatest(s + 99, coalesce(ce, s))) ELSE e END AS e
  FROM (SELECT x.tid, x.s, x.e, row_number() OVER (PARTITION BY x.tid ORDER BY x.s) AS i, count(*) OVER (PARTITION BY x.tid) AS n, p.cs, p.ce FROM exon x LEFT JOIN span p ON x.tid = p.tid)""", SPAN)
def trim_terminal_exons(t) -> DataFrame:
    return model.trim_terminal_exons(t.exon, t.cds, 100)


@query("SELECT x.tid, greatest(x.s, p.cs) AS s, least(x.e, p.ce) AS e FROM exon x JOIN span p ON x.tid = p.tid WHERE x.s <= p.ce AND x.e >= p.cs", SPAN)
def remove_utrs(t) -> DataFrame:
    return model.remove_utrs(t.exon, t.cds)


@query("""SELECT x.tid, x.s, x.e FROM exon x JOIN span p ON x.tid = p.tid LEFT JOIN
  (SELECT i.tid, max(CASE WHEN i.e < p.cs THEN i.e END) AS low, min(CASE WHEN i.s > p.ce THEN i.s END) AS high FROM intron i JOIN span p ON i.tid = p.tid WHERE i.e - i.s + 1 > 350 GROUP BY i.tid) c ON x.tid = c.tid
  WHERE (c.low IS NULL OR x.s > c.low) AND (c.high IS NULL OR x.e < c.high)""", SPAN)
def trim_long_utr_introns(t) -> DataFrame:
    return model.trim_long_utr_introns(t.exon, t.cds, 350)


@query("""SELECT x.tid, x.overlapping, x.mixed_strand, coalesce(p.cs < x.ts OR p.ce > x.te, false) AS cds_outside, coalesce(p.n % 3 <> 0, false) AS cds_broken FROM
  (SELECT tid, coalesce(bool_or(s <= top), false) AS overlapping, min(strand) <> max(strand) AS mixed_strand, min(s) AS ts, max(e) AS te FROM isl0 GROUP BY tid) x LEFT JOIN span p ON x.tid = p.tid""", SPAN + ", " + isl("exon", "tid", "true"))
def model_validity(t) -> DataFrame:
    return model.model_validity(t.exon, t.cds)


@query("SELECT c.tid, c.s, c.e FROM cds c JOIN span p ON c.tid = p.tid WHERE p.n % 3 = 0", SPAN)
def strip_cds(t) -> DataFrame:
    bad = model.model_validity(t.exon, t.cds).filter("cds_broken").select("tid")
    return t.cds.join(bad, "tid", "left_anti").select("tid", "s", "e")


@query("SELECT tid, s, e, CASE WHEN tid % 2 = 0 THEN translate(strand, '+-', '-+') ELSE strand END AS strand FROM exon")
def reverse_strand(t) -> DataFrame:
    return model.reverse_strand(t.exon, F.col("tid") % 2 == 0).select("tid", "s", "e", "strand")


@query("SELECT tid, gid, s, e FROM transcript WHERE tid % 4 <> 0")
def filter_coding(t) -> DataFrame:
    return t.transcript.join(t.cds.select("tid"), "tid", "left_semi").select("tid", "gid", "s", "e")


@query("SELECT tid, gid, s, e FROM transcript WHERE tid % 4 <> 0 AND is_ref")
def filter_protein_coding_ref(t) -> DataFrame:
    return t.transcript.filter("is_ref").join(t.cds.select("tid"), "tid", "left_semi").select("tid", "gid", "s", "e")


@query("SELECT tid, chrom, s, e FROM transcript WHERE (chrom = 'chr1' AND s >= 20000 AND e <= 60000) OR (chrom = 'chr3' AND s >= 15000 AND e <= 30000)")
def filter_region(t) -> DataFrame:
    regions = t.spark.createDataFrame([("chr1", 20000, 60000), ("chr3", 15000, 30000)], "chrom string, s long, e long")
    return model.contained_in(t.transcript, regions).select("tid", "chrom", "s", "e")


@query("SELECT tid, gid FROM transcript WHERE gid IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0)")
def filter_ids(t) -> DataFrame:
    ids = t.spark.read.parquet(f"{t.sf_dir}/customer.parquet").filter("c_custkey % 7 = 0").select(F.col("c_custkey").alias("gid"))
    return t.transcript.join(ids, "gid", "left_semi").select("tid", "gid")


@query("SELECT tid, gid FROM transcript WHERE gid NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0)")
def filter_ids_reverse(t) -> DataFrame:
    ids = t.spark.read.parquet(f"{t.sf_dir}/customer.parquet").filter("c_custkey % 7 = 0").select(F.col("c_custkey").alias("gid"))
    return t.transcript.join(ids, "gid", "left_anti").select("tid", "gid")


@query("SELECT tid, cdna FROM transcript WHERE cdna >= 200 OR is_ref")
def filter_min_length(t) -> DataFrame:
    return t.transcript.filter("cdna >= 200 OR is_ref").select("tid", "cdna")


@query("SELECT tid, n_exons FROM transcript WHERE tid NOT IN (SELECT tid FROM intron WHERE e - s + 1 > 1000)")
def filter_max_intron(t) -> DataFrame:
    return t.transcript.join(t.intron.filter("e - s + 1 > 1000").select("tid"), "tid", "left_anti").select("tid", "n_exons")


@query("SELECT chrom, s, e, strand, tid, CAST(row_number() OVER (PARTITION BY chrom ORDER BY s, e, strand, tid) AS BIGINT) AS n FROM transcript")
def sort_genomic(t) -> DataFrame:
    return t.transcript.withColumn("n", F.row_number().over(Window.partitionBy("chrom").orderBy("s", "e", "strand", "tid")).cast("long")).select("chrom", "s", "e", "strand", "tid", "n")


@query("SELECT tid, CAST(sum(e - s + 1) AS BIGINT) AS cdna_length, count(*) AS exon_num, max(e - s + 1) AS max_exon_length, min(e - s + 1) AS min_exon_length FROM exon GROUP BY tid")
def metrics_cdna(t) -> DataFrame:
    return model.cdna_metrics(t.exon)


@query("""SELECT t.tid, coalesce(max(i.e - i.s + 1), 0) AS max_intron_length, coalesce(min(i.e - i.s + 1), 0) AS min_intron_length, count(CASE WHEN i.e - i.s + 1 > 10000 THEN 1 END) AS num_introns_greater_than_max,
  count(CASE WHEN i.e - i.s + 1 < 60 THEN 1 END) AS num_introns_smaller_than_min FROM transcript t LEFT JOIN intron i ON t.tid = i.tid GROUP BY t.tid""")
def metrics_intron(t) -> DataFrame:
    return model.intron_metrics(t.exon, t.intron)


@query("SELECT t.tid, CAST(coalesce(p.n, 0) AS BIGINT) AS combined_cds_length, coalesce(p.k, 0) AS combined_cds_num, coalesce(p.n, 0) / t.cdna AS combined_cds_fraction, coalesce(p.k, 0) / t.n_exons AS combined_cds_num_fraction FROM transcript t LEFT JOIN span p ON t.tid = p.tid", SPAN)
def metrics_cds_combined(t) -> DataFrame:
    return model.cds_metrics(t.exon, t.cds)


@query("""SELECT p.tid, CAST(coalesce(sum(CASE WHEN side = 'five' THEN e - s + 1 END), 0) AS BIGINT) AS five_utr_length, CAST(coalesce(sum(CASE WHEN side = 'three' THEN e - s + 1 END), 0) AS BIGINT) AS three_utr_length,
  count(CASE WHEN side = 'five' THEN 1 END) AS five_utr_num, count(CASE WHEN side = 'three' THEN 1 END) AS three_utr_num, count(CASE WHEN side = 'five' AND complete THEN 1 END) AS five_utr_num_complete,
  count(CASE WHEN side = 'three' AND complete THEN 1 END) AS three_utr_num_complete FROM span p LEFT JOIN utr u ON p.tid = u.tid GROUP BY p.tid""", UTR)
def metrics_utr(t) -> DataFrame:
    return model.utr_metrics(t.exon, t.cds)


@query("""SELECT tid, CAST(coalesce(sum(before), 0) AS BIGINT) AS start_distance_from_tss, CAST(coalesce(sum(after), 0) AS BIGINT) AS end_distance_from_tes, CAST(coalesce(sum(CASE WHEN NOT last THEN after END), 0) AS BIGINT) AS end_distance_from_junction FROM
  (SELECT x.tid, CASE WHEN x.strand = '-' THEN greatest(0, x.e - greatest(x.s, p.ce + 1) + 1) ELSE greatest(0, least(x.e, p.cs - 1) - x.s + 1) END * CASE WHEN p.tid IS NULL THEN 0 ELSE 1 END AS before, CASE WHEN x.strand = '-' THEN greatest(0, least(x.e, p.cs - 1) - x.s + 1) ELSE greatest(0, x.e - greatest(x.s, p.ce + 1) + 1) END * CASE WHEN p.tid IS NULL THEN 0 ELSE 1 END AS after,
  row_number() OVER (PARTITION BY x.tid ORDER BY CASE WHEN x.strand = '-' THEN x.s ELSE -x.s END) = 1 AS last FROM exon x LEFT JOIN span p ON x.tid = p.tid) GROUP BY tid""", SPAN)
def metrics_distances(t) -> DataFrame:
    return model.cds_distances(t.exon, t.cds)


@query("""SELECT t.tid, t.n_exons, t.cdna, CAST(coalesce(i.n, 0) AS BIGINT) AS intronic, CAST(coalesce(p.n, 0) AS BIGINT) AS cds FROM transcript t LEFT JOIN (SELECT tid, sum(e - s) AS n FROM intron GROUP BY tid) i ON t.tid = i.tid LEFT JOIN span p ON t.tid = p.tid""", SPAN)
def transcript_tab_stats(t) -> DataFrame:
    i = t.intron.groupBy("tid").agg(F.sum(F.col("e") - F.col("s")).alias("intronic"))
    c = t.cds.groupBy("tid").agg(F.sum(F.col("e") - F.col("s") + 1).alias("cds"))
    return t.transcript.select("tid", "n_exons", "cdna").join(i, "tid", "left").join(c, "tid", "left").na.fill(0)
