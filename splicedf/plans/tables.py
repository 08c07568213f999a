"""Queries that write the tables beside annotations and read them back."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.operators import compare, graph, model
from splicedf.plans.comparison import MATCHES, best_sql, pair_sql, sides
from splicedf.plans.files import fresh, lines_of
from splicedf.plans.loci import ORF, orfs
from splicedf.plans.registry import query
from splicedf.sources import formats, tables

FRAME = "SELECT CAST(tid AS VARCHAR) AS tid, s, e, '+' AS strand, CAST({phase} AS INT) AS phase, tid % 2 = 0 AS complete FROM good"


@query(FRAME.format(phase="tid % 3"), ORF)
def scan_orf_bed12(t) -> DataFrame:
    """Two frames of each transcript as BED12 lines on it, beside lines without a thick part."""
    text = lambda c: F.col(c).cast("string")
    d = orfs(t).join(t.transcript.select("tid", "cdna"), "tid")
    name = F.concat(F.lit("ID="), text("tid"), F.lit(";phase="), (F.col("tid") % 3).cast("string"), F.when(F.col("tid") % 2 == 0, ";ORF_type=complete").otherwise(";ORF_type=internal"))
    line = lambda s, e: F.concat_ws("\t", text("tid"), F.lit("0"), text("cdna"), name, F.lit("0"), F.lit("+"), s, e, F.lit("0"), F.lit("1"), text("cdna"), F.lit("0"))
    lines = d.select("tid", line((F.col("s") - 1).cast("string"), text("e")).alias("value")).unionAll(d.select("tid", line(F.lit("0"), F.lit("0")).alias("value")))
    return tables.scan_orf_bed12(lines_of(t, lines, "frames"))


@query(FRAME.format(phase="0"), ORF)
def scan_orf_gff3(t) -> DataFrame:
    """The same frames as rows of a frame caller."""
    text = lambda c: F.col(c).cast("string")
    last = F.concat(F.lit("ID="), text("tid"), F.lit("_1;partial="), F.when(F.col("tid") % 2 == 0, "00").otherwise("10"), F.lit(";start_type=ATG"))
    lines = orfs(t).select("tid", F.concat_ws("\t", text("tid"), F.lit("caller"), F.lit("CDS"), text("s"), text("e"), F.lit("9.5"), F.lit("+"), F.lit("0"), last).alias("value"))
    return tables.scan_orf_gff3(lines_of(t, lines, "frames"))


@query("SELECT source || '.gtf' AS file, source AS label, source <> 'src0' AS stranded, CASE WHEN source = 'src3' THEN CAST(0 AS DOUBLE) ELSE CAST(count(DISTINCT gid) AS DOUBLE) / 4 END AS score, source = 'src1' AS is_reference, false AS exclude_redundant FROM transcript GROUP BY source")
def scan_input_sheet(t) -> DataFrame:
    """A sheet of one assembly a source, with short lines and comments."""
    d = t.transcript.groupBy("source").agg((F.count_distinct("gid") / 4).alias("w"))
    full = F.concat_ws("\t", F.concat("source", F.lit(".gtf")), "source", F.when(F.col("source") != "src0", "True").otherwise("False"), F.col("w").cast("string"), F.when(F.col("source") == "src1", "True").otherwise("False"))
    short = F.concat_ws("\t", F.concat("source", F.lit(".gtf")), "source", F.lit("True"))
    lines = d.select(F.when(F.col("source") == "src3", short).otherwise(full).alias("value")).unionAll(d.select(F.concat(F.lit("# "), "source").alias("value")))
    return tables.scan_input_sheet(lines_of(t, lines.withColumn("tid", F.lit(0)), "sheet"))


METRICS = {"cdna_length": "cdna", "exon_num": "n_exons", "is_reference": "CASE WHEN is_ref THEN 1 ELSE 0 END", "source_score": "CASE WHEN tid % 4 > 0 THEN tid % 4 END"}
LONG = " UNION ALL ".join(f"SELECT CAST(tid AS VARCHAR) AS tid, '{k}' AS metric, CAST({v} AS DOUBLE) AS value FROM transcript" for k, v in METRICS.items())


def metric_file(t) -> str:
    path = fresh(t, "metrics")
    d = t.transcript.select("tid", F.col("cdna").alias("cdna_length"), F.col("n_exons").alias("exon_num"), F.col("is_ref").alias("is_reference"), F.expr("CASE WHEN tid % 4 > 0 THEN tid % 4 END").alias("source_score"), F.col("source").alias("source"))
    tables.write_metrics(d, path)
    return path


@query(f"SELECT * FROM ({LONG}) WHERE value IS NOT NULL")
def scan_metrics(t) -> DataFrame:
    """A table of metrics, with flags, missing values and a column of text, as a row a model and metric."""
    return tables.scan_metrics(t.spark, metric_file(t))


@query("SELECT CAST(tid AS VARCHAR) AS tid, concat_ws(chr(9), tid, cdna, n_exons, is_ref, coalesce(CAST(CASE WHEN tid % 4 > 0 THEN tid % 4 END AS VARCHAR), 'NA'), source) AS line FROM transcript")
def sink_metrics_scores(t) -> DataFrame:
    """The lines of the table as they stand in its files."""
    d = t.spark.read.text(metric_file(t)).filter("NOT startswith(value, 'tid')")
    return d.select(F.split("value", "\t")[0].alias("tid"), F.col("value").alias("line"))


@query("SELECT CAST(b.tid AS VARCHAR) AS ref_id, CASE WHEN x.ccode IS NOT NULL THEN x.ccode END AS ccode, CAST(x.tid_a AS VARCHAR) AS tid, floor(x.n_f1 * 10000 + 0.5) / 100 AS n_f1, floor(x.j_f1 * 10000 + 0.5) / 100 AS j_f1 FROM tb b LEFT JOIN best x ON b.tid = x.tid_b", pair_sql(0) + ", near AS (SELECT * FROM coded), " + best_sql("tid_b", "tid_a"))
def sink_refmap(t) -> DataFrame:
    """The best prediction of each reference model as a table of files, read back; NA is null then."""
    path = fresh(t, "refmap")
    tables.write_refmap(compare.refmap(compare.compare_pairs(*sides(t)), model.transcript_bounds(t.exon).filter("is_ref")), path)
    return tables.scan_refmap(t.spark, path)


HITS = "SELECT CAST(query AS VARCHAR) AS query, qlen, CAST(target AS VARCHAR) AS target, tlen, CAST(n AS INT) AS n, CAST(bitscore AS DOUBLE) AS bitscore, CAST('1e-' || nlog AS DOUBLE) AS evalue, qstart, qend, CAST(1 AS BIGINT) AS tstart, CAST(1 + n AS BIGINT) AS tend, (qend - qstart + 1) // 2 AS identities, (qend - qstart + 1) * 2 // 3 AS positives, qend - qstart + 1 AS length"


@query(f"SELECT *, CAST(100 AS DOUBLE) * identities / length AS identity, CAST(100 AS DOUBLE) * positives / length AS ppos, true AS in_table FROM ({HITS} FROM (SELECT DISTINCT query, target, qstart, qend, nlog, bitscore, qlen, tlen, n FROM hsp))")
def scan_blast_xml(t) -> DataFrame:
    """Hits as nested XML, read back, each beside the same hit of a tabular file."""
    d = t.hsp.distinct().selectExpr("query", "qlen", "target", "tlen", "n", "CAST(bitscore AS DOUBLE) AS bitscore", "CAST(concat('1e-', nlog) AS DOUBLE) AS evalue", "qstart", "qend", "1L AS tstart", "CAST(1 + n AS BIGINT) AS tend", "(qend - qstart + 1) div 2 AS identities", "(qend - qstart + 1) * 2 div 3 AS positives", "qend - qstart + 1 AS length")
    d = graph.stored(d)
    path = fresh(t, "hits-xml")
    tables.write_blast_xml(d, path)
    columns = ("query", "target", "length", "qstart", "qend", "tstart", "tend", "evalue", "bitscore")
    text = [F.col(c).cast("string") for c in columns]
    tab = d.select(F.col("query").alias("tid"), F.concat_ws("\t", *text[:2], F.lit("50.0"), text[2], F.lit("0"), F.lit("0"), *text[3:]).alias("value"))
    known = formats.scan_blast_tab(lines_of(t, tab, "hits")).select(*columns).distinct().withColumn("in_table", F.lit(True))
    return tables.scan_blast_xml(t.spark, path).join(known, list(columns), "left").withColumn("in_table", F.coalesce("in_table", F.lit(False)))


OWN = ("span AS (SELECT tid, min(s) AS cs, max(e) AS ce FROM cds GROUP BY tid), exon_o AS (SELECT x.tid, x.gid, x.chrom, x.strand, greatest(x.s, coalesce(cs, x.s)) AS s, least(x.e, coalesce(ce, x.e)) AS e, x.is_ref, x.source FROM exon x LEFT JOIN span c ON c.tid = x.tid WHERE {keep}), "
       "transcript_o AS (SELECT tid, min(gid) AS gid, min(chrom) AS chrom, min(strand) AS strand, min(s) AS s, max(e) AS e, count(*) AS n_exons, CAST(sum(e - s + 1) AS BIGINT) AS cdna, bool_or(is_ref) AS is_ref FROM exon_o GROUP BY tid), "
       "intron_o AS (SELECT * FROM (SELECT tid, gid, chrom, strand, is_ref, e + 1 AS s, lead(s) OVER (PARTITION BY tid ORDER BY s) - 1 AS e FROM exon_o) WHERE e IS NOT NULL), ")  # fmt: skip


def under(keep: str) -> str:
    """The matches, over models changed by an option."""
    return OWN.format(keep=keep) + re.sub(r"\b(exon|transcript|intron)\b", r"\1_o", MATCHES)


@query("SELECT * FROM tm", under("cs IS NULL OR (x.s <= ce AND x.e >= cs)"))
def exclude_utr(t) -> DataFrame:
    """The matches of models without their untranslated ends."""
    t.keep("exon")
    t.keep("cds")
    return compare.tmap(*[compare.with_options(d, t.cds, exclude_utr=True) for d in sides(t)])


@query("SELECT * FROM tm", under("cs IS NOT NULL").replace("greatest(x.s, coalesce(cs, x.s)) AS s, least(x.e, coalesce(ce, x.e)) AS e", "x.s, x.e"))
def protein_coding(t) -> DataFrame:
    """The matches of coding predictions with coding reference models."""
    t.keep("exon")
    t.keep("cds")
    return compare.tmap(*[compare.with_options(d, t.cds, protein_coding=True) for d in sides(t)])
