"""Queries that write annotation files to the shared folder, through Spark's writer, and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splicedf.operators import compare, graph, sequence
from splicedf.plans.comparison import MATCHES, sides
from splicedf.plans.loci import CDNA, dna
from splicedf.plans.registry import query
from splicedf.sources import formats


def fresh(t, name: str) -> str:
    return f"{graph.shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def lines_of(t, lines: DataFrame, name: str) -> DataFrame:
    """The lines, written as text files and read again."""
    path = fresh(t, name)
    formats.write_lines(lines, path)
    return t.spark.read.text(path)


def fasta_file(t) -> str:
    seq = sequence.cdna_sequence(dna(t.exon))
    path = fresh(t, "fasta")
    formats.fasta_lines(seq.select(F.concat(F.lit("t"), F.col("tid").cast("string")).alias("name"), "seq")).select("value").write.text(path)
    return path


@query("SELECT 't' || tid AS name, seq, CAST(length(seq) AS INT) AS length FROM cdna", CDNA)
def scan_fasta(t) -> DataFrame:
    """Transcripts as wrapped FASTA records, read by record."""
    return formats.scan_fasta(t.spark, fasta_file(t))


@query("SELECT 't' || tid AS name, CAST(1 + length(seq) // 60 + CASE WHEN length(seq) % 60 > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_lines, rtrim(regexp_replace(seq, '(.{60})', '\\1|', 'g'), '|') AS text FROM cdna", CDNA)
def sink_fasta(t) -> DataFrame:
    """Lines of each record of the file: a header, and sequence lines of 60."""
    d = t.spark.read.option("lineSep", "\n>").text(fasta_file(t)).withColumn("value", F.ltrim("value", F.lit(">")))
    lines = F.filter(F.split("value", "\n"), lambda x: F.length(F.trim(x)) > 0)
    return d.select(F.regexp_extract("value", "^(\\S+)", 1).alias("name"), F.size(lines).cast("long").alias("n_lines"), F.array_join(F.slice(lines, 2, F.size(lines) - 1), "|").alias("text"))


@query("SELECT 't' || tid AS name, cdna AS length FROM transcript")
def scan_fai(t) -> DataFrame:
    """An index of sequences: name and length, then columns of places that are not read."""
    d = t.transcript.select("tid", F.concat_ws("\t", F.concat(F.lit("t"), F.col("tid").cast("string")), F.col("cdna").cast("string"), F.lit("0"), F.lit("60"), F.lit("61")).alias("value"))
    return formats.scan_fai(lines_of(t, d, "fai"))


@query("SELECT CAST(query AS VARCHAR) AS query, CAST(target AS VARCHAR) AS target, CAST(90.5 AS DOUBLE) AS identity, qend - qstart + 1 AS length, qstart, qend, CAST(1 AS BIGINT) AS tstart, n + 9 AS tend, CAST('1e-' || nlog AS DOUBLE) AS evalue, CAST(bitscore AS DOUBLE) AS bitscore, CASE WHEN n % 2 = 0 THEN CAST(95 AS DOUBLE) END AS ppos, CASE WHEN n % 2 = 0 THEN '10AB' || n END AS btop FROM hsp")
def scan_blast_tab(t) -> DataFrame:
    """Tabular hits, every second one with positives and a trace; comment lines and lines of too few columns go."""
    h = t.hsp
    text = lambda c: F.col(c).cast("string")
    d = h.select(F.col("query").alias("tid"), F.concat_ws("\t", text("query"), text("target"), F.lit("90.5"), (F.col("qend") - F.col("qstart") + 1).cast("string"), F.lit("0"), F.lit("0"), text("qstart"), text("qend"), F.lit("1"), (F.col("n") + 9).cast("string"), F.concat(F.lit("1e-"), text("nlog")), F.col("bitscore").cast("double").cast("string"), F.when(F.col("n") % 2 == 0, F.concat(F.lit("95.0\t10AB"), text("n")))).alias("value"))
    odd = t.transcript.select("tid", F.when(F.col("tid") % 2 == 0, "# hits of a query").otherwise("too\tfew").alias("value"))
    return formats.scan_blast_tab(lines_of(t, d.unionAll(odd), "hits"))


@query("SELECT CAST(tid AS VARCHAR) AS tid, CASE WHEN tid % 2 = 0 THEN CAST(gid AS VARCHAR) END AS gid FROM transcript WHERE tid % 5 <> 0")
def scan_id_list(t) -> DataFrame:
    """A model a line, with its gene or without; blank lines and comments go."""
    own = F.when(F.col("tid") % 5 == 0, F.when(F.col("tid") % 2 == 0, "  ").otherwise("# no id")).when(F.col("tid") % 2 == 0, F.concat_ws("\t", F.col("tid").cast("string"), F.col("gid").cast("string"))).otherwise(F.col("tid").cast("string"))
    return formats.scan_id_list(lines_of(t, t.transcript.select("tid", own.alias("value")), "ids"))


@query("SELECT CAST(tid AS VARCHAR) AS tid, 'length' AS source, CAST(cdna AS DOUBLE) AS score FROM transcript UNION ALL SELECT CAST(tid AS VARCHAR), 'exons', CASE WHEN tid % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(n_exons AS DOUBLE) END FROM transcript WHERE tid % 7 <> 0")
def scan_external_tsv(t) -> DataFrame:
    """A table with a header: the first column names the model, each other is a score; blank ones are left out, NaN is 0."""
    path = fresh(t, "external")
    exons = F.when(F.col("tid") % 7 == 0, None).when(F.col("tid") % 3 == 0, "NaN").otherwise(F.col("n_exons").cast("string"))
    t.transcript.select("tid", F.col("cdna").alias("length"), exons.alias("exons")).write.option("sep", "\t").option("header", True).csv(path)
    return formats.scan_external(t.spark, path)


WHOLE = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("ref_id", "ref_gene", "tid", "gid"))
PERCENT = ", ".join(f"floor({r} * 10000 + 0.5) / 100 AS {r}" for r in formats.TMAP_RATES)


@query(f"SELECT {WHOLE}, ccode, CAST(tid_num_exons AS INT) AS tid_num_exons, CAST(ref_num_exons AS INT) AS ref_num_exons, {PERCENT}, distance, location FROM tm", MATCHES)
def sink_tmap(t) -> DataFrame:
    """The matches of each prediction as a table of eighteen columns with a header, written and read back."""
    path = fresh(t, "tmap")
    formats.write_tmap(compare.tmap(*sides(t)), path)
    return formats.scan_tmap(t.spark, path)


@query("SELECT ccode, ref_gene IS NULL AS unmatched, count(*) AS n, round(avg(floor(n_f1 * 10000 + 0.5) / 100), 6) AS mean_n_f1 FROM tm GROUP BY 1, 2", MATCHES)
def scan_tmap(t) -> DataFrame:
    """Class codes of a written table, counted, with the mean F1 of bases."""
    path = fresh(t, "tmap")
    formats.write_tmap(compare.tmap(*sides(t)), path)
    return formats.scan_tmap(t.spark, path).groupBy("ccode", F.col("ref_gene").isNull().alias("unmatched")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_f1"), 6).alias("mean_n_f1"))


@query("SELECT source || '_' || tid AS tid, source || '_' || gid AS gid, source AS label, chrom, s, e FROM exon")
def union_assemblies(t) -> DataFrame:
    """An assembly of each source as a file, read under labels that make their names unique."""
    parts = []
    for label in ("src0", "src1", "src2", "src3"):
        own = F.col("source") == label
        rows = formats.scan_gtf(lines_of(t, formats.gtf_lines(t.transcript.filter(own), t.exon.filter(own)), f"assembly-{label}"))
        parts.append((label, rows.filter("feature = 'exon'")))
    return formats.union_assemblies(parts).select("tid", "gid", "label", "chrom", "s", "e")


def by_file(t, lines: DataFrame, name: str) -> DataFrame:
    """Lines (source, value), a folder a source, written as text and read again as (file, value)."""
    path = fresh(t, name)
    lines.select(F.col("source").alias("file"), "value").write.partitionBy("file").text(path)
    return t.spark.read.text(path)


def tabbed(name: str, total, mean) -> Column:
    return F.concat_ws("\t", F.lit(name), total if isinstance(total, Column) else F.lit(total), mean)


@query("SELECT source AS file, CAST(count(DISTINCT gid) AS DOUBLE) AS genes, CAST(count(DISTINCT CASE WHEN top = 1 THEN gid END) AS DOUBLE) AS monoexonic_genes, CAST(count(*) AS DOUBLE) AS transcripts, CAST(count(*) AS DOUBLE) / count(DISTINCT gid) AS transcripts_per_gene, CAST(sum(cdna) AS DOUBLE) / count(*) AS transcript_len_mean, CAST(count(CASE WHEN n_exons = 1 THEN 1 END) AS DOUBLE) AS monoexonic_transcripts, CAST(sum(n_exons) AS DOUBLE) AS exons, CAST(sum(n_exons) AS DOUBLE) / count(*) AS exons_per_transcript, CAST(sum(cdna) AS DOUBLE) / sum(n_exons) AS exon_len_mean FROM (SELECT *, max(n_exons) OVER (PARTITION BY source, gid) AS top FROM transcript) GROUP BY source")
def assembly_summary(t) -> DataFrame:
    """Statistics files, one a source, collected to a row each."""
    genes = t.transcript.groupBy("source", "gid").agg(F.count(F.lit(1)).alias("n"), F.sum("n_exons").alias("x"), F.max("n_exons").alias("top"), F.sum("cdna").alias("b"), F.count(F.when(F.col("n_exons") == 1, 1)).alias("m"))
    d = genes.groupBy("source").agg(F.count(F.lit(1)).alias("g"), F.count(F.when(F.col("top") == 1, 1)).alias("mg"), F.sum("n").alias("n"), F.sum("x").alias("x"), F.sum("b").alias("b"), F.sum("m").alias("m"))
    text, na = (lambda c: F.format_number(c, 0)), F.lit("NA")
    mean = lambda a, b: (F.col(a) / F.col(b)).cast("string")
    rows = [F.lit("Stat\tTotal\tAverage"), tabbed("Number of genes", text("g"), na), tabbed("Number of monoexonic genes", text("mg"), na), tabbed("Transcripts per gene", text("n"), mean("n", "g")), tabbed("CDNA lengths", text("b"), mean("b", "n")),
            tabbed("Monoexonic transcripts", text("m"), na), tabbed("Exons per transcript", text("x"), mean("x", "n")), tabbed("Exon lengths", "NA", mean("b", "x"))]
    return formats.assembly_summary(by_file(t, d.select("source", F.explode(F.array(*rows)).alias("value")), "stats"))


@query("SELECT source AS file, count(*) AS sequences, count(CASE WHEN n_exons > 1 THEN 1 END) AS reads_mapped, CAST(0 AS BIGINT) AS reads_mapped_and_paired, count(CASE WHEN n_exons = 1 THEN 1 END) AS reads_unmapped, CAST(0 AS BIGINT) AS reads_properly_paired, CAST(0 AS BIGINT) AS reads_paired, CAST(0 AS BIGINT) AS reads_duplicated, count(CASE WHEN cdna < 300 THEN 1 END) AS \"reads_MQ0\" FROM transcript GROUP BY source")
def alignment_summary(t) -> DataFrame:
    """Counters of models in the form of alignment statistics, one file a source; other lines do not count."""
    n = lambda c: F.count(F.when(F.expr(c), 1)).cast("string")
    d = t.transcript.groupBy("source").agg(*[n(c).alias(k) for k, c in (("a", "true"), ("m", "n_exons > 1"), ("u", "n_exons = 1"), ("q", "cdna < 300"))])
    line = lambda name, c: F.concat_ws("\t", F.lit("SN"), F.lit(name), F.col(c), F.lit("# note"))
    rows = [F.lit("# statistics"), line("sequences:", "a"), line("reads mapped:", "m"), line("reads unmapped:", "u"), line("reads MQ0:", "q"), F.concat_ws("\t", F.lit("FFQ"), F.lit("sequences:"), F.lit("9"))]
    return formats.alignment_summary(by_file(t, d.select("source", F.explode(F.array(*rows)).alias("value")), "alignments"))
