"""Queries over text formats: rows to lines and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import graph
from splicedf.plans.registry import query
from splicedf.sources import formats

TAIL = "'.' || chr(9) || strand || chr(9) || '.' || chr(9)"
HEAD = "chrom || chr(9) || source || chr(9) || '{f}' || chr(9) || s || chr(9) || e || chr(9) || "
#: Coding segments with the phase of each.
PHASED = "ph AS (SELECT c.tid, c.gid, c.chrom, c.strand, x.source, c.s, c.e, CAST((3 - before % 3) % 3 AS INT) AS phase FROM (SELECT *, coalesce(CAST(sum(e - s + 1) OVER (PARTITION BY tid ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before FROM cds) c JOIN transcript x ON x.tid = c.tid)"
CODED = "'.' || chr(9) || strand || chr(9) || phase || chr(9)"
NAMES = "'gene_id \"' || gid || '\"; transcript_id \"' || tid || '\";'"


@query(f"SELECT tid, {HEAD.format(f='transcript')}{TAIL} || {NAMES} AS value FROM transcript UNION ALL SELECT tid, {HEAD.format(f='exon')}{TAIL} || {NAMES} FROM exon UNION ALL SELECT tid, {HEAD.format(f='CDS')}{CODED} || {NAMES} FROM ph", PHASED)
def sink_gtf(t) -> DataFrame:
    return formats.gtf_lines(t.transcript, t.exon, t.cds).select("tid", "value")


@query(f"SELECT tid, {HEAD.format(f='mRNA')}{TAIL} || 'ID=' || tid || ';Parent=' || gid AS value FROM transcript UNION ALL SELECT tid, {HEAD.format(f='exon')}{TAIL} || 'Parent=' || tid FROM exon UNION ALL SELECT tid, {HEAD.format(f='CDS')}{CODED} || 'Parent=' || tid FROM ph", PHASED)
def sink_gff3(t) -> DataFrame:
    return formats.gff3_lines(t.transcript, t.exon, t.cds).select("tid", "value")


@query("""SELECT t.tid, concat_ws(chr(9), t.chrom, t.s - 1, t.e, 'ID=' || t.tid || CASE WHEN c.cs IS NULL THEN ';coding=False' ELSE ';coding=True' END, '0', t.strand, coalesce(c.cs - 1, t.s - 1), coalesce(c.ce, t.s - 1), '0', t.n_exons, string_agg(CAST(x.e - x.s + 1 AS VARCHAR), ',' ORDER BY x.s), string_agg(CAST(x.s - t.s AS VARCHAR), ',' ORDER BY x.s)) AS value
  FROM transcript t JOIN exon x ON t.tid = x.tid LEFT JOIN (SELECT tid, min(s) AS cs, max(e) AS ce FROM cds GROUP BY tid) c ON c.tid = t.tid GROUP BY t.tid, t.chrom, t.s, t.e, t.strand, t.n_exons, c.cs, c.ce""")
def sink_bed12(t) -> DataFrame:
    return formats.bed12_lines(t.transcript, t.exon, t.cds)


BOTH = "SELECT CAST(tid AS VARCHAR) AS {tid}, 'exon' AS feature, chrom, strand, s, e, CAST(NULL AS INT) AS phase{more} FROM exon UNION ALL SELECT CAST(tid AS VARCHAR), 'CDS', chrom, strand, s, e, phase{more} FROM ph"
TAGS = ", 'basic,model_' || tid AS tag"


@query(BOTH.format(tid="tid", more=TAGS), PHASED)
def scan_gtf(t) -> DataFrame:
    """Exons and coding segments with phase, of lines with a repeated key."""
    lines = formats.gtf_lines(t.transcript, t.exon, t.cds)
    lines = lines.withColumn("value", F.concat("value", F.lit(' tag "basic"; tag "model_'), F.col("tid").cast("string"), F.lit('";')))
    return formats.scan_gtf(lines).filter("feature <> 'transcript'").select("tid", "feature", "chrom", "strand", "s", "e", "phase", F.col("attributes")["tag"].alias("tag"))


@query(BOTH.format(tid="parent", more=", 'a;b,c' AS note"), PHASED)
def scan_gff3(t) -> DataFrame:
    """Exons and coding segments with phase, of lines with an escaped and a repeated attribute."""
    lines = formats.gff3_lines(t.transcript, t.exon, t.cds).withColumn("value", F.concat("value", F.lit(";Note=a%3Bb;Note=c")))
    return formats.scan_gff3(lines).filter("feature <> 'mRNA'").select("parent", "feature", "chrom", "strand", "s", "e", "phase", F.col("attributes")["Note"].alias("note"))


@query(BOTH.format(tid="name", more=""), PHASED)
def scan_bed12(t) -> DataFrame:
    """Blocks, and the coding segments within the thick part."""
    d = formats.scan_bed12(formats.bed12_lines(t.transcript, t.exon, t.cds))
    cds = formats.bed12_cds(d).select(F.col("tid").alias("name"), F.lit("CDS").alias("feature"), "chrom", "strand", "s", "e", "phase")
    return d.select("name", F.lit("exon").alias("feature"), "chrom", "strand", "s", "e", F.lit(None).cast("int").alias("phase")).unionAll(cds)


@query("SELECT CAST(tid AS VARCHAR) AS tid, chrom, strand, s, e FROM exon")
def scan_cdna_match(t) -> DataFrame:
    """Models as alignments: rows of one ID for those of even number, a match and its parts for others, or the match alone
    where a model has one exon."""
    text, own = (lambda c: F.col(c).cast("string")), F.col("tid").cast("string")
    even = F.col("tid") % 2 == 0
    row = lambda kind, last: F.concat_ws("\t", "chrom", "source", F.lit(kind) if isinstance(kind, str) else kind, text("s"), text("e"), F.lit("."), "strand", F.lit("."), last)
    several = t.exon.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("tid"))).filter(even | (F.col("_n") > 1))
    parts = several.select(row(F.when(even, "cDNA_match").otherwise("match_part"), F.when(even, F.concat(F.lit("ID="), own, F.lit(";Target="), own, F.lit(" 1 9 +"))).otherwise(F.concat(F.lit("ID=p"), own, F.lit(";Parent="), own))).alias("value"))
    heads = t.transcript.filter(~even).select(row("match", F.concat(F.lit("ID="), own)).alias("value"))
    return formats.scan_cdna_match(heads.unionAll(parts)).select("tid", "chrom", "strand", "s", "e")


@query("SELECT f AS format, n_exons > 1 AS spliced, count(*) AS models, count(*) AS equal FROM transcript, (SELECT unnest(['gtf', 'gff3', 'bed12', 'sam', 'match']) AS f) GROUP BY 1, 2")
def format_agreement(t) -> DataFrame:
    """The same models through five formats: how many are exactly what they were."""
    t.keep("exon")
    key = lambda d: d.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("chrom", "strand", "s", "e"))).alias("x"))
    was = key(t.exon.select(F.col("tid").cast("string").alias("tid"), "chrom", "strand", "s", "e")).withColumnRenamed("x", "was")
    read = {
        "gtf": formats.model_exons(formats.scan_gtf(formats.gtf_lines(t.transcript, t.exon, t.cds))), "gff3": formats.model_exons(formats.scan_gff3(formats.gff3_lines(t.transcript, t.exon, t.cds)), "parent"),
        "bed12": formats.scan_bed12(formats.bed12_lines(t.transcript, t.exon, t.cds)).withColumnRenamed("name", "tid"), "sam": scan_sam_exons(t), "match": scan_cdna_match(t),
    }
    rows = [key(d.select("tid", "chrom", "strand", "s", "e")).join(was, "tid", "full").select(F.lit(f).alias("format"), (F.size("was") > 1).alias("spliced"), F.col("x").eqNullSafe(F.col("was")).alias("same")) for f, d in read.items()]
    return reduce(DataFrame.unionAll, rows).groupBy("format", "spliced").agg(F.count(F.lit(1)).alias("models"), F.count(F.when(F.col("same"), 1)).alias("equal"))


@query("SELECT DISTINCT chrom, strand, s, e FROM intron")
def scan_junction_bed(t) -> DataFrame:
    return formats.scan_junction_bed(formats.bed12_lines(t.transcript, t.exon))


@query("SELECT CAST(tid AS VARCHAR) AS tid, chrom, strand, s, e FROM exon")
def scan_sam_exons(t) -> DataFrame:
    """Transcripts written as alignments: exons are M, introns N."""
    cigar = t.exon.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("b"))
    ops = F.array_join(F.transform("b", lambda x, i: F.concat(F.when(i > 0, F.concat((x.s - F.get("b", i - 1).e - 1).cast("string"), F.lit("N"))).otherwise(F.lit("")), (x.e - x.s + 1).cast("string"), F.lit("M"))), "")
    d = t.transcript.join(cigar, "tid")
    lines = d.select(F.concat_ws("\t", F.col("tid").cast("string"), F.lit("0"), "chrom", F.col("s").cast("string"), F.lit("60"), ops, F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), F.concat(F.lit("XS:A:"), "strand")).alias("value"))
    return formats.scan_sam_exons(lines)


@query("SELECT CAST(tid AS VARCHAR) AS tid, CAST(gid AS VARCHAR) AS gid, 'exon' AS feature, chrom, s, e FROM exon UNION ALL SELECT CAST(tid AS VARCHAR), CAST(gid AS VARCHAR), 'CDS', chrom, s, e FROM cds")
def convert_format(t) -> DataFrame:
    """GTF to rows, to BED12, to rows again, coding segments with them."""
    rows = graph.stored(formats.scan_gtf(formats.gtf_lines(t.transcript, t.exon, t.cds)).select("tid", "gid", "feature", "chrom", "source", "strand", "s", "e"))
    of = lambda f: rows.filter(F.col("feature") == f)
    back = formats.scan_bed12(formats.bed12_lines(of("transcript"), of("exon"), of("CDS")))
    cds = formats.bed12_cds(back).select("tid", F.lit("CDS").alias("feature"), "chrom", "s", "e")
    back = back.select(F.col("name").alias("tid"), F.lit("exon").alias("feature"), "chrom", "s", "e").unionAll(cds)
    return back.join(of("transcript").select("tid", "gid"), "tid").select("tid", "gid", "feature", "chrom", "s", "e")


@query("SELECT chrom, s, e FROM transcript")
def scan_region_list(t) -> DataFrame:
    return formats.scan_regions(t.transcript.select(F.concat("chrom", F.lit(":"), F.col("s").cast("string"), F.when(F.col("tid") % 2 == 0, "-").otherwise(".."), F.col("e").cast("string")).alias("value")))
