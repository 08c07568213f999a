"""Tables that travel with annotations: reading frames on transcripts, the sheet of inputs, metrics and scores, reference maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splicedf.sources.formats import scan_gff3

#: Columns of the sheet of inputs, in order; what is missing at the end of a line takes the default.
SHEET = (("file", "string", None), ("label", "string", None), ("stranded", "boolean", "False"), ("score", "double", "0"), ("is_reference", "boolean", "False"), ("exclude_redundant", "boolean", "False"))
#: Columns of a reference map.
REFMAP = ("ref_id", "ccode", "tid", "n_f1", "j_f1")


def scan_orf_bed12(lines: DataFrame) -> DataFrame:
    """Frames (tid, s, e, strand, phase, complete) of BED12 lines on transcripts: the thick part, from 1; lines without one go.

    The name may say `phase=` and, as frame callers do, `type:complete` or `ORF_type=complete`.
    """
    f = F.split("value", "\t", -1)
    d = lines.filter(~F.col("value").rlike("^(#|track|browser)")).withColumn("_f", f).filter(F.size("_f") >= 12)
    at = lambda i: F.get("_f", F.lit(i))
    phase = F.nullif(F.regexp_extract(at(3), "phase=([0-2])", 1), F.lit("")).cast("int")
    d = d.select(at(0).alias("tid"), (at(6).cast("long") + 1).alias("s"), at(7).cast("long").alias("e"), at(5).alias("strand"), F.coalesce(phase, F.lit(0)).alias("phase"), F.lower(at(3)).rlike("type[:=]complete").alias("complete"))
    return d.filter("s <= e AND strand IN ('+', '-')")


def scan_orf_gff3(lines: DataFrame) -> DataFrame:
    """Frames (tid, s, e, strand, phase, complete) of GFF3 lines on transcripts: a CDS row each. A frame is complete if the
    caller's `partial` is 00, or missing."""
    d = scan_gff3(lines).filter("feature = 'CDS' AND s <= e AND strand IS NOT NULL")
    return d.select(F.col("chrom").alias("tid"), "s", "e", "strand", F.coalesce("phase", F.lit(0)).alias("phase"), (F.coalesce(F.col("attributes")["partial"], F.lit("00")) == "00").alias("complete"))


def scan_input_sheet(lines: DataFrame) -> DataFrame:
    """The sheet of inputs, a line each: file, label, stranded, score, is_reference, exclude_redundant, by tabs.

    Blank lines and comments go; columns after the second may be missing. A file or a label that occurs twice, or a line
    without a label, is an error when the rows are read.
    """
    f = F.transform(F.split("value", "\t", -1), lambda x: F.trim(x))
    d = lines.filter("trim(value) <> '' AND NOT startswith(trim(value), '#')").withColumn("_f", f)
    filled = lambda i, default: F.coalesce(F.nullif(F.get("_f", F.lit(i)), F.lit("")), F.lit(default))
    d = d.select(*[filled(i, default).cast(kind).alias(name) for i, (name, kind, default) in enumerate(SHEET)])
    for c in ("file", "label"):
        n = d.groupBy(F.col(c).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        fine = F.when(F.col(c).isNull(), F.raise_error(F.lit(f"a line without {c}"))).when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{c} named twice: "), F.col(c)))).otherwise(True)
        d = d.join(n, F.col(c).eqNullSafe(F.col("_k"))).filter(fine).drop("_k", "_n")
    return d


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A table of metrics or scores, a row a model, with a header; missing values are NA."""
    metrics.write.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)


def scan_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(tid, metric, value) of a table of metrics or scores: NA has no row, True and False are 1 and 0, other texts are left out."""
    d = spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)
    first, *names = d.columns
    value = lambda c: F.when(F.lower(c) == "true", 1.0).when(F.lower(c) == "false", 0.0).otherwise(c.try_cast("double"))
    each = F.array(*[F.struct(F.lit(n).alias("metric"), value(F.col(f"`{n}`")).alias("value")) for n in names])
    return d.select(F.col(f"`{first}`").alias("tid"), F.inline(each)).filter("value IS NOT NULL")


def write_refmap(refmap: DataFrame, path: str) -> None:
    """The best prediction of each reference model as a table with a header; rates in percent with two places, missing values NA."""
    percent = lambda c: (F.floor(F.col(c) * 10000 + 0.5) / 100).alias(c)
    refmap.select(F.col("tid_b").alias("ref_id"), "ccode", F.col("tid_a").alias("tid"), percent("n_f1"), percent("j_f1")).write.option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)


def scan_refmap(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).option("nullValue", "NA").schema("ref_id string, ccode string, tid string, n_f1 double, j_f1 double").csv(path)


#: The elements of an HSP, each with the column that it is.
HSP = (("Hsp_num", "n", "int"), ("Hsp_bit-score", "bitscore", "double"), ("Hsp_evalue", "evalue", "double"), ("Hsp_query-from", "qstart", "long"), ("Hsp_query-to", "qend", "long"), ("Hsp_hit-from", "tstart", "long"), ("Hsp_hit-to", "tend", "long"), ("Hsp_identity", "identities", "long"), ("Hsp_positive", "positives", "long"), ("Hsp_align-len", "length", "long"))
HSP_SCHEMA = ", ".join(f"`{e}`: {'bigint' if k == 'long' else k}" for e, _, k in HSP)
ITERATION = f"`Iteration_query-def` string, `Iteration_query-len` bigint, Iteration_hits struct<Hit: array<struct<Hit_id: string, Hit_len: bigint, Hit_hsps: struct<Hsp: array<struct<{HSP_SCHEMA}>>>>>>"


def write_blast_xml(hits: DataFrame, path: str) -> None:
    """HSPs (query, qlen, target, tlen and the columns of HSP) as nested XML: a query, its hits, their HSPs. Names of elements
    are most of the text, so the files are packed; the hits of a query are brought together once."""
    hits = hits.repartition("query")
    hsp = F.struct(*[F.col(c).cast(k).alias(e) for e, c, k in HSP])
    of = hits.groupBy("query", "qlen", "target", "tlen").agg(F.struct(F.array_sort(F.collect_list(hsp)).alias("Hsp")).alias("h"))
    one = F.struct(F.col("target").cast("string").alias("Hit_id"), F.col("tlen").cast("long").alias("Hit_len"), F.col("h").alias("Hit_hsps"))
    d = of.groupBy(F.col("query").cast("string").alias("Iteration_query-def"), F.col("qlen").cast("long").alias("Iteration_query-len")).agg(F.struct(F.array_sort(F.collect_list(one)).alias("Hit")).alias("Iteration_hits"))
    d.write.format("xml").option("rootTag", "BlastOutput_iterations").option("rowTag", "Iteration").option("indent", "").option("compression", "gzip").save(path)


def scan_blast_xml(spark: SparkSession, path: str) -> DataFrame:
    """(query, qlen, target, tlen, the columns of HSP, identity, ppos) of XML hits, a row an HSP; identity and positives also in
    percent of the aligned columns. Queries without hits have no row; a name ends at the first white space."""
    d = spark.read.format("xml").option("rowTag", "Iteration").schema(ITERATION).load(path)
    first = lambda c: F.regexp_extract(c, "^\\s*(\\S+)", 1)
    d = d.select(first(F.col("`Iteration_query-def`")).alias("query"), F.col("`Iteration_query-len`").alias("qlen"), F.explode("Iteration_hits.Hit").alias("t"))
    d = d.select("query", "qlen", first(F.col("t.Hit_id")).alias("target"), F.col("t.Hit_len").alias("tlen"), F.explode("t.Hit_hsps.Hsp").alias("h"))
    d = d.select("query", "qlen", "target", "tlen", *[F.col("h")[e].alias(c) for e, c, _ in HSP])
    return d.withColumns({"identity": 100.0 * F.col("identities") / F.col("length"), "ppos": 100.0 * F.col("positives") / F.col("length")})
