"""Annotation text formats, as columns: lines to rows and rows to lines. Files go through Spark's text reader and writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splicedf.operators.model import cds_phase

FIELDS = ("chrom", "source", "feature", "s", "e", "score", "strand", "phase")


def _once(d: DataFrame, **columns: Column) -> DataFrame:
    """d with these columns, made once a row: a plain column that later ones and filters use is made anew for each of them."""
    return d.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _rows(lines: DataFrame) -> DataFrame:
    """The nine tab fields of every line that has them; comments and other lines go."""
    d = _once(lines.filter(~F.col("value").startswith("#")), _f=F.split("value", "\t", -1)).filter(F.size("_f") == 9)
    blank = lambda i: F.when(F.col("_f")[i] != ".", F.col("_f")[i])
    return d.select(F.col("_f")[0].alias("chrom"), blank(1).alias("source"), F.col("_f")[2].alias("feature"), F.col("_f")[3].cast("long").alias("s"), F.col("_f")[4].cast("long").alias("e"), blank(5).cast("double").alias("score"), F.when(F.col("_f")[6].isin("+", "-"), F.col("_f")[6]).alias("strand"), blank(7).cast("int").alias("phase"), F.col("_f")[8].alias("_a"))


def _folded(keys: Column, values: Column) -> Column:
    """A map of keys to values; the values of a repeated key are joined by commas, in order."""
    joined = F.map_from_entries(F.transform(F.array_distinct(keys), lambda k: F.struct(k, F.array_join(F.filter(values, lambda v, i: F.get(keys, i) == k), ","))))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, values)).otherwise(joined)


def scan_gtf(lines: DataFrame) -> DataFrame:
    """Rows with a map of attributes, each `key "value";` or `key value;`; rows without gene_id go. Values of a repeated key,
    such as tag, are joined by commas."""
    item = r'%s[A-Za-z_][A-Za-z0-9_]*%s +%s"[^"]*"|[^";]+)'
    k, v = (F.regexp_extract_all("_a", F.lit(p), F.lit(1)) for p in (item % ("(", ")", "(?:"), item % ("", "", "(")))
    bare = lambda x: F.when(F.startswith(x, F.lit('"')), F.replace(x, F.lit('"'), F.lit(""))).otherwise(F.trim(x))
    d = _once(_once(_rows(lines), _k=k, _v=F.transform(v, bare)), attributes=_folded(F.col("_k"), F.col("_v"))).drop("_a", "_k", "_v")
    return d.filter(F.col("attributes")["gene_id"].isNotNull()).withColumns({"gid": F.col("attributes")["gene_id"], "tid": F.col("attributes")["transcript_id"]})


def _decoded(text: Column) -> Column:
    """%-escapes as the characters they stand for; a plus sign is itself, and a text with a faulty escape stays as it is."""
    return F.when(F.contains(text, F.lit("%")), F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)).otherwise(text)


def scan_gff3(lines: DataFrame) -> DataFrame:
    """Rows with a map of attributes, their escapes decoded; a row of several parents is a row for each of them. Values of a
    repeated key are joined by commas; a comma within a parent's name is escaped in the file."""
    parts = F.filter(F.transform(F.split("_a", ";"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    escaped = lambda c, f: F.when(F.contains(F.col("_a"), F.lit("%")), f(c)).otherwise(c)
    d = _once(_rows(lines), _p=parts)
    d = _once(d, _k=F.transform("_p", lambda x: F.substring_index(x, "=", 1)), _v=F.transform("_p", lambda x: F.regexp_extract(x, "^[^=]*=(.*)$", 1)))
    d = _once(d, _raw=_folded(F.col("_k"), F.col("_v")))
    d = _once(d, attributes=F.when(F.contains("_a", F.lit("%")), _folded(F.col("_k"), F.transform("_v", _decoded))).otherwise(F.col("_raw")))
    known = lambda c, *names: F.coalesce(*[F.col(c)[n] for n in names])
    parents = escaped(F.split(known("_raw", "Parent", "PARENT", "parent"), ","), lambda c: F.transform(c, _decoded))
    return d.withColumns({"id": known("attributes", "ID", "Id", "id"), "parent": F.explode_outer(parents)}).drop("_a", "_p", "_k", "_v", "_raw")


def scan_cdna_match(lines: DataFrame) -> DataFrame:
    """Exons (tid, chrom, strand, s, e) of alignments in GFF3: each cDNA_match row is an exon of its ID, each match_part one of
    its parent; where these are missing, of its target. A match without parts is a model of one exon; of several that differ
    under one name none is. Rows of one model on several chromosomes are models of their own."""
    d = scan_gff3(lines).filter(F.col("feature").isin("cDNA_match", "EST_match", "match", "match_part", "HSP"))
    target = F.regexp_extract(F.coalesce(F.col("attributes")["Target"], F.lit("")), "^(\\S+)", 1)
    name = F.when(F.col("feature").isin("match_part", "HSP"), F.coalesce("parent", "id")).otherwise(F.coalesce("id", "parent"))
    part = F.col("feature") != "match"
    d = d.select(F.coalesce(name, F.nullif(target, F.lit(""))).alias("tid"), "chrom", "strand", "s", "e", part.alias("_part")).filter("tid IS NOT NULL").repartition("tid").distinct()
    of, w = Window.partitionBy("tid"), Window.partitionBy("tid", "chrom")
    d = d.withColumns({"_parts": F.max("_part").over(w), "_k": F.count(F.lit(1)).over(w)}).filter("_part OR NOT _parts AND _k = 1")
    several = F.min("chrom").over(of) != F.max("chrom").over(of)
    return d.select(F.when(several, F.concat_ws(".", "tid", "chrom")).otherwise(F.col("tid")).alias("tid"), "chrom", "strand", "s", "e")


def model_exons(rows: DataFrame, tid: str = "tid") -> DataFrame:
    """Exons (tid, chrom, strand, s, e) of scanned rows: those that are written, else what coding and untranslated segments
    make together."""
    d = rows.select(F.col(tid).alias("tid"), "chrom", "strand", "feature", "s", "e").filter("tid IS NOT NULL")
    exon = d.filter("lower(feature) = 'exon'").drop("feature")
    parts = d.filter(F.lower("feature").isin("cds", "utr", "five_prime_utr", "three_prime_utr", "5utr", "3utr", "stop_codon")).join(exon.select("tid").distinct(), "tid", "left_anti").drop("feature")
    w = Window.partitionBy("tid", "chrom", "strand").orderBy("s", "e")
    top = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("s") <= F.col("_top") + 1, 0).otherwise(1)).over(w)
    made = parts.withColumn("_top", top).withColumn("_run", run).groupBy("tid", "chrom", "strand", "_run").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_run")
    return exon.unionByName(made)


def scan_bed12(lines: DataFrame) -> DataFrame:
    """A row a block: name, chrom, strand, s and e from 1, thick_s and thick_e, block number."""
    f = F.split("value", "\t", -1)
    d = lines.filter(~F.col("value").rlike("^(#|track|browser)")).withColumn("_f", f).filter(F.size("_f") >= 12)
    numbers = lambda i: F.transform(F.filter(F.split(F.col("_f")[i], ","), lambda x: x != ""), lambda x: x.cast("long"))
    d = d.select(F.col("_f")[0].alias("chrom"), F.col("_f")[1].cast("long").alias("_s"), F.regexp_replace(F.regexp_extract(F.col("_f")[3], "^(?:ID=)?([^;]*)", 1), "^$", ".").alias("name"), F.when(F.col("_f")[5] != ".", F.col("_f")[5]).alias("strand"), (F.col("_f")[6].cast("long") + 1).alias("thick_s"), F.col("_f")[7].cast("long").alias("thick_e"), F.arrays_zip(numbers(10).alias("n"), numbers(11).alias("at")).alias("_b"))
    d = d.select("*", F.posexplode_outer("_b").alias("block", "b")).filter("b IS NOT NULL")
    return d.select("name", "chrom", "strand", (F.col("_s") + F.col("b.at") + 1).alias("s"), (F.col("_s") + F.col("b.at") + F.col("b.n")).alias("e"), "thick_s", "thick_e", "block")


def scan_junction_bed(lines: DataFrame) -> DataFrame:
    """Introns between the blocks of BED12 junctions, each once."""
    w = Window.partitionBy("name", "chrom", "strand", "thick_s", "thick_e").orderBy("s")
    d = scan_bed12(lines).withColumn("_next", F.lead("s").over(w)).filter("_next IS NOT NULL")
    return d.select("chrom", "strand", (F.col("e") + 1).alias("s"), (F.col("_next") - 1).alias("e")).distinct()


def scan_sam_exons(lines: DataFrame) -> DataFrame:
    """Exons of SAM lines: runs of bases of the reference that no N parts; unmapped lines go."""
    f = F.split("value", "\t", -1)
    d = lines.filter(~F.col("value").startswith("@")).withColumn("_f", f).filter((F.size("_f") >= 11) & (F.col("_f")[5] != "*"))
    ops = F.arrays_zip(F.transform(F.regexp_extract_all(F.col("_f")[5], F.lit("([0-9]+)[MIDNSHP=X]"), F.lit(1)), lambda x: x.cast("long")).alias("n"), F.regexp_extract_all(F.col("_f")[5], F.lit("[0-9]+([MIDNSHP=X])"), F.lit(1)).alias("op"))
    tag = F.regexp_extract("value", "\t(?:XS|ts):A:([+-])", 1)
    d = d.select(F.col("_f")[0].alias("tid"), F.col("_f")[2].alias("chrom"), F.when(tag != "", tag).alias("strand"), F.col("_f")[3].cast("long").alias("_p"), F.posexplode_outer(ops).alias("_i", "_o"))
    w = Window.partitionBy("tid", "chrom", "_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    moves = F.when(F.col("_o.op").isin("M", "=", "X", "D", "N"), F.col("_o.n")).otherwise(0)
    d = d.withColumns({"s": F.col("_p") + F.coalesce(F.sum(moves).over(w), F.lit(0)), "_x": F.coalesce(F.sum((F.col("_o.op") == "N").cast("int")).over(w), F.lit(0)), "_m": moves}).filter(F.col("_o.op").isin("M", "=", "X", "D"))
    return d.groupBy("tid", "chrom", "strand", "_p", "_x").agg(F.min("s").alias("s"), F.max(F.col("s") + F.col("_m") - 1).alias("e")).drop("_p", "_x")


def scan_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq, length). A record starts with > at the start of a line and is one row, so as long as a contig is; > within
    a header is text. What stands before the first record goes."""
    d = spark.read.option("lineSep", "\n>").text(path)
    # the first record of a file alone still has its sign
    first = F.col("value").startswith(">")
    d = d.withColumn("value", F.when(first, F.substring("value", 2, 1 << 30)).otherwise(F.col("value"))).filter("length(trim(value)) > 0")
    end = F.instr("value", "\n")
    rest = F.replace(F.when(end > 0, F.substring("value", end + 1, F.length("value"))).otherwise(""), F.lit("\n"), F.lit(""))
    seq = F.when(rest.rlike("\\s"), F.regexp_replace(rest, "\\s+", "")).otherwise(rest)
    return d.select(F.regexp_extract("value", "^[ \\t]*(\\S*)", 1).alias("name"), seq.alias("seq")).withColumn("length", F.length("seq"))


def scan_fai(lines: DataFrame) -> DataFrame:
    """(name, length) of an index of sequences."""
    f = F.split("value", "\t", -1)
    return lines.filter(F.size(f) >= 2).select(f[0].alias("name"), f[1].cast("long").alias("length"))


def blast_tab_rejects(lines: DataFrame) -> DataFrame:
    """(value, reason) of the lines that scan_blast_tab leaves out: too few columns, or a number that is none."""
    f = F.split("value", "\t", -1)
    numbers = [F.expr(f"try_cast(split(value, '\t', -1)[{i}] AS DOUBLE)").isNull() for i in (2, 3, 6, 7, 8, 9, 10, 11)]
    bad = numbers[0]
    for n in numbers[1:]:
        bad = bad | n
    d = lines.filter(~F.col("value").startswith("#") & (F.length(F.trim("value")) > 0))
    return d.select("value", F.when(F.size(f) < 12, "columns").when(bad, "number").alias("reason")).filter("reason IS NOT NULL")


def scan_blast_tab(lines: DataFrame) -> DataFrame:
    """Hits of twelve columns or more, as aligners write them, with ppos (positives in percent) and btop (trace) where these
    follow as thirteenth and fourteenth; blast_tab_rejects has the lines left out."""
    d = lines.filter(~F.col("value").startswith("#")).withColumn("_f", F.split("value", "\t", -1)).filter(F.size("_f") >= 12)
    n = lambda i, kind: F.get("_f", F.lit(i)).try_cast(kind)
    d = d.select(
        F.col("_f")[0].alias("query"), F.col("_f")[1].alias("target"), n(2, "double").alias("identity"), n(3, "long").alias("length"), n(6, "long").alias("qstart"), n(7, "long").alias("qend"), n(8, "long").alias("tstart"), n(9, "long").alias("tend"),
        n(10, "double").alias("evalue"), n(11, "double").alias("bitscore"), n(12, "double").alias("ppos"), F.get("_f", F.lit(13)).alias("btop"),
    )
    return d.filter("identity IS NOT NULL AND length IS NOT NULL AND qstart IS NOT NULL AND qend IS NOT NULL AND tstart IS NOT NULL AND tend IS NOT NULL AND evalue IS NOT NULL AND bitscore IS NOT NULL")


def scan_id_list(lines: DataFrame) -> DataFrame:
    """(tid, gid): a model a line, its gene after white space if given."""
    f = F.split(F.trim("value"), "\\s+")
    return lines.filter("trim(value) <> '' AND NOT startswith(trim(value), '#')").select(f[0].alias("tid"), F.get(f, F.lit(1)).alias("gid"))


def scan_external(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(tid, source, score) of a table with a header, whose first column names the model.

    A header that repeats a name is an error. NaN is 0; a blank field is no score and has no row; a text is an error.
    """
    head = spark.read.text(path).limit(1).collect()
    names = [n.strip() for n in head[0]["value"].rstrip("\r").split(sep)] if head else []
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns named twice: {', '.join(twice)}")
    schema = ", ".join(f"c{i} string" for i in range(max(len(names), 1)))
    d = spark.read.option("sep", sep).option("header", True).option("enforceSchema", True).schema(schema).csv(path)
    value = lambda i: F.nullif(F.trim(f"c{i}"), F.lit("")).cast("double")
    each = F.array(*[F.struct(F.lit(n).alias("source"), value(i + 1).alias("score")) for i, n in enumerate(names[1:])]) if len(names) > 1 else F.expr("CAST(array() AS array<struct<source: string, score: double>>)")
    d = d.select(F.col("c0").alias("tid"), F.inline(each)).filter("score IS NOT NULL")
    return d.withColumn("score", F.when(F.isnan("score"), 0.0).otherwise(F.col("score")))


#: Columns of a table of matches that hold rates, in percent with two places; the others.
TMAP_RATES = ("n_prec", "n_recall", "n_f1", "j_prec", "j_recall", "j_f1", "e_prec", "e_recall", "e_f1")
TMAP_SCHEMA = "ref_id string, ref_gene string, ccode string, tid string, gid string, tid_num_exons int, ref_num_exons int, n_prec double, n_recall double, n_f1 double, j_prec double, j_recall double, j_f1 double, e_prec double, e_recall double, e_f1 double, distance long, location string"


def write_tmap(tmap: DataFrame, path: str) -> None:
    """Matches as a table with a header; rates in percent, rounded to two places; what is missing is a dash."""
    percent = {r: F.floor(F.col(r) * 10000 + 0.5) / 100 for r in TMAP_RATES}
    tmap.withColumns(percent).write.option("sep", "\t").option("header", True).option("nullValue", "-").csv(path)


def scan_tmap(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).option("nullValue", "-").schema(TMAP_SCHEMA).csv(path)


#: Fixed value: the line above the levels of a report.
STATS_HEAD = "-" * 33 + " |   Sn |   Pr |   F1 |"


def write_stats(report: DataFrame, path: str) -> None:
    """The rows of a report (row, name, sn, pr, f1, n, total, percent) as one text file: levels with two places, counts, and
    counts of a total with their percentage. A report has thirty rows."""
    two = lambda c: F.format_string("%.2f", F.floor(F.col(c) * 100 + 0.5) / 100)
    text = F.when(F.col("sn").isNotNull(), F.concat_ws("  ", two("sn"), two("pr"), two("f1"))).when(F.col("total").isNull(), F.col("n").cast("string")).otherwise(F.concat(F.col("n").cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit("  ("), two("percent"), F.lit("%)")))
    d = report.select("row", F.concat(F.lpad("name", 34, " "), F.lit(": "), text).alias("value"))
    head = F.when(F.col("row") == 1, F.array(F.lit(STATS_HEAD), F.col("value"))).otherwise(F.array("value"))
    d.coalesce(1).sortWithinPartitions("row").select(F.explode(head).alias("value")).write.text(path)


def scan_stats(spark: SparkSession, path: str) -> DataFrame:
    """(row, value) of the lines of a report's file, in order, without the head."""
    d = spark.read.text(path, wholetext=True).filter("length(value) > 0")
    lines = F.filter(F.split("value", "\n"), lambda x: (F.length(x) > 0) & (x != STATS_HEAD))
    return d.select(F.posexplode(lines).alias("row", "value")).withColumn("row", F.col("row") + 1)


def union_assemblies(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows of several assemblies with label, which their names begin with; an empty label leaves them as they are.

    A model's name may occur in one assembly only: one that occurs in two is an error when the rows are read.
    """
    out = None
    for n, (label, rows) in enumerate(parts):
        name = lambda c: F.concat(F.lit(f"{label}_"), F.col(c)) if label else F.col(c)  # noqa: B023, E731
        named = rows.withColumns({"label": F.lit(label), "tid": name("tid"), "gid": name("gid"), "_part": F.lit(n)})
        out = named if out is None else out.unionByName(named)
    of = out.groupBy("tid").agg(F.min("_part").alias("_low"), F.max("_part").alias("_high"))
    one = F.when(F.col("_low") == F.col("_high"), True).otherwise(F.raise_error(F.concat(F.lit("model in two assemblies: "), F.col("tid"))))
    return out.join(of, "tid").filter(one).drop("_part", "_low", "_high")


def scan_regions(lines: DataFrame) -> DataFrame:
    """chrom:start-end or chrom:start..end, a line each."""
    p = "^\\s*(.+):([0-9]+)(?:-|\\.\\.)([0-9]+)\\s*$"
    return lines.filter(F.col("value").rlike(p)).select(F.regexp_extract("value", p, 1).alias("chrom"), F.regexp_extract("value", p, 2).cast("long").alias("s"), F.regexp_extract("value", p, 3).cast("long").alias("e"))


def _line(feature: str | Column, last: Column, phase: Column | None = None) -> Column:
    kind = F.lit(feature) if isinstance(feature, str) else feature
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    return F.concat_ws("\t", "chrom", dot("source"), kind, F.col("s").cast("string"), F.col("e").cast("string"), F.lit("."), dot("strand"), F.lit(".") if phase is None else phase.cast("string"), last)


def _phased(exon: DataFrame, cds: DataFrame) -> DataFrame:
    """Coding segments (tid, s, e) with the columns of their models' exons and the phase."""
    own = exon.groupBy("tid").agg(*[F.min(c).alias(c) for c in ("gid", "chrom", "strand", "source")])
    return cds_phase(cds.select("tid", "s", "e").join(own, "tid"))


def gtf_lines(transcript: DataFrame, exon: DataFrame, cds: DataFrame | None = None) -> DataFrame:
    """(tid, at, value): the transcript's line, then its exons in order, each followed by its coding segment with phase."""
    names = F.concat(F.lit('gene_id "'), F.col("gid").cast("string"), F.lit('"; transcript_id "'), F.col("tid").cast("string"), F.lit('";'))
    d = transcript.select("tid", F.lit(0).cast("long").alias("at"), _line("transcript", names).alias("value")).unionAll(exon.select("tid", F.col("s").alias("at"), _line("exon", names).alias("value")))
    return d if cds is None else d.unionAll(_phased(exon, cds).select("tid", F.col("s").alias("at"), _line("CDS", names, F.col("phase")).alias("value")))


def _escaped(c: Column) -> Column:
    """A name as GFF3 wants it: %, ;, =, & and commas are escaped."""
    for sign, code in (("%", "%25"), (";", "%3B"), ("=", "%3D"), ("&", "%26"), (",", "%2C")):
        c = F.replace(c, F.lit(sign), F.lit(code))
    return c


def gff3_lines(transcript: DataFrame, exon: DataFrame, cds: DataFrame | None = None) -> DataFrame:
    tid, gid = _escaped(F.col("tid").cast("string")), _escaped(F.col("gid").cast("string"))
    own, part = F.concat(F.lit("ID="), tid, F.lit(";Parent="), gid), F.concat(F.lit("Parent="), tid)
    d = transcript.select("tid", F.lit(0).cast("long").alias("at"), _line("mRNA", own).alias("value")).unionAll(exon.select("tid", F.col("s").alias("at"), _line("exon", part).alias("value")))
    return d if cds is None else d.unionAll(_phased(exon, cds).select("tid", F.col("s").alias("at"), _line("CDS", part, F.col("phase")).alias("value")))


def bed12_lines(transcript: DataFrame, exon: DataFrame, cds: DataFrame | None = None) -> DataFrame:
    """(tid, value): a line a transcript; its thick part is the coding span, empty for others."""
    blocks = exon.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("b"))
    listed = lambda f: F.array_join(F.transform("b", f), ",")
    d = transcript.join(blocks, "tid").withColumn("_s", F.col("s"))
    if cds is not None:
        d = d.join(cds.groupBy("tid").agg(F.min("s").alias("_cs"), F.max("e").alias("_ce")), "tid", "left")
    sizes = listed(lambda x: (x.e - x.s + 1).cast("string"))
    starts = F.array_join(F.transform(F.zip_with("b", F.array_repeat("_s", F.size("b")), lambda x, s: x.s - s), lambda x: x.cast("string")), ",")
    text = lambda c: c.cast("string")
    none = F.col("s") - 1
    thick = (none, none) if cds is None else (F.coalesce(F.col("_cs") - 1, none), F.coalesce(F.col("_ce"), none))
    name = F.concat(F.lit("ID="), text(F.col("tid")), F.lit("") if cds is None else F.when(F.col("_cs").isNotNull(), ";coding=True").otherwise(";coding=False"))
    return d.select("tid", F.concat_ws("\t", "chrom", text(none), text(F.col("e")), name, F.lit("0"), F.coalesce("strand", F.lit(".")), text(thick[0]), text(thick[1]), F.lit("0"), text(F.size("b")), sizes, starts).alias("value"))


def bed12_cds(blocks: DataFrame) -> DataFrame:
    """Coding segments (tid, chrom, strand, s, e, phase) of scanned blocks: what lies within the thick part. The first one has
    phase 0, as the format has no place for another."""
    d = blocks.filter("thick_s <= thick_e AND s <= thick_e AND e >= thick_s")
    return cds_phase(d.select(F.col("name").alias("tid"), "chrom", "strand", F.greatest("s", "thick_s").alias("s"), F.least("e", "thick_e").alias("e")))


def write_lines(lines: DataFrame, path: str) -> None:
    """Packed text files in order of transcript, then of place."""
    at = [c for c in ("tid", "at") if c in lines.columns]
    lines.repartitionByRange(*at).sortWithinPartitions(*at).select("value").write.option("compression", "gzip").text(path)


def fasta_lines(seqs: DataFrame, width: int = 60) -> DataFrame:
    """(name, value): a record with its sequence wrapped. Letters of one byte are cut as bytes."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("seq") - 1) / width).cast("int")))
    cut = F.array_join(F.transform(starts, lambda i: F.substring(F.col("seq").cast("binary"), i * width + 1, F.lit(width)).cast("string")), "\n")
    plain = (F.octet_length("seq") == F.length("seq")) & ~F.contains("seq", F.lit("\n"))
    wrapped = F.when(plain, cut).otherwise(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"))
    return seqs.select("name", F.concat(F.lit(">"), "name", F.lit("\n"), F.rtrim(wrapped)).alias("value"))


#: Columns of an assembly's summary, each with the row of its statistics file and the column there.
ASSEMBLY = (("genes", "Number of genes", 1), ("monoexonic_genes", "Number of monoexonic genes", 1), ("transcripts", "Transcripts per gene", 1), ("transcripts_per_gene", "Transcripts per gene", 2), ("transcript_len_mean", "CDNA lengths", 2),
            ("monoexonic_transcripts", "Monoexonic transcripts", 1), ("exons", "Exons per transcript", 1), ("exons_per_transcript", "Exons per transcript", 2), ("exon_len_mean", "Exon lengths", 2))
#: Columns of an alignment's summary, each with its counter.
ALIGNMENT = (("sequences", "sequences:"), ("reads_mapped", "reads mapped:"), ("reads_mapped_and_paired", "reads mapped and paired:"), ("reads_unmapped", "reads unmapped:"), ("reads_properly_paired", "reads properly paired:"), ("reads_paired", "reads paired:"), ("reads_duplicated", "reads duplicated:"), ("reads_MQ0", "reads MQ0:"))


def assembly_summary(lines: DataFrame) -> DataFrame:
    """A row a file of lines (file, value) of statistics: tabs part a row's name, total and average. Commas within numbers
    go, NA is 0; what a file lacks is 0."""
    part = F.split("value", "\t")
    number = lambda k: F.coalesce(F.expr(f"try_cast(replace(nullif(get(part, {k}), 'NA'), ',', '') AS DOUBLE)"), F.lit(0.0))
    d = lines.select("file", part.alias("part")).select("file", F.expr("get(part, 0)").alias("name"), number(1).alias("c1"), number(2).alias("c2"))
    return d.groupBy("file").agg(*[F.coalesce(F.max(F.when(F.col("name") == name, F.col(f"c{k}"))), F.lit(0.0)).alias(c) for c, name, k in ASSEMBLY])


def alignment_summary(lines: DataFrame) -> DataFrame:
    """A row a file of lines (file, value) of alignment statistics: the counters of lines that start with SN; others are 0."""
    d = lines.select("file", F.split("value", "\t").alias("part"))
    n = F.when((F.col("part")[0] == "SN") & (F.size("part") > 2), F.expr("try_cast(get(part, 2) AS BIGINT)"))
    d = d.select("file", F.expr("get(part, 1)").alias("name"), n.alias("n"))
    return d.groupBy("file").agg(*[F.coalesce(F.max(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).alias(c) for c, name in ALIGNMENT])
