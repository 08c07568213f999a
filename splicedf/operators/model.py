"""Transcript models: bounds, introns, splice sites, coding segments, and the edits of single models."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_tid():
    return Window.partitionBy("tid").orderBy("s")


def along():
    """Along the transcript: by position on the plus strand, against it on the minus strand."""
    return Window.partitionBy("tid").orderBy(F.when(F.col("strand") == "-", -F.col("s")).otherwise(F.col("s")))


def transcript_bounds(exon: DataFrame) -> DataFrame:
    """A row a transcript: bounds, number of exons and spliced length; what exons say overrides declared bounds."""
    return exon.groupBy("tid").agg(F.min("gid").alias("gid"), F.min("chrom").alias("chrom"), F.min("strand").alias("strand"), F.min("s").alias("s"), F.max("e").alias("e"), F.count(F.lit(1)).alias("n_exons"), F.sum(F.col("e") - F.col("s") + 1).alias("cdna"), F.bool_or("is_ref").alias("is_ref"), F.min("source").alias("source"))


def model_rows(exon: DataFrame) -> DataFrame:
    """transcript_bounds with the exons themselves, sorted, as xs: a row a model."""
    x = exon.groupBy("tid").agg(*[F.min(c).alias(c) for c in ("gid", "chrom", "strand")], F.bool_or("is_ref").alias("is_ref"), F.array_sort(F.collect_list(F.struct("s", "e"))).alias("xs"))
    cdna = F.aggregate("xs", F.lit(0).cast("long"), lambda n, x: n + x.e - x.s + 1)
    return x.select("tid", "gid", "chrom", "strand", F.col("xs")[0]["s"].alias("s"), F.array_max(F.col("xs.e")).alias("e"), F.size("xs").cast("long").alias("n_exons"), cdna.alias("cdna"), "is_ref", "xs")


def gaps() -> Column:
    """The introns of model_rows, as pairs."""
    rest = F.size("xs") - 1
    return F.zip_with(F.slice("xs", 1, rest), F.slice("xs", 2, rest), lambda a, b: F.struct((a.e + 1).alias("s"), (b.s - 1).alias("e")))


def gene_bounds(transcript: DataFrame, coding: Column | None = None) -> DataFrame:
    is_coding = coding if coding is not None else F.col("tid") % 4 != 0
    return transcript.groupBy("gid").agg(F.min("chrom").alias("chrom"), F.min("s").alias("s"), F.max("e").alias("e"), F.count(F.lit(1)).alias("n_tx"), F.max("n_exons").alias("max_exons"), F.count(F.when(is_coding, 1)).alias("n_coding"))


def introns(exon: DataFrame) -> DataFrame:
    d = exon.withColumn("_next", F.lead("s").over(by_tid())).filter("_next IS NOT NULL")
    return d.select("tid", "gid", "chrom", "strand", "is_ref", (F.col("e") + 1).alias("s"), (F.col("_next") - 1).alias("e"))


def splice_sites(intron: DataFrame) -> DataFrame:
    """Both ends of every intron, as donor or acceptor by strand."""
    d = intron.select("tid", "chrom", "strand", F.inline(F.array(F.struct(F.col("s").alias("pos"), F.lit("first").alias("side")), F.struct(F.col("e").alias("pos"), F.lit("last").alias("side")))))
    donor = (F.col("side") == "first") == (F.col("strand") == "+")
    return d.select("tid", "chrom", "strand", "pos", F.when(donor, "donor").otherwise("acceptor").alias("kind"))


def cds_introns(cds: DataFrame, intron: DataFrame) -> DataFrame:
    """Introns between neighbouring coding segments that are introns of the transcript as well."""
    d = cds.withColumn("_next", F.lead("s").over(by_tid())).filter("_next IS NOT NULL").select("tid", (F.col("e") + 1).alias("s"), (F.col("_next") - 1).alias("e"))
    return d.join(intron.select("tid", "s", "e"), ["tid", "s", "e"], "left_semi")


def intron_chain(intron: DataFrame) -> DataFrame:
    """(tid, chain): the introns in order, as text. A transcript's introns are a group of its own, so bounded."""
    c = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "e"))), lambda x: F.concat_ws("-", x.s, x.e)), ",")
    return intron.groupBy("tid").agg(F.min("chrom").alias("chrom"), F.min("strand").alias("strand"), c.alias("chain"), F.count(F.lit(1)).alias("n_introns"))


def utr_segments(exon: DataFrame, cds: DataFrame) -> DataFrame:
    """(tid, side, s, e, complete): what of the exons lies before and after the coding span; complete: a whole exon."""
    span = cds.groupBy("tid").agg(F.min("s").alias("cs"), F.max("e").alias("ce"))
    d = exon.join(span, "tid")
    low = F.struct(F.lit(-1).alias("at"), F.col("s").alias("us"), F.least("e", F.col("cs") - 1).alias("ue"))
    high = F.struct(F.lit(1).alias("at"), F.greatest("s", F.col("ce") + 1).alias("us"), F.col("e").alias("ue"))
    d = d.select("tid", "strand", "s", "e", F.inline(F.array(low, high))).filter("us <= ue")
    five = (F.col("at") < 0) == (F.col("strand") == "+")
    return d.select("tid", F.when(five, "five").otherwise("three").alias("side"), F.col("us").alias("s"), F.col("ue").alias("e"), ((F.col("us") == F.col("s")) & (F.col("ue") == F.col("e"))).alias("complete"))


def cds_running_length(cds: DataFrame) -> DataFrame:
    before = along().rowsBetween(Window.unboundedPreceding, -1)
    return cds.withColumn("before", F.coalesce(F.sum(F.col("e") - F.col("s") + 1).over(before), F.lit(0)))


def cds_phase(cds: DataFrame, start_phase: int = 0) -> DataFrame:
    """Phase of each coding segment: bases to skip until the next codon starts."""
    return cds_running_length(cds).withColumn("phase", F.pmod(start_phase - F.col("before"), F.lit(3)).cast("int")).drop("before")


def exon_cumulative_offset(exon: DataFrame) -> DataFrame:
    """Bases of the transcript before each exon, along the strand."""
    before = along().rowsBetween(Window.unboundedPreceding, -1)
    return exon.withColumn("offset", F.coalesce(F.sum(F.col("e") - F.col("s") + 1).over(before), F.lit(0)))


def genome_to_cdna(exon: DataFrame, points: DataFrame) -> DataFrame:
    """(tid, pos, cdna_pos): positions on the transcript, from 1; positions outside the exons are left out."""
    d = points.join(exon_cumulative_offset(exon), "tid").filter("pos BETWEEN s AND e")
    at = F.when(F.col("strand") == "-", F.col("e") - F.col("pos")).otherwise(F.col("pos") - F.col("s"))
    return d.select("tid", "pos", (F.col("offset") + at + 1).alias("cdna_pos"))


def cdna_to_genome(exon: DataFrame, intervals: DataFrame) -> DataFrame:
    """Genomic pieces of intervals (cs, ce) on the transcript."""
    d = exon_cumulative_offset(exon).join(intervals, "tid")
    n = F.col("e") - F.col("s") + 1
    d = d.filter((F.col("cs") <= F.col("offset") + n) & (F.col("ce") > F.col("offset")))
    a, b = F.greatest(F.col("cs") - F.col("offset"), F.lit(1)), F.least(F.col("ce") - F.col("offset"), n)
    minus = F.col("strand") == "-"
    return d.select("tid", F.when(minus, F.col("e") - b + 1).otherwise(F.col("s") + a - 1).alias("s"), F.when(minus, F.col("e") - a + 1).otherwise(F.col("s") + b - 1).alias("e"))


#: Bases of a range: what is swept along a chromosome is swept range by range.
RANGE = 1 << 16


def by_range(d: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """d with _cell, the range of its start, and the keys with it."""
    return d.withColumn("_cell", F.floor(F.col("s") / RANGE)), [*keys, "_cell"]


def carried(d: DataFrame, keys: list[str], after: bool = False, **values: tuple[Column, Callable[[Column], Column]]) -> DataFrame:
    """d (of by_range) with a column for each value, which (aggregate, function over windows) sums up all ranges before, or
    all after.

    A range is one row of the table that the window runs over, however many rows of d it has.
    """
    over = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(*((1, Window.unboundedFollowing) if after else (Window.unboundedPreceding, -1)))
    table = d.groupBy(*keys, "_cell").agg(*[a.alias(f"_{k}") for k, (a, _) in values.items()])
    table = table.select(*[F.col(k).alias(f"_key_{k}") for k in (*keys, "_cell")], *[f(F.col(f"_{k}")).over(over).alias(k) for k, (_, f) in values.items()])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in (*keys, "_cell")]
    return d.join(table, reduce(lambda x, y: x & y, same)).drop(*[f"_key_{k}" for k in (*keys, "_cell")])


def islands(d: DataFrame, keys: list[str], joins: Column) -> DataFrame:
    """d with island: rows of a key in order of s; a row starts an island unless `joins` holds. joins may use _top, the
    largest e before it. Along chromosomes the sweep runs range by range, with the top and the count before each carried over."""
    order = lambda w: w.orderBy("s", "e")
    if "tid" in keys or "chrom" not in keys:
        w = order(Window.partitionBy(*keys))
        d = d.withColumn("_top", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        return d.withColumn("island", F.sum(F.when(F.col("_top").isNotNull() & joins, 0).otherwise(1)).over(w)).drop("_top")
    d, cells = by_range(d, keys)
    w = order(Window.partitionBy(*cells))
    d = carried(d, keys, _before=(F.max("e"), F.max)).withColumn("_top", F.greatest(F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)), "_before"))
    d = d.withColumn("_new", F.when(F.col("_top").isNotNull() & joins, 0).otherwise(1)).drop("_top", "_before")
    d = carried(d, keys, _base=(F.sum("_new"), F.sum))
    return d.withColumn("island", F.coalesce("_base", F.lit(0)) + F.sum("_new").over(w)).drop("_new", "_base", "_cell")


def numbered(d: DataFrame, keys: list[str], *order: str, name: str = "n") -> DataFrame:
    """d with its rows' numbers from 1 on in order of s and then `order`, by key, counted range by range."""
    d, cells = by_range(d, keys)
    d = carried(d, keys, _base=(F.count(F.lit(1)), F.sum))
    return d.withColumn(name, F.coalesce("_base", F.lit(0)) + F.row_number().over(Window.partitionBy(*cells).orderBy("s", *order))).drop("_base", "_cell")


def exons_from_cds_utr(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(exons, tids rejected): neighbouring coding and untranslated segments put together; overlapping ones reject."""
    w = Window.partitionBy("tid").orderBy("s", "e")
    bad = segments.withColumn("_top", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))).filter("s <= _top").select("tid").distinct()
    good = islands(segments.join(bad, "tid", "left_anti"), ["tid"], F.col("s") <= F.col("_top") + 1)
    return good.groupBy("tid", "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island"), bad


def split_long_introns(exon: DataFrame, max_intron: int, min_length: int) -> DataFrame:
    """Exons with part: transcripts cut at introns above max_intron; parts shorter than min_length go, references stay."""
    d = islands(exon, ["tid"], F.col("is_ref") | (F.col("s") - F.col("_top") - 1 <= max_intron)).withColumnRenamed("island", "part")
    d = d.withColumn("_n", F.sum(F.col("e") - F.col("s") + 1).over(Window.partitionBy("tid", "part")))
    return d.filter(F.col("is_ref") | (F.col("_n") >= min_length)).drop("_n")


def merge_tiny_introns(exon: DataFrame, min_intron: int) -> DataFrame:
    """Exons that introns below min_intron part are one."""
    d = islands(exon, ["tid"], F.col("s") - F.col("_top") - 1 < min_intron)
    return d.groupBy("tid", "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def trim_terminal_exons(exon: DataFrame, cds: DataFrame, max_length: int) -> DataFrame:
    """Terminal exons of multiexonic models cut to max_length from the inner end, but never into the coding span."""
    span = cds.groupBy("tid").agg(F.min("s").alias("cs"), F.max("e").alias("ce"))
    w = Window.partitionBy("tid").orderBy("s")
    d = exon.withColumns({"_i": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy("tid"))}).join(span, "tid", "left")
    first, last = (F.col("_i") == 1) & (F.col("_n") > 1), (F.col("_i") == F.col("_n")) & (F.col("_n") > 1)
    s = F.when(first, F.greatest("s", F.least(F.col("e") - max_length + 1, F.coalesce(F.col("cs"), F.col("e"))))).otherwise(F.col("s"))
    e = F.when(last, F.least("e", F.greatest(F.col("s") + max_length - 1, F.coalesce(F.col("ce"), F.col("s"))))).otherwise(F.col("e"))
    return d.select("tid", s.alias("s"), e.alias("e"))


def remove_utrs(exon: DataFrame, cds: DataFrame) -> DataFrame:
    """Exons of coding transcripts, cut to the coding span."""
    span = cds.groupBy("tid").agg(F.min("s").alias("cs"), F.max("e").alias("ce"))
    return exon.join(span, "tid").filter("s <= ce AND e >= cs").select("tid", F.greatest("s", "cs").alias("s"), F.least("e", "ce").alias("e"))


def trim_long_utr_introns(exon: DataFrame, cds: DataFrame, max_intron: int) -> DataFrame:
    """Exons of coding transcripts without those that an untranslated intron above max_intron parts from the coding span."""
    span = cds.groupBy("tid").agg(F.min("s").alias("cs"), F.max("e").alias("ce"))
    gaps = introns(exon).join(span, "tid").filter(F.col("e") - F.col("s") + 1 > max_intron)
    cut = gaps.groupBy("tid").agg(F.max(F.when(F.col("e") < F.col("cs"), F.col("e"))).alias("low"), F.min(F.when(F.col("s") > F.col("ce"), F.col("s"))).alias("high"))
    return exon.join(span.select("tid"), "tid", "left_semi").join(cut, "tid", "left").filter("(low IS NULL OR s > low) AND (high IS NULL OR e < high)").select("tid", "s", "e")


def model_validity(exon: DataFrame, cds: DataFrame) -> DataFrame:
    """(tid, overlapping, mixed_strand, cds_outside, cds_broken): reasons to reject a model or strip its coding part."""
    w = Window.partitionBy("tid").orderBy("s", "e")
    x = exon.withColumn("_top", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    x = x.groupBy("tid").agg(F.coalesce(F.bool_or(F.col("s") <= F.col("_top")), F.lit(False)).alias("overlapping"), (F.min("strand") != F.max("strand")).alias("mixed_strand"), F.min("s").alias("ts"), F.max("e").alias("te"))
    c = cds.groupBy("tid").agg(F.min("s").alias("cs"), F.max("e").alias("ce"), F.sum(F.col("e") - F.col("s") + 1).alias("n"))
    d = x.join(c, "tid", "left")
    return d.select("tid", "overlapping", "mixed_strand", F.coalesce((F.col("cs") < F.col("ts")) | (F.col("ce") > F.col("te")), F.lit(False)).alias("cds_outside"), F.coalesce(F.col("n") % 3 != 0, F.lit(False)).alias("cds_broken"))


def codon_frames(cds: DataFrame) -> DataFrame:
    """(tid, s, e, frame): the frame of each segment's first base along the strand."""
    return cds_running_length(cds).select("tid", "s", "e", (F.col("before") % 3).cast("int").alias("frame"))


def reverse_strand(exon: DataFrame, which: Column) -> DataFrame:
    return exon.withColumn("strand", F.when(which, F.translate("strand", "+-", "-+")).otherwise(F.col("strand")))


def contained_in(t: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows that lie wholly in a region; the list of regions is what a user types, so Spark may broadcast it."""
    r = regions.select(F.col("chrom").alias("_c"), F.col("s").alias("_s"), F.col("e").alias("_e"))
    return t.join(r, (F.col("chrom") == F.col("_c")) & (F.col("s") >= F.col("_s")) & (F.col("e") <= F.col("_e")), "left_semi")


def cdna_metrics(exon: DataFrame) -> DataFrame:
    n = F.col("e") - F.col("s") + 1
    return exon.groupBy("tid").agg(F.sum(n).alias("cdna_length"), F.count(F.lit(1)).alias("exon_num"), F.max(n).alias("max_exon_length"), F.min(n).alias("min_exon_length"))


def intron_metrics(exon: DataFrame, intron: DataFrame, low: int = 60, high: int = 10_000) -> DataFrame:
    """Monoexonic transcripts have 0 in every column."""
    n = F.col("e") - F.col("s") + 1
    m = intron.groupBy("tid").agg(F.max(n).alias("max_intron_length"), F.min(n).alias("min_intron_length"), F.count(F.when(n > high, 1)).alias("num_introns_greater_than_max"), F.count(F.when(n < low, 1)).alias("num_introns_smaller_than_min"))
    return exon.select("tid").distinct().join(m, "tid", "left").na.fill(0)


def cds_metrics(exon: DataFrame, cds: DataFrame) -> DataFrame:
    n = F.col("e") - F.col("s") + 1
    c = cds.groupBy("tid").agg(F.sum(n).alias("combined_cds_length"), F.count(F.lit(1)).alias("combined_cds_num"))
    d = cdna_metrics(exon).join(c, "tid", "left").na.fill(0)
    return d.select("tid", "combined_cds_length", "combined_cds_num", (F.col("combined_cds_length") / F.col("cdna_length")).alias("combined_cds_fraction"), (F.col("combined_cds_num") / F.col("exon_num")).alias("combined_cds_num_fraction"))


def utr_metrics(exon: DataFrame, cds: DataFrame) -> DataFrame:
    """Coding transcripts only."""
    n, five, three = F.col("e") - F.col("s") + 1, F.col("side") == "five", F.col("side") == "three"
    u = utr_segments(exon, cds).groupBy("tid").agg(*[f(F.when(c, v)).alias(k) for k, f, c, v in (("five_utr_length", F.sum, five, n), ("three_utr_length", F.sum, three, n), ("five_utr_num", F.count, five, n), ("three_utr_num", F.count, three, n), ("five_utr_num_complete", F.count, five & F.col("complete"), n), ("three_utr_num_complete", F.count, three & F.col("complete"), n))])
    return cds.select("tid").distinct().join(u, "tid", "left").na.fill(0)


def cds_distances(exon: DataFrame, cds: DataFrame) -> DataFrame:
    """A row a model: exonic bases from its start to the coding part, from that one's end to the model's end, and to the last
    junction; 0 without a coding part."""
    span = cds.groupBy("tid").agg(F.min("s").alias("cs"), F.max("e").alias("ce"))
    w = Window.partitionBy("tid").orderBy(F.when(F.col("strand") == "-", F.col("s")).otherwise(-F.col("s")))
    d = exon.withColumn("_last", F.row_number().over(w) == 1).join(span, "tid", "left")
    low = F.greatest(F.lit(0), F.least("e", F.col("cs") - 1) - F.col("s") + 1)
    high = F.greatest(F.lit(0), F.col("e") - F.greatest("s", F.col("ce") + 1) + 1)
    known, minus = F.col("cs").isNotNull(), F.col("strand") == "-"
    before, after = (F.when(known, F.when(minus, a).otherwise(b)).otherwise(0) for a, b in ((high, low), (low, high)))
    return d.groupBy("tid").agg(F.sum(before).alias("start_distance_from_tss"), F.sum(after).alias("end_distance_from_tes"), F.sum(F.when(F.col("_last"), 0).otherwise(after)).alias("end_distance_from_junction"))
