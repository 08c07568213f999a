"""Steps of the choice of models: containment, fragments, the best prediction of each reference, stop codons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import graph
from splicedf.operators.intervals import interval_union_length, join_contained, join_overlap, merged
from splicedf.operators.model import exon_cumulative_offset

#: Class codes that make a putative fragment one.
FRAGMENT_CODES = ("p", "P", "x", "X", "i", "m", "_", "e", "o")
#: Codes of predictions on the other strand or beside the reference, which come last.
LAST_CODES = ("x", "X", "P", "p")
#: Codes of an isoform that repeats another.
REDUNDANT_CODES = ("c", "m", "_", "=", "n")


def reduce_contained(transcript: DataFrame, exon: DataFrame) -> DataFrame:
    """Tids that stay: a model goes if all its introns are introns of another model of its strand and all its bases lie
    in that one's exons. References stay. Of equal models a reference stays, or the smallest tid.

    Exons join once: each exon of a lies in an exon of b and has its inner borders; the exons of b that are hit follow
    each other, or an exon of b would lie in an intron of a.
    """
    w = Window.partitionBy("tid")
    x = exon.select("chrom", "strand", "tid", "s", "e", F.row_number().over(w.orderBy("s")).alias("i"), F.count(F.lit(1)).over(w).alias("n"))
    d = join_contained(x, x, keys=("chrom", "strand")).filter("tid_a <> tid_b AND n_a <= n_b AND (i_a = 1 OR s_a = s_b) AND (i_a = n_a OR e_a = e_b)")
    d = d.groupBy("tid_a", "tid_b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("k"), F.min("i_b").alias("low"), F.max("i_b").alias("high")).filter("k = n_a AND high - low = n_a - 1")
    t = [transcript.select(*[F.col(c).alias(f"{c}_{side}") for c in ("tid", "s", "e", "is_ref")]) for side in "ab"]
    d = d.join(t[0].filter("NOT is_ref_a"), "tid_a").join(t[1], "tid_b")
    equal = (F.col("s_a") == F.col("s_b")) & (F.col("e_a") == F.col("e_b")) & (F.col("n_a") == F.col("n_b"))
    gone = d.filter(~equal | F.col("is_ref_b") | (F.col("tid_b") < F.col("tid_a"))).select(F.col("tid_a").alias("tid"))
    return transcript.select("tid").join(gone, "tid", "left_anti")


def fragments(pairs: DataFrame, codes: tuple = FRAGMENT_CODES) -> DataFrame:
    """(tid, fragment_of, code, distance): of pairs (putative a, valid b), each a that one of the codes ties to a b, with the
    nearest such b; ties go to the larger overlap, then to the smaller tid. A locus without valid ones has no pairs, so none goes."""
    order = F.struct("distance", (-F.col("n_f1")).alias("f"), F.col("tid_b").alias("fragment_of"), F.col("ccode").alias("code"))
    d = pairs.filter(F.col("ccode").isin(*codes)).groupBy(F.col("tid_a").alias("tid")).agg(F.min(order).alias("m"))
    return d.select("tid", "m.fragment_of", "m.code", "m.distance")


def best_refmap(pairs: DataFrame, key: str) -> DataFrame:
    """(key, tid_a, tid_b, ccode): the best pair of each key: codes of the other strand last, then the F1 of junctions,
    exons and bases. Where no pair of the key has anything in common, the nearest. Ties go to the smaller tids."""
    ids = [F.col(c) for c in ("tid_a", "tid_b", "ccode")]
    rates = [(-F.col(c)).alias(c) for c in ("j_f1", "e_f1", "n_f1")]
    last = F.col("ccode").isin(*LAST_CODES).alias("last")
    d = pairs.groupBy(key).agg(F.min(F.struct(last, *rates, *ids)).alias("best"), F.min(F.struct("distance", last, *ids)).alias("near"), F.max(F.greatest("j_f1", "e_f1", "n_f1")).alias("top"))
    pick = lambda c: F.when(F.col("top") > 0, F.col(f"best.{c}")).otherwise(F.col(f"near.{c}")).alias(c)
    return d.select(F.col(key).alias("key"), pick("tid_a"), pick("tid_b"), pick("ccode"))


def stop_codon_fix(cds: DataFrame, stop_codon: DataFrame) -> DataFrame:
    """(tid, s, e): coding segments with the stop codons that lie outside them; touching ones are one."""
    return merged(cds.select("tid", "s", "e").unionByName(stop_codon.select("tid", "s", "e")), ["tid"])


def splicing_metrics(transcript: DataFrame, checked: DataFrame) -> DataFrame:
    """Share of introns that are canonical on the model's strand; suspicious: canonical ones on both strands or on the
    other alone; whether none is. checked has tid, plus and minus. Monoexonic models have 0 and false."""
    d = transcript.select("tid", "strand", "n_exons").join(checked.select("tid", "plus", "minus"), "tid", "left").na.fill(0, ["plus", "minus"])
    minus = F.col("strand") == "-"
    d = d.select("tid", "n_exons", F.when(minus, F.col("minus")).otherwise(F.col("plus")).alias("own"), F.when(minus, F.col("plus")).otherwise(F.col("minus")).alias("other"))
    multi: Column = F.col("n_exons") > 1
    return d.select("tid", F.when(multi, F.col("own") / (F.col("n_exons") - 1)).otherwise(0.0).alias("canonical_intron_proportion"), (multi & (F.col("other") > 0)).alias("suspicious_splicing"), (multi & (F.col("own") == 0)).alias("only_non_canonical_splicing"))


def selected_metrics(exon: DataFrame, orf: DataFrame) -> DataFrame:
    """Metrics of the longest reading frame (ties: the first) of each model; orf has tid, s, e on the transcript, has_start
    and has_stop. highest_cds_exon_number is the largest over all frames. Models without a frame have 0 and false."""
    n = F.col("e") - F.col("s") + 1
    x = exon_cumulative_offset(exon).select("tid", "offset", n.alias("len"))
    o = orf.select("tid", F.col("s").alias("os"), F.col("e").alias("oe"), "has_start", "has_stop")
    part = o.join(x, "tid").filter("os <= offset + len AND oe > offset").groupBy("tid", "os", "oe", "has_start", "has_stop").agg(F.count(F.lit(1)).alias("num"))
    best = part.groupBy("tid").agg(F.min(F.struct((F.col("os") - F.col("oe") - 1).alias("n"), "os", "num", "has_start", "has_stop")).alias("b"), F.max("num").alias("most"))
    d = exon.groupBy("tid").agg(F.sum(n).alias("cdna"), F.count(F.lit(1)).alias("exons")).join(best, "tid", "left")
    length, num, most = F.coalesce(-F.col("b.n"), F.lit(0)), F.coalesce("b.num", F.lit(0)), F.coalesce("most", F.lit(0))
    start, stop = (F.coalesce(f"b.{c}", F.lit(False)) for c in ("has_start", "has_stop"))
    return d.select("tid", length.alias("selected_cds_length"), num.alias("selected_cds_num"), (length / F.col("cdna")).alias("selected_cds_fraction"), (num / F.col("exons")).alias("selected_cds_number_fraction"),
                    most.alias("highest_cds_exon_number"), (most / F.col("exons")).alias("selected_cds_exons_fraction"), start.alias("has_start_codon"), stop.alias("has_stop_codon"), (start & stop).alias("is_complete"))


def as_redundant(candidates: DataFrame, pairs: DataFrame, codes: tuple = REDUNDANT_CODES) -> DataFrame:
    """Tids that stay of candidates (tid, locus, score): the pass in order of (score desc, tid) drops a model that one of the
    codes ties, as the prediction, to a model of its locus that stays. pairs: (tid_a, tid_b, ccode)."""
    a, b = (candidates.select(F.col("tid").alias(f"tid_{k}"), F.col("locus").alias(f"locus_{k}"), F.col("score").alias(f"score_{k}")) for k in "ab")
    d = pairs.filter(F.col("ccode").isin(*codes)).select("tid_a", "tid_b").join(a, "tid_a").join(b, "tid_b")
    d = d.filter("locus_a = locus_b AND (score_b > score_a OR (score_b = score_a AND tid_b < tid_a))")
    return graph.greedy_mis(candidates.select(F.col("tid").alias("node"), F.col("score").alias("priority")), d.select(F.col("tid_a").alias("a"), F.col("tid_b").alias("b"))).withColumnRenamed("node", "tid")


def requirements_filter(models: DataFrame, section: Column, measure: Callable[[DataFrame], DataFrame], check_references: bool = False) -> DataFrame:
    """Models that stay: measure gives each of them its metrics among those that are left; those that fail the section go, and
    the rest is measured again until none fails. A metric that is null fails. References stay unless check_references."""
    left = graph._cut(models)
    for _ in range(graph.ROUNDS):
        fails = ~F.coalesce(section, F.lit(False)) & (F.lit(check_references) | ~F.col("is_ref"))
        gone = graph._cut(measure(left).filter(fails).select("tid"))
        if gone.isEmpty():
            return left
        left = graph._cut(left.join(gone, "tid", "left_anti"))
    raise RuntimeError("requirements_filter: not settled")


def locus_fractions(exon: DataFrame, intron: DataFrame, cds_intron: DataFrame, locus: str) -> DataFrame:
    """A row a model: its share of its locus' exons, introns and introns between coding segments; 0 where the locus has none.
    All three carry tid, s, e and the column `locus`."""
    d = exon.select("tid", locus).distinct()
    for name, x in (("exon_fraction", exon), ("intron_fraction", intron), ("combined_cds_intron_fraction", cds_intron)):
        own = x.select(locus, "tid", "s", "e").distinct().groupBy(locus, "tid").agg(F.count(F.lit(1)).alias("n"))
        of = x.select(locus, "s", "e").distinct().groupBy(locus).agg(F.count(F.lit(1)).alias("k"))
        d = d.join(own.join(of, locus).select("tid", (F.col("n") / F.col("k")).alias(name)), "tid", "left")
    return d.drop(locus).na.fill(0.0)


def prefer_reference(models: DataFrame, locus: str, score: str, only_reference: bool = False) -> DataFrame:
    """(locus, tid): the best model of each locus, references before others, then by score, then the smallest tid. With
    only_reference loci without a reference have none."""
    d = models.groupBy(locus).agg(F.min(F.struct((~F.col("is_ref")).alias("new"), (-F.col(score)).alias("p"), "tid")).alias("b"))
    return (d.filter("NOT b.new") if only_reference else d).select(locus, "b.tid")


def as_min_score(candidates: DataFrame, scored: DataFrame, share: float = 0.5) -> DataFrame:
    """Candidates (tid, locus) whose score is at least this share of that of the primary, whose tid is the locus."""
    own, top = scored.select("tid", F.col("score").alias("_own")), scored.select(F.col("tid").alias("locus"), F.col("score").alias("_top"))
    return candidates.join(own, "tid").join(top, "locus").filter(F.col("_own") >= share * F.col("_top")).select("tid", "locus")


def monoholders(winners: DataFrame, flank: int) -> DataFrame:
    """(tid, holder): winners of one strand that overlap, or lie within the flank, directly or through others; a holder is
    named by its smallest tid."""
    x = winners.select("chrom", "strand", "tid", "s", "e")
    e = join_overlap(x, x, ("chrom", "strand"), slack=flank).filter("tid_a < tid_b").select(F.col("tid_a").alias("a"), F.col("tid_b").alias("b"))
    return graph.connected_components(x.select(F.col("tid").alias("node")), e).select(F.col("node").alias("tid"), F.col("comp").alias("holder"))


def best_of_groups(models: DataFrame, group: str, score: Column) -> DataFrame:
    """Models that the pass in order of (score desc, tid) keeps: one goes if it overlaps a kept one of its group. The score may
    look at the group, by windows."""
    d = models.withColumn("_score", score)
    x = d.select(group, "tid", "s", "e")
    e = join_overlap(x, x, (group,)).filter("tid_a < tid_b").select(F.col("tid_a").alias("a"), F.col("tid_b").alias("b"))
    kept = graph.greedy_mis(d.select(F.col("tid").alias("node"), F.col("_score").alias("priority")), e)
    return models.join(kept.select(F.col("node").alias("tid")), "tid", "left_semi")


def loci(models: DataFrame, subloci: DataFrame, score: Callable[[str], Column], flank: int) -> DataFrame:
    """(tid, holder): the primary models. Each sublocus keeps its best models that do not overlap; those are put into holders,
    scored anew among them, and chosen again. score makes the score from the name of the group's column."""
    first = graph._cut(best_of_groups(models.join(subloci, "tid"), "sublocus", score("sublocus")))
    held = graph._cut(first.join(monoholders(first, flank), "tid"))
    return best_of_groups(held, "holder", score("holder")).select("tid", "holder")


def frame_metrics(orf: DataFrame) -> DataFrame:
    """(tid, number_internal_orfs, cds_not_maximal, cds_not_maximal_fraction): frames (tid, s, e) on the transcript, and how
    much of the bases in any frame the longest one leaves out; 0 with a single frame."""
    n = orf.groupBy("tid").agg(F.count(F.lit(1)).alias("number_internal_orfs"), F.max(F.col("e") - F.col("s") + 1).alias("top"))
    d = n.join(interval_union_length(orf.select("tid", "s", "e"), ["tid"]), "tid")
    left = F.when(F.col("number_internal_orfs") > 1, F.col("bases") - F.col("top")).otherwise(0)
    return d.select("tid", "number_internal_orfs", left.alias("cds_not_maximal"), (left / F.col("bases")).alias("cds_not_maximal_fraction"))


def frame_distances(exon: DataFrame, orf: DataFrame) -> DataFrame:
    """A row a model: bases from its start to the longest frame's (ties: the first), from that one's end to the model's end, and
    to the last junction; 0 without a frame."""
    last = F.max_by(F.col("e") - F.col("s") + 1, F.when(F.col("strand") == "-", -F.col("s")).otherwise(F.col("s")))
    x = exon.groupBy("tid").agg(F.sum(F.col("e") - F.col("s") + 1).alias("cdna"), last.alias("last"))
    best = orf.groupBy("tid").agg(F.min(F.struct((F.col("s") - F.col("e")).alias("n"), "s", "e")).alias("b"))
    d = x.join(best, "tid", "left")
    zero = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    after = F.when(F.col("b.e").isNotNull(), F.greatest(F.lit(0), F.col("cdna") - F.col("last") - F.col("b.e")))
    return d.select("tid", zero(F.col("b.s") - 1, "selected_start_distance_from_tss"), zero(F.col("cdna") - F.col("b.e"), "selected_end_distance_from_tes"), zero(after, "selected_end_distance_from_junction"))
