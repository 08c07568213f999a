"""Loci: clusters that share structure, their best models, isoforms, and what is left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators import graph
from splicedf.operators.intervals import gap_cluster, join_contained, join_overlap


def subloci(transcript: DataFrame, intron: DataFrame) -> DataFrame:
    """(tid, sublocus): transcripts of several exons that share introns, directly or through others, and monoexonic ones
    that overlap. Introns are nodes of the graph themselves, so a common intron costs a row a transcript, not a pair."""
    multi = transcript.filter("n_exons > 1")
    first = intron.groupBy("chrom", "strand", "s", "e").agg(F.min("tid").alias("b"))
    edges = intron.select(F.col("tid").alias("a"), "chrom", "strand", "s", "e").join(first, ["chrom", "strand", "s", "e"]).filter("a <> b").select("a", "b").distinct()
    comp = graph.connected_components(multi.select(F.col("tid").alias("node")), edges).select(F.col("node").alias("tid"), F.col("comp").alias("sublocus"))
    mono = gap_cluster(transcript.filter("n_exons = 1"), ["chrom", "strand"], 1)
    mono = mono.withColumn("sublocus", F.min("tid").over(Window.partitionBy("chrom", "strand", "cluster"))).select("tid", "sublocus")
    return comp.unionAll(mono)


def redundancy_filter(transcript: DataFrame, chain: DataFrame, priority: Column) -> DataFrame:
    """Tids that stay: of models with one intron chain of which one lies within the other, the pass in order of priority."""
    d = transcript.join(chain.select("tid", "chain"), "tid").select("chrom", "strand", "chain", "tid", "s", "e", priority.alias("priority"))
    pair = join_contained(d.drop("priority"), d.drop("priority"), keys=("chrom", "strand", "chain")).filter("tid_a <> tid_b")
    edges = pair.select(F.col("tid_a").alias("a"), F.col("tid_b").alias("b"))
    return graph.greedy_mis(d.select(F.col("tid").alias("node"), "priority"), edges).withColumnRenamed("node", "tid")


def as_candidates(transcript: DataFrame, primary: DataFrame) -> DataFrame:
    """(tid, n_loci, locus): other transcripts with the primaries that they overlap on their strand: none is lost, one a
    candidate for alternative splicing, more a chimera."""
    cols = ["chrom", "strand", "tid", "s", "e"]
    rest = transcript.join(primary.select("tid"), "tid", "left_anti")
    hit = join_overlap(rest.select(*cols), primary.select(*cols), ("chrom", "strand")).groupBy(F.col("tid_a").alias("tid")).agg(F.count(F.lit(1)).alias("n_loci"), F.min("tid_b").alias("locus"))
    return rest.select("tid").join(hit, "tid", "left").select("tid", F.coalesce("n_loci", F.lit(0)).alias("n_loci"), F.when(F.col("n_loci") == 1, F.col("locus")).alias("locus"))


def as_confirmed(candidates: DataFrame, checked: DataFrame) -> DataFrame:
    """Candidates (tid, locus) without an intron that neither their primary has nor evidence verifies."""
    own = candidates.join(checked.select("tid", "s", "e", "verified"), "tid")
    of_primary = checked.select(F.col("tid").alias("locus"), "s", "e")
    bad = own.filter("NOT verified").join(of_primary, ["locus", "s", "e"], "left_anti").select("tid").distinct()
    return candidates.join(bad, "tid", "left_anti")


def intersect_simple(exon: DataFrame, intron: DataFrame) -> DataFrame:
    """Pairs (a, b) of one strand with a common splice site or an intron of a within an exon of b."""
    site = intron.select("chrom", "strand", "tid", F.explode(F.array("s", "e")).alias("pos")).distinct()
    x, y = (site.withColumnRenamed("tid", f"tid_{k}") for k in "ab")
    share = x.join(y, ["chrom", "strand", "pos"]).filter("tid_a <> tid_b").select("tid_a", "tid_b")
    cols = ["chrom", "strand", "tid", "s", "e"]
    within = join_contained(intron.select(*cols), exon.select(*cols), keys=("chrom", "strand")).filter("tid_a <> tid_b").select("tid_a", "tid_b")
    return share.unionAll(within).distinct()


def promoter_regions(gene: DataFrame, distance: int) -> DataFrame:
    """(gid, s, e): the window before each gene on its strand, clipped where another gene lies; without room, no row."""
    cols = ["chrom", "gid", "s", "e"]
    w = gene.select("chrom", "gid", "strand", F.when(F.col("strand") == "-", F.col("e") + 1).otherwise(F.greatest(F.col("s") - distance, F.lit(1))).alias("s"), F.when(F.col("strand") == "-", F.col("e") + distance).otherwise(F.col("s") - 1).alias("e"))
    hit = join_overlap(w.select(*cols), gene.select(*cols)).filter("gid_a <> gid_b").groupBy(F.col("gid_a").alias("gid")).agg(F.max("e_b").alias("top"), F.min("s_b").alias("bottom"))
    d = w.join(hit, "gid", "left")
    s = F.when((F.col("strand") != "-") & F.col("top").isNotNull(), F.greatest("s", F.col("top") + 1)).otherwise(F.col("s"))
    e = F.when((F.col("strand") == "-") & F.col("bottom").isNotNull(), F.least("e", F.col("bottom") - 1)).otherwise(F.col("e"))
    return d.select("gid", s.alias("s"), e.alias("e")).filter("s <= e")


def rescaler_suggestion(metrics: DataFrame, winners: DataFrame, group: str, names: list[str]) -> DataFrame:
    """Per metric: in how many groups of several models the winner has the largest, the smallest or another value."""
    w = Window.partitionBy(group)
    bounds = {f"_{k}_{n}": f(n).over(w) for n in names for k, f in (("high", F.max), ("low", F.min))}
    d = metrics.withColumns({"_n": F.count(F.lit(1)).over(w)} | bounds).filter("_n > 1")
    each = [F.struct(F.lit(n).alias("metric"), *[F.col(c).cast("double").alias(k) for k, c in (("v", n), ("high", f"_high_{n}"), ("low", f"_low_{n}"))]) for n in names]
    d = d.select("tid", F.explode(F.array(*each)).alias("m"))
    d = d.join(winners.select("tid"), "tid", "left_semi").select("m.*")
    top, low = F.col("v") == F.col("high"), F.col("v") == F.col("low")
    return d.groupBy("metric").agg(F.count(F.when(top, 1)).alias("n_max"), F.count(F.when(low & ~top, 1)).alias("n_min"), F.count(F.when(~top & ~low, 1)).alias("n_between"))
