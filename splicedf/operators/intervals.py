"""Interval joins and sweeps on closed coordinates. Range predicates become equi-joins on bins of fixed width."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators.model import RANGE, by_range, carried, islands


def _sided(d: DataFrame, keys: list[str], tag: str) -> DataFrame:
    return d.select(*keys, *[F.col(c).alias(f"{c}_{tag}") for c in d.columns if c not in keys])


def join_overlap(a: DataFrame, b: DataFrame, keys: tuple = ("chrom",), width: int = 4096, slack: int = 0) -> DataFrame:
    """Pairs that share a base, or lie within slack of each other; columns get _a and _b, and overlap their shared bases.

    Each interval is put in every bin that it touches; a pair is kept in the bin of its larger start alone, so none is
    found twice and no distinct is needed. The join is on (keys, bin), which Spark can shuffle and split when skewed.
    """
    keys = list(keys)
    bins = lambda s, e: F.explode(F.sequence(F.floor(s / width), F.floor(e / width)))
    x = _sided(a, keys, "a").withColumn("_bin", bins(F.col("s_a") - slack, F.col("e_a") + slack))
    y = _sided(b, keys, "b").withColumn("_bin", bins(F.col("s_b"), F.col("e_b")))
    low = F.greatest(F.col("s_a") - slack, F.col("s_b"))
    d = x.join(y, [*keys, "_bin"]).filter((low <= F.least(F.col("e_a") + slack, F.col("e_b"))) & (F.col("_bin") == F.floor(low / width)))
    return d.withColumn("overlap", F.least("e_a", "e_b") - F.greatest("s_a", "s_b") + 1).drop("_bin")


def join_within_distance(a: DataFrame, b: DataFrame, distance: int = 2000, keys: tuple = ("chrom",)) -> DataFrame:
    """Pairs at most `distance` apart, with distance: 0 if they overlap."""
    return join_overlap(a, b, keys, slack=distance).withColumn("distance", F.greatest(F.lit(0), F.greatest("s_a", "s_b") - F.least("e_a", "e_b"))).filter(F.col("distance") <= distance)


def join_contained(a: DataFrame, b: DataFrame, either: bool = False, keys: tuple = ("chrom",)) -> DataFrame:
    """Pairs in which a lies within b (or, with either, one within the other)."""
    inside = (F.col("s_a") >= F.col("s_b")) & (F.col("e_a") <= F.col("e_b"))
    around = (F.col("s_a") <= F.col("s_b")) & (F.col("e_a") >= F.col("e_b"))
    return join_overlap(a, b, keys).filter(inside | around if either else inside)


def join_nearest(a: DataFrame, b: DataFrame, up: bool, n: int = 1, max_dist: int = 2500, keys: tuple = ("chrom",)) -> DataFrame:
    """The n nearest intervals of b wholly before (up) or after each of a, within max_dist; ties by start and id order."""
    gap = F.col("s_a") - F.col("e_b") if up else F.col("s_b") - F.col("e_a")
    d = join_overlap(a, b, keys, slack=max_dist).withColumn("distance", gap).filter((F.col("distance") > 0) & (F.col("distance") <= max_dist))
    w = Window.partitionBy(*[c for c in d.columns if c.endswith("_a")], *keys).orderBy("distance", "s_b", "e_b", *[c for c in d.columns if c.endswith("_b") and c not in ("s_b", "e_b")])
    return d.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= n)


def gap_cluster(d: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """d with cluster (numbered along each key): neighbours join while the next start is less than gap past the end so far."""
    return islands(d, keys, F.col("s") - F.col("_top") < gap).withColumnRenamed("island", "cluster")


def interval_union_length(d: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, bases): bases that the intervals of a key cover."""
    w = Window.partitionBy(*keys).orderBy("s", "e")
    top = F.coalesce(F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("s") - 1)
    return d.withColumn("_new", F.greatest(F.lit(0), F.col("e") - F.greatest(F.col("s") - 1, top))).groupBy(*keys).agg(F.sum("_new").alias("bases"))


def merged(d: DataFrame, keys: list[str]) -> DataFrame:
    """The union of each key's intervals as disjoint ones; touching ones join."""
    return islands(d, keys, F.col("s") <= F.col("_top") + 1).groupBy(*keys, "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def _with_next(gene: DataFrame) -> DataFrame:
    """gene, range by range, with next: the gene that follows by (s, e, gid) on its chromosome."""
    d, cells = by_range(gene, ["chrom"])
    own = F.struct("s", "e", "gid")
    d = carried(d, ["chrom"], after=True, _far=(F.min(own), F.min))
    return d.withColumn("next", F.coalesce(F.lead(own).over(Window.partitionBy(*cells).orderBy("s", "e", "gid")), "_far")).drop("_far")


def gene_flank_distances(gene: DataFrame) -> DataFrame:
    """Each gene's neighbours by start on its chromosome, and the gaps to them; 0 if they overlap.

    The gap before a gene is to the largest end so far. A chromosome is swept range by range.
    """
    d, end = _with_next(gene), F.struct("e", "gid")
    d = carried(d, ["chrom"], _far=(F.max(end), F.max))
    near = F.max(end).over(Window.partitionBy("chrom", "_cell").orderBy("s", "e", "gid").rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_near", near).withColumn("_prev", F.when(F.col("_near").isNull() | (F.col("_far") > F.col("_near")), F.col("_far")).otherwise(F.col("_near")))
    return d.select("gid", "chrom", F.col("_prev.gid").alias("prev_gid"), F.greatest(F.lit(0), F.col("s") - F.col("_prev.e")).alias("prev_distance"), F.col("next.gid").alias("next_gid"), F.greatest(F.lit(0), F.col("next.s") - F.col("e")).alias("next_distance"))


def intergenic_distances(gene: DataFrame) -> DataFrame:
    """Gap from each gene's end to the next gene's start; negative where they overlap."""
    return _with_next(gene).filter("next IS NOT NULL").select("chrom", "gid", (F.col("next.s") - F.col("e")).alias("distance"))


def covered_bases(a: DataFrame, b: DataFrame, keys: tuple = ("chrom",)) -> DataFrame:
    """One row: common, a, b: bases of the unions of two sets, and those that both have."""
    side = lambda d, first: d.select(*keys, "s", "e", F.lit(first).alias("in_a"), F.lit(not first).alias("in_b"))
    return covered_by(side(a, True).unionAll(side(b, False)), "in_a", "in_b", keys)


def covered_by(d: DataFrame, in_a: str, in_b: str, keys: tuple = ("chrom",)) -> DataFrame:
    """covered_bases of one table, whose flags say to which of the two sets an interval belongs.

    Intervals are cut at the borders of ranges, which are swept each by itself: what an interval adds to those before it.
    What both have is what the sets have less their union; without a key nothing is in common.
    """
    d = d.select(*keys, F.col(in_a).alias("_a"), F.col(in_b).alias("_b"), "s", "e", F.explode(F.sequence(F.floor(F.col("s") / RANGE), F.floor(F.col("e") / RANGE))).alias("_cell"))
    d = d.withColumns({"s": F.greatest("s", F.col("_cell") * RANGE), "e": F.least("e", F.col("_cell") * RANGE + (RANGE - 1))})
    w = Window.partitionBy(*keys, "_cell").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    top = lambda c: F.coalesce(F.max(F.when(c, F.col("e"))).over(w), F.col("s") - 1)
    new = lambda c: F.when(c, F.greatest(F.lit(0), F.col("e") - F.greatest(F.col("s") - 1, top(c))))
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    d = d.select(known.alias("_known"), *[new(c).alias(n) for n, c in (("a", F.col("_a")), ("b", F.col("_b")), ("u", F.col("_a") | F.col("_b")))])
    n = lambda c: F.coalesce(F.sum(c), F.lit(0))
    both = [F.when(F.col("_known"), F.col(c)) for c in "abu"]
    return d.agg((n(both[0]) + n(both[1]) - n(both[2])).alias("common"), n("a").alias("a"), n("b").alias("b"))


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column, flank: int = 0) -> Column:
    """min(ends) - max(starts) with both widened by flank: intervals that share one base have 0."""
    return F.least(e1, e2) + flank - (F.greatest(s1, s2) - flank)
