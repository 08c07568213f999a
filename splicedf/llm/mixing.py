"""Mixing sources to target weights: rates from token totals, floor(rate) copies and one hash-seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splicedf.llm.common import SPACE_CLASS, maybe_broadcast, renamed

#: Weights by rank of the source, repeating; a target is at most CAP times its source's words.
WEIGHTS, CAP, SEED = (5, 2, 1), 3, "mix-1"


def word_count(text: Column) -> Column:
    """Number of runs of other than white space; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, SPACE_CLASS, -1), lambda w: w != "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size).

    The targets share all words by weight and stop at cap times their source; what is above is shared again by weight
    until none is above. That fixed point has a closed form: in ascending order of cap * size / weight the first
    sources are full, the rest take the same number of words per unit of weight. The window runs over one row a source.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    one = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(one.orderBy(F.col("source").asc_nulls_last()))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")).cast("long"))
    fill = one.orderBy(F.col("source_size") * cap / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({"words": F.sum("source_size").over(one), "weights": F.sum("weight").over(one), "full": F.coalesce(F.sum("source_size").over(fill), F.lit(0)) * cap, "spent": F.coalesce(F.sum("weight").over(fill), F.lit(0))})
    # a source is full if an equal share of what the fuller ones leave would exceed its cap
    s = s.withColumn("is_full", F.col("source_size") * cap * (F.col("weights") - F.col("spent")) <= F.col("weight") * (F.col("words") - F.col("full")))
    s = s.withColumns({"rest": F.col("words") - F.sum(F.when(F.col("is_full"), F.col("source_size") * cap).otherwise(0)).over(one), "left": F.col("weights") - F.sum(F.when(F.col("is_full"), F.col("weight")).otherwise(0)).over(one)})
    shared = (F.col("weight") * F.col("rest")).cast("double") / F.col("left")
    return s.select("source", "source_size", F.when(F.col("is_full"), (F.col("source_size") * cap).cast("double")).otherwise(shared).alias("target"))


def drawn(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on key and seed alone: 52 bits of their MD5."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":" + seed)).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def with_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """docs with _size, _source_size, _target and _copies: how often the mix takes each.

    Null sources are one source, last in order; a null or empty text has size 0 and is taken as often as any other of
    its source; a source without words is taken 0 times. Rows with the same id draw the same number, so repeated rows
    are repeated alike. Columns of other names pass through; those of the four names above are replaced. The table of sources is broadcast if it is checked to be
    small; the documents are never shuffled then.
    """
    d = docs.withColumn("_size", word_count(F.col(text_col)))
    t = source_targets(d.select(F.col(source_col).alias("source"), F.col("_size").alias("size")))
    t = t.select(F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    d = d.join(maybe_broadcast(t), d[source_col].eqNullSafe(t["_source"]), "left").drop("_source")
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    return d.withColumn("_copies", (F.floor(rate) + (drawn(F.col(id_col), seed) < rate - F.floor(rate)).cast("int")).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each document as often as with_copies says, with the columns and values of docs, whatever their names."""
    d, cols = renamed(docs)
    at = [f"c{cols.index(c)}" for c in (id_col, text_col, source_col)]
    d = with_copies(d, *at, **how).filter("_copies > 0")
    d = d.withColumn("_copy", F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return d.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])
