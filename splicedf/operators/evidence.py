"""Evidence: protein hits, junctions, external scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators.intervals import interval_union_length


def blast_normalise(hsp: DataFrame, qmult: int = 3) -> DataFrame:
    """Starts before ends, from 0, with the frame of the query: 1 to 3, negative where the coordinates were swapped."""
    low, high = F.least("qstart", "qend"), F.greatest("qstart", "qend")
    frame = F.pmod(low - 1, F.lit(qmult)) + 1
    return hsp.select(*[c for c in hsp.columns if c not in ("qstart", "qend")], (low - 1).alias("qstart"), high.alias("qend"), F.when(F.col("qstart") > F.col("qend"), -frame).otherwise(frame).cast("int").alias("frame"))


def hit_aggregate(hsp: DataFrame) -> DataFrame:
    """Best of each (query, target): the largest negative log10 of the evalue, the largest score."""
    return hsp.groupBy("query", "target").agg(F.max("nlog").alias("nlog"), F.max("bitscore").alias("bitscore"), F.count(F.lit(1)).alias("n_hsp"))


def hsp_rank(hsp: DataFrame) -> DataFrame:
    w = Window.partitionBy("query", "target").orderBy(F.desc("bitscore"), "qstart", "qend", "n", "nlog")
    return hsp.withColumn("hsp_num", F.row_number().over(w))


def hit_rank(hit: DataFrame) -> DataFrame:
    return hit.withColumn("hit_num", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bitscore"), "target")))


def top_hits_with_ties(hit: DataFrame, n: int = 3, min_nlog: int = 6) -> DataFrame:
    """The best n targets of a query, and all whose evalue equals the last one's."""
    return hit.filter(F.col("nlog") >= min_nlog).withColumn("rank", F.rank().over(Window.partitionBy("query").orderBy(F.desc("nlog")))).filter(F.col("rank") <= n)


def hit_coverage(hsp: DataFrame) -> DataFrame:
    """Bases of the query that the HSPs of each hit cover, and their share of it."""
    u = interval_union_length(hsp.select("query", "target", F.col("qstart").alias("s"), F.col("qend").alias("e")), ["query", "target"])
    n = hsp.groupBy("query", "target").agg(F.max("qlen").alias("qlen"), F.max("tlen").alias("tlen"))
    return u.join(n, ["query", "target"]).select("query", "target", F.col("bases").alias("aligned"), (F.col("bases") / F.col("qlen")).alias("query_coverage"))


def blast_metrics(hit: DataFrame, coverage: DataFrame) -> DataFrame:
    d = hit.join(coverage, ["query", "target"])
    best = F.struct(F.col("nlog"), F.col("bitscore"), (-F.col("target")).alias("t"))
    return d.groupBy(F.col("query").alias("tid")).agg(F.max("bitscore").alias("best_bits"), F.max_by("query_coverage", best).alias("blast_query_coverage"), F.count(F.lit(1)).alias("n_hits"))


def verified_introns(intron: DataFrame, junction: DataFrame) -> DataFrame:
    """Introns with verified: a junction has the same ends, and the same strand or none."""
    place = junction.groupBy("chrom", "s", "e").agg(F.collect_set("strand").alias("_strands"), F.bool_or(F.col("strand").isNull()).alias("_any"))
    hit = F.col("_any") | F.array_contains("_strands", F.col("strand"))
    return intron.join(place, ["chrom", "s", "e"], "left").withColumn("verified", F.coalesce(hit, F.lit(False))).drop("_strands", "_any")


def verified_intron_metrics(checked: DataFrame) -> DataFrame:
    d = checked.groupBy("tid").agg(F.count(F.when(F.col("verified"), 1)).alias("verified_introns_num"), F.count(F.when(~F.col("verified"), 1)).alias("non_verified_introns_num"))
    return d.withColumn("proportion_verified_introns", F.col("verified_introns_num") / (F.col("verified_introns_num") + F.col("non_verified_introns_num")))


def junction_merge(samples: DataFrame) -> DataFrame:
    """Junctions of many samples: one a place and strand, with the sum of scores and the names of the samples."""
    names = F.array_join(F.array_sort(F.collect_set("sample")), ";")
    return samples.groupBy("chrom", "strand", "s", "e").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("n"), names.alias("samples"))


def external_long(wide: DataFrame, names: list[str]) -> DataFrame:
    return wide.unpivot("tid", names, "source", "score").na.fill(0)


def external_valid_raw(long: DataFrame) -> DataFrame:
    """Per source: whether its scores can be used as they are, lying between 0 and 1."""
    d = long.groupBy("source").agg(F.min("score").alias("min_score"), F.max("score").alias("max_score"))
    return d.withColumn("valid_raw", (F.col("min_score") >= 0) & (F.col("max_score") <= 1))


OPERATORS = ("eq", "ne", "gt", "lt", "ge", "le", "in", "not in", "within", "not within")


def predicate(c: Column, operator: str, value) -> Column:
    """A condition of a scoring scheme. within takes both ends, in either order."""
    if operator not in OPERATORS:
        raise ValueError(f"no such operator: {operator}")
    if "within" in operator:
        inside = c.between(min(value), max(value))
        return ~inside if operator.startswith("not") else inside
    if operator in ("in", "not in"):
        return c.isin(list(value)) if operator == "in" else ~c.isin(list(value))
    return {"eq": c == value, "ne": c != value, "gt": c > value, "lt": c < value, "ge": c >= value, "le": c <= value}[operator]


def requirement(section: dict) -> Column:
    """{'parameters': {name: {operator, value}}, 'expression': 'a and (b or not c)'} as a Column; no eval.

    A name is a metric, with what follows a point only telling two of one metric apart. Without an expression all hold.
    """
    conditions = {k: predicate(F.col(k.split(".")[0]), p["operator"], p["value"]) for k, p in section["parameters"].items()}
    if not section.get("expression"):
        return reduce(lambda a, b: a & b, conditions.values(), F.lit(True))
    words = section["expression"].replace("(", " ( ").replace(")", " ) ").split()
    at = 0

    def take(*kinds: str) -> str | None:
        nonlocal at
        if at < len(words) and words[at].lower() in kinds:
            at += 1
            return words[at - 1].lower()
        return None

    def term() -> Column:
        nonlocal at
        if take("not"):
            return ~term()
        if take("("):
            inner = disjunction()
            if not take(")"):
                raise ValueError("unbalanced expression")
            return inner
        if at >= len(words) or words[at] not in conditions:
            raise ValueError(f"unknown name in expression: {' '.join(words[at : at + 1])}")
        at += 1
        return conditions[words[at - 1]]

    def conjunction() -> Column:
        c = term()
        while take("and"):
            c = c & term()
        return c

    def exclusive() -> Column:
        c = conjunction()
        while take("xor"):
            c = c != conjunction()
        return c

    def disjunction() -> Column:
        c = exclusive()
        while take("or"):
            c = c | exclusive()
        return c

    out = disjunction()
    if at != len(words):
        raise ValueError("expression goes on after its end")
    return out


def score(metric: Column, group: list[str], rescaling: str, value: float | None = None, multiplier: float = 1.0, passing: Column | None = None) -> Column:
    """A metric rescaled within its group: max, min or target. Rows that do not pass score 0 and set no bounds. Rounded to
    two places, halves up, in plain double arithmetic."""
    w = Window.partitionBy(*group)
    m = F.when(passing, metric) if passing is not None else metric
    low, high = F.min(m).over(w), F.max(m).over(w)
    if rescaling == "target":
        far = F.max(F.abs(m - value)).over(w)
        s = F.when(far == 0, F.lit(1.0)).otherwise(1 - F.abs(m - value) / far)
    else:
        part = (m - low) / (high - low)
        s = F.when(high == low, F.lit(1.0)).otherwise(part if rescaling == "max" else 1 - part)
    return F.floor(F.coalesce(multiplier * s, F.lit(0.0)) * 100 + 0.5) / 100


def choose_best(d: DataFrame, group: list[str], score_col: str = "score") -> DataFrame:
    """The row with the highest score of each group; ties go to the smallest tid."""
    return d.groupBy(*group).agg(F.max_by("tid", F.struct(F.col(score_col), (-F.col("tid")).alias("t"))).alias("tid"), F.max(score_col).alias(score_col))


def attribute(name: str, default: float, percentage: bool = False) -> Column:
    """A number from the map column attributes, or the default; a percentage is divided by 100."""
    v = F.coalesce(F.expr(f"try_cast(attributes['{name}'] AS DOUBLE)"), F.lit(float(default)))
    return v / 100.0 if percentage else v


def score_raw(metric: Column, multiplier: float = 1.0) -> Column:
    """A metric that is a share as its own score, rounded as score() is; a value outside 0 to 1 is an error."""
    bad = F.raise_error(F.concat(F.lit("no share: "), metric.cast("string"))).cast("double")
    return F.floor(F.when((metric < 0) | (metric > 1), bad).otherwise(metric) * multiplier * 100 + 0.5) / 100
