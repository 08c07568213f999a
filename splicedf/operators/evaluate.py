"""How well a prediction finds a reference: counts of common features and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def f1(a: Column, b: Column) -> Column:
    """Harmonic mean; 0 if both are."""
    return F.when(a + b > 0, 2 * a * b / (a + b)).otherwise(0.0)


def rates(d: DataFrame) -> DataFrame:
    """(common, pred, ref) with sn, pr and f1 in percent."""
    sn = F.when(F.col("ref") > 0, 100.0 * F.col("common") / F.col("ref")).otherwise(0.0)
    pr = F.when(F.col("pred") > 0, 100.0 * F.col("common") / F.col("pred")).otherwise(0.0)
    return d.withColumns({"sn": sn, "pr": pr}).withColumn("f1", f1(F.col("sn"), F.col("pr")))


def feature_flags(features: DataFrame, keys: list[str]) -> DataFrame:
    """Each distinct feature, with whether the reference and the prediction have it, and how often."""
    return features.groupBy(*keys).agg(F.bool_or("is_ref").alias("in_ref"), F.bool_or(~F.col("is_ref")).alias("in_pred"), F.count(F.when(F.col("is_ref"), 1)).alias("n_ref"), F.count(F.when(~F.col("is_ref"), 1)).alias("n_pred"))


def feature_confusion(features: DataFrame, keys: list[str]) -> DataFrame:
    """One row over distinct features: common, pred, ref, sn, pr, f1."""
    return flags_confusion(feature_flags(features, keys))


def weighted_confusion(features: DataFrame, keys: list[str]) -> DataFrame:
    """As feature_confusion, but a feature counts once for each transcript: recall and precision have counts of their own."""
    both = F.col("in_ref") & F.col("in_pred")
    d = feature_flags(features, keys).agg(F.sum(F.when(both, F.col("n_ref")).otherwise(0)).alias("common_ref"), F.sum(F.when(both, F.col("n_pred")).otherwise(0)).alias("common_pred"), F.sum("n_pred").alias("pred"), F.sum("n_ref").alias("ref"))
    d = d.withColumns({"sn": 100.0 * F.col("common_ref") / F.col("ref"), "pr": 100.0 * F.col("common_pred") / F.col("pred")})
    return d.withColumn("f1", f1(F.col("sn"), F.col("pr")))


def both_confusions(flags: DataFrame) -> DataFrame:
    """feature_confusion and weighted_confusion of feature_flags, a row each (weighted, common_ref, common_pred, pred, ref), from
    one look at the features."""
    both, c = F.col("in_ref") & F.col("in_pred"), lambda x: F.count(F.when(x, 1))
    n = lambda x: F.coalesce(F.sum(x), F.lit(0))
    row = lambda weighted, *cs: F.struct(F.lit(weighted).alias("weighted"), *[x.alias(k) for x, k in zip(cs, ("common_ref", "common_pred", "pred", "ref"))])
    rows = [row(False, c(both), c(both), c(F.col("in_pred")), c(F.col("in_ref"))), row(True, n(F.when(both, F.col("n_ref"))), n(F.when(both, F.col("n_pred"))), n("n_pred"), n("n_ref"))]
    return flags.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def lenient_flags(exon: DataFrame, single: DataFrame) -> DataFrame:
    """Features (kind, chrom, strand, a, b, in_ref, in_pred) of the lenient exon level.

    Of the outer exons of spliced models only the inner border counts: the end of the first, the start of the last. Inner
    exons count whole, also where another model has them at its end. Exons of unspliced models count only where `single`
    (chrom, strand, s, e) has them: those of the reference that an unspliced prediction matches. No strand counts as plus.
    """
    w = Window.partitionBy("tid").orderBy("s")
    return numbered_flags(exon.withColumns({"_i": F.row_number().over(w), "_k": F.count(F.lit(1)).over(Window.partitionBy("tid"))}), single)


def numbered_flags(exon: DataFrame, single: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """lenient_flags of exons that are the _i-th of _k of their model. Where feature_flags of all exons are known, with inner,
    whether some spliced model has the exon as an inner one, only outer exons of spliced models are asked for."""
    kinds = {"exon": 0, "start": 1, "end": 2}
    row = lambda kind, a, b, flag, ref, pred: F.struct(F.lit(kinds[kind]).cast("tinyint").alias("kind"), a.alias("a"), b.alias("b"), flag.alias("flag"), ref.alias("in_ref"), pred.alias("in_pred"))
    s, e, spliced, ref, no = F.col("s"), F.col("e"), F.col("_k") > 1, F.col("is_ref"), F.lit(False)
    first, last, none = spliced & (F.col("_i") == 1), spliced & (F.col("_i") == F.col("_k")), F.lit(0).cast("long")
    inner = spliced & ~first & ~last
    whole = row("exon", s, e, inner, ref, ~ref)
    border = F.when(first, row("start", e, none, F.lit(True), ref, ~ref)).when(last, row("end", s, none, F.lit(True), ref, ~ref))
    strand = F.coalesce("strand", F.lit("+")).alias("strand")
    d = exon.select("chrom", strand, F.inline(F.array_compact(F.array(whole, border) if known is None else F.array(border))))
    d = d.unionByName(single.select("chrom", strand, F.inline(F.array(row("exon", s, e, F.lit(True), F.lit(True), no)))))
    if known is not None:
        d = d.unionByName(known.select("chrom", strand, F.inline(F.array(row("exon", s, e, F.col("inner"), F.col("in_ref"), F.col("in_pred"))))))
    d = d.groupBy("kind", "chrom", "strand", "a", "b").agg(*[F.bool_or(c).alias(c) for c in ("in_ref", "in_pred", "flag")])
    named = F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("kind") + 1).alias("kind")
    return d.filter("flag").select(named, "chrom", "strand", "a", "b", "in_ref", "in_pred")


def lenient_confusion(exon: DataFrame, single: DataFrame) -> DataFrame:
    """One row: common, pred, ref, sn, pr, f1 of the lenient exon level."""
    return flags_confusion(lenient_flags(exon, single))


def flags_confusion(flags: DataFrame) -> DataFrame:
    c = lambda x: F.count(F.when(x, 1))
    return rates(flags.agg(c(F.col("in_ref") & F.col("in_pred")).alias("common"), c(F.col("in_pred")).alias("pred"), c(F.col("in_ref")).alias("ref")))


#: Shares of base F1 that count as found, with all splice sites in common.
FOUND = (100, 95, 80)


def found_levels(transcript: DataFrame, pairs: DataFrame) -> DataFrame:
    """Facts (key, common_ref, common_pred, pred, ref) on models and genes: tx100 to gene80, those found from that base F1 on;
    tx_private and gene_private, those that share no base with any other; mono, unspliced models that match.

    transcript (tid, gid, is_ref); pairs (tid_a, tid_b, j_f1, n_f1, ccode) of the comparison. A gene is found with any of
    its models, and private with all of them.
    """
    each = [pairs.select(F.col(f"tid_{k}").alias("tid"), F.lit(k == "b").alias("is_ref"), "j_f1", "n_f1", "ccode") for k in "ab"]
    best = each[0].unionAll(each[1]).groupBy("tid", "is_ref").agg(F.max(F.when(F.col("j_f1") >= 1, F.col("n_f1"))).alias("equal"), F.max("n_f1").alias("any"), F.bool_or(F.col("ccode") == "_").alias("mono"))
    d = transcript.select("tid", "gid", "is_ref").join(best, ["tid", "is_ref"], "left").select("gid", "is_ref", F.coalesce("equal", F.lit(-1.0)).alias("equal"), (F.coalesce("any", F.lit(0.0)) <= 0).alias("private"), F.coalesce("mono", F.lit(False)).alias("mono"))
    gene = d.groupBy("gid", "is_ref").agg(F.max("equal").alias("equal"), F.bool_and("private").alias("private"))

    def facts(of: DataFrame, kind: str, more: list) -> DataFrame:
        keys = [(f"{kind}{x}", F.col("equal") >= x / 100) for x in FOUND] + [(f"{kind}_private", F.col("private")), *more]
        n = lambda c: F.count(F.when(c, 1))
        rows = [F.struct(F.lit(k).alias("key"), n(c & F.col("is_ref")).alias("common_ref"), n(c & ~F.col("is_ref")).alias("common_pred"), n(~F.col("is_ref")).alias("pred"), n(F.col("is_ref")).alias("ref")) for k, c in keys]
        return of.agg(F.array(*rows).alias("r")).select(F.inline("r"))

    return facts(d, "tx", [("mono", F.col("mono"))]).unionAll(facts(gene, "gene", []))


#: The rows of a report, in order, each with the fact that it shows.
LEVEL_ROWS = (("Base level", "base"), ("Exon level (stringent)", "exon"), ("Exon level (lenient)", "exon_lenient"), ("Splice site level", "splice"), ("Intron level", "intron"), ("Intron level (NR)", "intron_nr"), ("Intron chain level", "chain"), ("Intron chain level (NR)", "chain_nr"),
              ("Transcript level (stringent)", "tx100"), ("Transcript level (>=95% base F1)", "tx95"), ("Transcript level (>=80% base F1)", "tx80"), ("Gene level (100% base F1)", "gene100"), ("Gene level (>=95% base F1)", "gene95"), ("Gene level (>=80% base F1)", "gene80"))
COUNT_ROWS = (("Matching intron chains", "common_pred", ("chain",)), ("Matched intron chains", "common_ref", ("chain",)), ("Matching monoexonic transcripts", "common_pred", ("mono",)), ("Matched monoexonic transcripts", "common_ref", ("mono",)), ("Total matching transcripts", "common_pred", ("chain", "mono")), ("Total matched transcripts", "common_ref", ("chain", "mono")))
MISSED_ROWS = (("Missed exons (stringent)", "ref", "exon"), ("Novel exons (stringent)", "pred", "exon"), ("Missed exons (lenient)", "ref", "exon_lenient"), ("Novel exons (lenient)", "pred", "exon_lenient"), ("Missed introns", "ref", "intron_nr"), ("Novel introns", "pred", "intron_nr"))
PRIVATE_ROWS = (("Missed transcripts (0% nF1)", "ref", "tx_private"), ("Novel transcripts (0% nF1)", "pred", "tx_private"), ("Missed genes (0% nF1)", "ref", "gene_private"), ("Novel genes (0% nF1)", "pred", "gene_private"))


def stats_report(facts: DataFrame) -> DataFrame:
    """The thirty rows (row, name, sn, pr, f1, n, total, percent) of a report from its facts, a few rows: fourteen levels in
    percent, six counts, ten of what is missed or new. Of features with nothing in common the percentage is 0."""
    shown = [(name, "level", "ref", (k,)) for name, k in LEVEL_ROWS] + [(name, "count", side.removeprefix("common_"), keys) for name, side, keys in COUNT_ROWS]
    shown += [(name, "rest", side, (k,)) for name, side, k in MISSED_ROWS] + [(name, "private", side, (k,)) for name, side, k in PRIVATE_ROWS]
    spec = [F.struct(F.lit(i).alias("row"), F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.lit(side).alias("side"), F.lit(k).alias("key")) for i, (name, kind, side, keys) in enumerate(shown, 1) for k in keys]
    d = facts.sparkSession.range(1).select(F.inline(F.array(*spec))).join(facts, "key")
    own = lambda of: F.sum(F.when(F.col("side") == "ref", F.col(f"{of}ref")).otherwise(F.col(f"{of}pred")))
    d = d.groupBy("row", "name", "kind").agg(F.sum("common_ref").alias("cr"), F.sum("common_pred").alias("cp"), F.sum("ref").alias("r"), F.sum("pred").alias("p"), own("common_").alias("c"), own("").alias("of"))
    share = lambda a, b: F.when(F.col(b) > 0, 100.0 * F.col(a) / F.col(b)).otherwise(0.0)
    level, rest, private = (F.col("kind") == k for k in ("level", "rest", "private"))
    d = d.withColumns({"sn": F.when(level, share("cr", "r")), "pr": F.when(level, share("cp", "p")), "gone": F.col("of") - F.col("c")})
    percent = F.when(rest, F.when(F.col("c") > 0, 100.0 * F.col("gone") / F.col("of")).otherwise(0.0)).when(private, share("c", "of"))
    return d.select("row", "name", "sn", "pr", F.when(level, f1(F.col("sn"), F.col("pr"))).alias("f1"), F.when(rest, F.col("gone")).when(~level, F.col("c")).alias("n"), F.when(rest | private, F.col("of")).alias("total"), percent.alias("percent"))


def missed_novel(features: DataFrame, keys: list[str]) -> DataFrame:
    """One row: features of the reference alone (missed) and of the prediction alone (novel), with totals and percent."""
    c = lambda x: F.count(F.when(x, 1))
    d = feature_flags(features, keys).agg(c(F.col("in_ref") & ~F.col("in_pred")).alias("missed"), c(F.col("in_ref")).alias("ref"), c(F.col("in_pred") & ~F.col("in_ref")).alias("novel"), c(F.col("in_pred")).alias("pred"))
    return d.withColumns({"missed_pct": 100.0 * F.col("missed") / F.col("ref"), "novel_pct": 100.0 * F.col("novel") / F.col("pred")})


def base_level(bases: DataFrame) -> DataFrame:
    """sn, pr and f1 from (common, a, b) of covered_bases: a the reference, b the prediction."""
    return rates(bases.select("common", F.col("b").alias("pred"), F.col("a").alias("ref")))


def distributions(values: DataFrame) -> DataFrame:
    """(stat, value, weight) to a row a stat: total, average, mode, min, percentiles, max. All are weighted and exact."""
    ps = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
    w = values.groupBy("stat", "value").agg(F.sum("weight").alias("weight"))
    d = w.groupBy("stat").agg(F.sum(F.col("value") * F.col("weight")).alias("total"), F.sum("weight").alias("n"), F.max(F.struct(F.col("weight"), (-F.col("value")).alias("v"))).alias("m"), F.min("value").alias("min"), F.max("value").alias("max"), F.percentile("value", [float(p) for p in ps], F.col("weight")).alias("p"))
    return d.select("stat", "total", "n", (F.col("total") / F.col("n")).alias("average"), (-F.col("m.v")).alias("mode"), "min", *[F.col("p")[i].alias(f"p{int(p * 100)}") for i, p in enumerate(ps)], "max")
