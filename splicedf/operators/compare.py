"""A prediction beside a reference: what every overlapping pair of transcripts shares, its class code, the best match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators.evaluate import f1
from splicedf.operators.intervals import join_overlap, join_within_distance
from splicedf.operators.model import introns, remove_utrs, transcript_bounds

PAIR = ["tid_a", "tid_b"]


def candidate_pairs(pred: DataFrame, ref: DataFrame, distance: int) -> DataFrame:
    """Pairs (tid_a predicted, tid_b reference) at most `distance` apart."""
    cols = ["chrom", "tid", "s", "e"]
    return join_within_distance(pred.select(*cols), ref.select(*cols), distance).select(*PAIR)


def _code(s: Column, e: Column) -> Column:
    """An interval as one number, for coordinates below 2^33 and lengths up to 2^30."""
    return F.shiftleft(s.cast("long"), 30) + (e - s)


def models(transcript: DataFrame, exon: DataFrame | None = None) -> DataFrame:
    """Transcripts with their exons as an array x of numbers, sorted. Without exons, transcripts have them as a column xs (of model_rows)."""
    d = transcript
    if exon is not None:
        d = d.drop("xs").join(exon.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("xs")), "tid")
    return d.select("tid", "gid", "chrom", "strand", "s", "e", "n_exons", "cdna", F.transform("xs", lambda x: _code(x.s, x.e)).alias("x"))


def _bounds():
    """Start and end of an interval from its number."""
    start = lambda x: F.shiftright(x, 30)
    return start, lambda x: start(x) + x.bitwiseAND(F.lit((1 << 30) - 1))


def parts(d: DataFrame, k: str) -> DataFrame:
    """d with what follows from the exons x of side k, as arrays: introns gaps and their numbers i, splice sites j with their
    side, their positions p. Made of pairs, as exons alone are shorter to send."""
    (start, end), rest, x = _bounds(), F.size(f"x_{k}") - 1, f"x_{k}"
    d = d.withColumn(f"gaps_{k}", F.zip_with(F.slice(x, 1, rest), F.slice(x, 2, rest), lambda a, b: F.struct((end(a) + 1).alias("s"), (start(b) - 1).alias("e"))))
    g = f"gaps_{k}"
    ends = lambda f: F.concat(F.transform(g, lambda g: f(g.s, 0)), F.transform(g, lambda g: f(g.e, 1)))
    return d.withColumns({f"i_{k}": F.transform(g, lambda g: _code(g.s, g.e)), f"j_{k}": F.array_distinct(ends(lambda pos, side: pos * 2 + side)), f"p_{k}": F.array_distinct(ends(lambda pos, side: pos))})


def common_bases(a: str, b: str) -> Column:
    """Bases that the exons of two models share, from their arrays of numbers."""
    start, end = _bounds()
    zero = F.lit(0).cast("long")
    met = lambda x, y: F.greatest(zero, F.least(end(x), end(y)) - F.greatest(start(x), start(y)) + 1)
    return F.aggregate(a, zero, lambda n, x: F.aggregate(b, n, lambda m, y: m + met(x, y)))


def pair_features(pairs: DataFrame, a: DataFrame, b: DataFrame, key: str = "tid_b") -> DataFrame:
    """pairs with both models' columns and what they share: n_common bases, e_common exons, i_common introns, j_common splice sites on the
    same side (of j_a and j_b), and what class codes ask.

    new_inside and new_within: positions of sites of a that b lacks, between b's outermost sites or within b; missed:
    introns of b that a lacks and could have shown; of a monoexonic a, m_n introns of b that it reaches into, by m_first and
    m_second bases, the first of length m_len. pairs may have another key instead of tid_b, which b has too: then each row
    meets all models of b with it, and a's columns are shuffled once for all of these.
    """
    side = lambda d, k: d.select(*[F.col(c).alias(c if c == key or c == "chrom" and k == "a" else f"{c}_{k}") for c in d.columns if c != "chrom" or k == "a"])
    d = parts(parts(pairs.join(side(a, "a"), "tid_a").join(side(b, "b"), key), "a"), "b")
    same = lambda c: F.size(F.array_intersect(f"{c}_a", f"{c}_b")).cast("long")
    multi = (F.col("n_exons_a") > 1) & (F.col("n_exons_b") > 1)
    counted = lambda c: F.when(multi, F.size(c)).otherwise(0).cast("long")
    new = F.array_except("p_a", "p_b")
    d = d.withColumns({"n_common": common_bases("x_a", "x_b"), "e_common": same("x"), "i_common": same("i"), "j_common": same("j"), "j_a": F.size("j_a").cast("long"), "j_b": F.size("j_b").cast("long"), "distance": F.greatest(F.lit(0), F.greatest("s_a", "s_b") - F.least("e_a", "e_b"))})
    low_a, high_a, low_b, high_b = F.array_min("p_a"), F.array_max("p_a"), F.array_min("p_b"), F.array_max("p_b")
    gone = F.filter("gaps_b", lambda g: (((F.col("s_a") < g.s) & (g.e < low_a)) | ((F.col("e_a") > g.e) & (g.s > high_a))) & ~F.array_contains(F.col("i_a"), _code(g.s, g.e)))
    bases = lambda g: F.least(g.e, F.col("e_a")) - F.greatest(g.s, F.col("s_a"))
    d = d.withColumns({"new_inside": counted(F.filter(new, lambda x: (x > low_b) & (x < high_b))), "new_within": counted(F.filter(new, lambda x: (x > F.col("s_b")) & (x < F.col("e_b")))), "missed": counted(gone)})
    mono = (F.col("n_exons_a") == 1) & (F.col("n_exons_b") > 1)
    d = d.withColumn("_m", F.when(mono, F.transform(F.filter("gaps_b", lambda g: bases(g) > 0), lambda g: F.struct(bases(g).alias("bases"), (g.e - g.s + 1).alias("n")))))
    at = lambda k, c: F.coalesce(F.get("_m", F.lit(k))[c], F.lit(0))
    return d.withColumns({"m_n": F.coalesce(F.size("_m"), F.lit(0)), "m_first": at(0, "bases"), "m_second": at(1, "bases"), "m_len": at(0, "n")}).drop("_m", "p_a", "p_b", "x_a", "x_b", "i_a", "i_b")


def class_code_multi() -> Column:
    """Both of several exons. Every branch looks at counts only, so the order of introns plays no part."""
    return F.expr("""CASE
      WHEN j_common = j_b AND j_common < j_a THEN CASE WHEN new_inside > 0 THEN 'j' WHEN new_within > 0 THEN 'J' ELSE 'n' END
      WHEN j_common > 0 AND j_common < j_a AND j_common < j_b THEN 'j'
      WHEN j_common = j_a AND j_common < j_b THEN CASE WHEN i_common < n_exons_a - 1 THEN 'j' WHEN n_common = cdna_a THEN 'c' WHEN missed > 0 THEN 'j' ELSE 'C' END
      WHEN n_common > 0 THEN CASE WHEN i_touch > 0 THEN 'h' ELSE 'o' END
      WHEN s_b < s_a AND s_a < e_b THEN 'I' WHEN s_a < s_b AND s_b < e_a THEN 'rI' END""")


def class_code_mono() -> Column:
    """At least one of a single exon. The ten bases are how far an exon may reach into an intron and count as noise."""
    return F.expr("""CASE
      WHEN n_exons_a = 1 AND n_exons_b > 1 THEN CASE
        WHEN n_common = cdna_a THEN 'c'
        WHEN n_common > 0 THEN CASE WHEN m_n = 1 AND m_first > 10 AND m_first < m_len AND s_b < s_a AND e_a < e_b THEN 'e' WHEN m_n = 2 AND NOT (m_first < 10 AND m_second < 10) THEN 'e' ELSE 'g' END
        WHEN s_b < s_a AND s_a < e_b THEN 'i' END
      WHEN n_exons_a > 1 THEN CASE WHEN n_common = cdna_b THEN 'n' WHEN n_common > 0 THEN 'G' WHEN least(e_a, e_b) - greatest(s_a, s_b) > 0 THEN 'ri' ELSE 'p' END
      WHEN n_common = cdna_a THEN 'c' ELSE 'm' END""")


def class_code(strict_strand: bool = False) -> Column:
    """Equal, then outside, then by exon numbers; other strands demote to x or X. No code is an error, never null."""
    first = F.expr("""CASE
      WHEN n_exons_a > 1 AND n_exons_b > 1 AND j_common = j_a AND j_common = j_b THEN CASE WHEN strand_a <=> strand_b THEN '=' ELSE 'c' END
      WHEN n_exons_a = 1 AND n_exons_b = 1 AND n_f1 >= 0.8 THEN '_'
      WHEN s_a > e_b OR e_a < s_b THEN CASE WHEN strand_a <=> strand_b THEN 'p' ELSE 'P' END END""")
    code = F.coalesce(first, F.when((F.col("n_exons_a") > 1) & (F.col("n_exons_b") > 1), class_code_multi()).otherwise(class_code_mono()), F.raise_error(F.lit("no class code")).cast("string"))
    other = ~F.col("strand_a").eqNullSafe(F.col("strand_b"))
    if not strict_strand:
        other = other & F.col("strand_a").isNotNull() & F.col("strand_b").isNotNull()
    demoted = F.when(code.isin("e", "g", "c", "m", "_", "C"), "x").when(~code.isin("u", "i", "I", "p", "P", "x"), "X").otherwise(code)
    return F.when(other, demoted).otherwise(code)


def compare_pairs(pred: tuple, ref: tuple, distance: int = 0, strict_strand: bool = False, pairs: DataFrame | None = None, by_gene: bool = False) -> DataFrame:
    """A row a pair: shared bases, exons and splice sites with recall, precision and F1 of each, distance and ccode.

    pred and ref are (transcript, exon, ...), or model_rows alone; pairs (tid_a, tid_b and other columns, which stay) are those at most `distance`
    apart unless given. A model's exons meet it once, as arrays of numbers. With by_gene, pairs have gene instead of tid_b, and
    a row stands for all the gene's reference models.
    """
    pairs = candidate_pairs(pred[0], ref[0], distance) if pairs is None else pairs
    b = models(*ref[:2])
    d = pair_features(pairs, models(*pred[:2]), genes_of(b) if by_gene else b, "gene" if by_gene else "tid_b")
    touch = (F.col("j_common") == 0) & (F.col("n_common") > 0) & F.exists("gaps_a", lambda x: F.exists("gaps_b", lambda y: F.least(x.e, y.e) > F.greatest(x.s, y.s)))
    d = d.withColumn("i_touch", touch.cast("int")).drop("gaps_a", "gaps_b")
    both_mono = (F.col("n_exons_a") == 1) & (F.col("n_exons_b") == 1) & (F.col("n_common") > 0)
    share = lambda n, of: F.when(F.col(of) > 0, F.col(n) / F.col(of)).otherwise(0.0)
    d = d.withColumns({"n_prec": share("n_common", "cdna_a"), "n_recall": share("n_common", "cdna_b"), "e_prec": share("e_common", "n_exons_a"), "e_recall": share("e_common", "n_exons_b"), "j_prec": F.when(both_mono, 1.0).otherwise(share("j_common", "j_a")), "j_recall": F.when(both_mono, 1.0).otherwise(share("j_common", "j_b"))})
    d = d.withColumns({f"{k}_f1": f1(F.col(f"{k}_recall"), F.col(f"{k}_prec")) for k in "nej"})
    return d.withColumn("ccode", class_code(strict_strand))


def with_options(side: tuple, cds: DataFrame, exclude_utr: bool = False, protein_coding: bool = False) -> tuple:
    """A side (transcript, exon, intron) of the comparison: coding models cut to their coding span, others as they are; or
    coding models alone."""
    exon = side[1]
    coding = cds.select("tid").distinct()
    if protein_coding:
        exon = exon.join(coding, "tid", "left_semi")
    if exclude_utr:
        cut = remove_utrs(exon, cds.select("tid", "s", "e"))
        rest = exon.columns
        same = exon.groupBy("tid").agg(*[F.min(c).alias(c) for c in rest if c not in ("tid", "s", "e")])
        exon = exon.join(coding, "tid", "left_anti").select(*rest).unionByName(cut.join(same, "tid").select(*rest))
    return transcript_bounds(exon), exon, introns(exon)


def by_f1(other: str) -> list[Column]:
    """Best first: junction and base F1, then distance, then a code on the same strand, then ids."""
    return [F.desc("j_f1"), F.desc("n_f1"), F.asc("distance"), F.col("ccode").isin("x", "X").asc(), F.asc(other)]


def best_by_f1(pairs: DataFrame, key: str = "tid_a") -> DataFrame:
    """The best pair of each key."""
    w = Window.partitionBy(key).orderBy(*by_f1("tid_b" if key == "tid_a" else "tid_a"))
    return pairs.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def genes_of(transcript: DataFrame) -> DataFrame:
    """transcript with gene: what a gene has on one strand is a gene of its own."""
    return transcript.withColumn("gene", F.concat_ws("", F.col("gid").cast("string"), F.coalesce("strand", F.lit("."))))


def candidate_genes(pred: DataFrame, ref: DataFrame, distance: int) -> DataFrame:
    """(tid_a, gene, gs, ge, mode, counts): the genes that a prediction is held against, how, and whether they may match.

    beside: none overlaps, so the nearest one. one: those of one place (bounds). many: those of several places; where some
    are on the prediction's strand, the others do not count. Of several places of which none is on the prediction's
    strand the first counts alone.
    """
    g = genes_of(ref).groupBy("gene").agg(F.min("chrom").alias("chrom"), F.min("strand").alias("strand"), F.min("s").alias("s"), F.max("e").alias("e"))
    d = join_within_distance(pred.select("chrom", "tid", "strand", "s", "e"), g, distance)
    w = Window.partitionBy("tid_a")
    place, same = F.struct("s_b", "e_b"), F.col("strand_a").isNotNull() & F.col("strand_a").eqNullSafe(F.col("strand_b"))
    fits = F.col("strand_b").isNull() | same
    d = d.withColumn("_near", F.min("distance").over(w)).filter("distance = _near")
    d = d.withColumns({"_n": F.size(F.collect_set(place).over(w)), "_m": F.size(F.collect_set(F.when(fits, place)).over(w)), "_k": F.row_number().over(w.orderBy("s_b", "e_b", "gene_b")), "_first": F.min(place).over(w), "_fits": F.max(fits).over(Window.partitionBy("tid_a", "s_b", "e_b"))})
    beside, plain = F.col("distance") > 0, F.col("strand_a").isNull()
    keep = F.when(beside, F.col("_k") == 1).when((F.col("_n") == 1) | plain, True).when(F.col("_m") == 0, F.col("_first") == place).otherwise(F.col("_fits"))
    several = F.when(plain, F.col("_n")).otherwise(F.col("_m")) > 1
    d = d.filter(keep).withColumn("mode", F.when(beside, "beside").when(several, "many").otherwise("one")).withColumn("_same", F.max(same).over(w))
    return d.select("tid_a", F.col("gene_b").alias("gene"), F.col("s_b").alias("gs"), F.col("e_b").alias("ge"), "mode", ((F.col("mode") != "many") | ~F.col("_same") | same).alias("counts"))


def compared(pred: tuple, ref: tuple, distance: int = 2000) -> DataFrame:
    """The pairs of all predictions with the transcripts of the genes that they are held against."""
    return compare_pairs(pred, ref, pairs=candidate_genes(pred[0], ref[0], distance), by_gene=True)


#: The columns of a table of matches.
TMAP = ("ref_id", "ref_gene", "ccode", "tid", "gid", "tid_num_exons", "ref_num_exons", "n_prec", "n_recall", "n_f1", "j_prec", "j_recall", "j_f1", "e_prec", "e_recall", "e_f1", "distance", "location")
RATES = TMAP[7:16]


def tmap(pred: tuple, ref: tuple, distance: int = 2000, report_fusions: bool = True) -> DataFrame:
    """The matches of every predicted transcript: one row, or one for each gene that it fuses; code u without a gene near.

    Of genes beside a prediction (run-on) the nearest one's nearest transcript matches, of overlapping ones the transcript
    that is best by F1. A prediction over several places fuses those whose best transcript shares a splice site with it or
    has a tenth of its bases covered; two or more such give a row each, with f before the code. Where there is one, it
    matches alone; where there is none, the best of what there is.
    """
    c, many = compared(pred, ref, distance).filter("counts"), F.col("mode") == "many"
    order = [F.when(F.col("mode") == "beside", F.col("distance")).otherwise(0), *by_f1("tid_b")]
    c = c.withColumn("_g", F.row_number().over(Window.partitionBy("tid_a", "gene").orderBy(*order))).filter("_g = 1")
    c = c.withColumn("_weak", many & (F.col("j_f1") == 0) & (F.col("n_recall") < 0.1))
    c = c.withColumn("_p", F.row_number().over(Window.partitionBy("tid_a", "gs", "ge").orderBy("_weak", *order)))
    w = Window.partitionBy("tid_a")
    c = c.withColumn("_good", many & ~F.col("_weak") & (F.col("_p") == 1)).withColumns({"_n": F.sum(F.col("_good").cast("int")).over(w), "_t": F.row_number().over(w.orderBy("_weak", *order))})
    fused = F.lit(report_fusions) & F.col("_good") & (F.col("_n") > 1)
    c = c.withColumn("_fused", fused).filter(fused | (F.col("_t") == 1) & ~(F.lit(report_fusions) & (F.col("_n") > 1)))
    low, high = F.min(F.least("s_a", "s_b")).over(w), F.max(F.greatest("e_a", "e_b")).over(w)
    place = F.concat(F.col("chrom"), F.lit(":"), low.cast("string"), F.lit(".."), high.cast("string"))
    c = c.select(F.col("tid_a").alias("tid"), F.col("tid_b").alias("ref_id"), F.col("gid_b").alias("ref_gene"), F.when(F.col("_fused"), F.concat(F.lit("f,"), "ccode")).otherwise(F.col("ccode")).alias("ccode"), F.col("n_exons_b").alias("ref_num_exons"), *RATES, "distance", place.alias("_at"))
    own = F.concat(F.col("chrom"), F.lit(":"), F.col("s").cast("string"), F.lit(".."), F.col("e").cast("string"))
    d = pred[0].select("tid", "gid", F.col("n_exons").alias("tid_num_exons"), own.alias("_own")).join(c, "tid", "left")
    d = d.withColumns({"ccode": F.coalesce("ccode", F.lit("u")), "location": F.coalesce("_at", "_own"), **{r: F.coalesce(r, F.lit(0.0)) for r in RATES}})
    return d.select(*TMAP)


def refmap(pairs: DataFrame, ref: DataFrame) -> DataFrame:
    """A row a reference transcript: its best prediction; NA without one."""
    best = best_by_f1(pairs, "tid_b").select("tid_b", "tid_a", "ccode", "n_f1", "j_f1")
    return ref.select(F.col("tid").alias("tid_b")).join(best, "tid_b", "left").withColumn("ccode", F.coalesce("ccode", F.lit("NA")))


def compare_self(side: tuple) -> DataFrame:
    """Every transcript beside every other one that it overlaps."""
    return compare_pairs(side, side).filter("tid_a <> tid_b")
