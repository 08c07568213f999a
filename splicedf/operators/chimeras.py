"""Chimeras: models with several reading frames, parted where hits do not hold neighbouring frames together.

A run of neighbouring frames is closed by a rule on the two frames at its border alone, so the borders are flags by row and
the parts their running sum. A part is one interval on the transcript, whatever its exons; exons are cut to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splicedf.operators.model import exon_cumulative_offset

NOSPLIT, STRINGENT, LENIENT, PERMISSIVE, SPLIT = MODES = ("NOSPLIT", "STRINGENT", "LENIENT", "PERMISSIVE", "SPLIT")
MIN_OVERLAP, MIN_DUPLICATION, MAX_EVALUE = 0.5, 0.8, 1e-6


def _shared(a1: str, b1: str, a2: str, b2: str):
    """How far two intervals overlap: 0 for one base in common, below it for none."""
    return F.least(b1, b2) - F.greatest(a1, a2)


def frame_evidence(orf: DataFrame, hsp: DataFrame, min_overlap: float = MIN_OVERLAP, min_duplication: float = MIN_DUPLICATION, max_evalue: float = MAX_EVALUE) -> DataFrame:
    """Frames (tid, s, e) with hits (targets of the frame), before (those of the frame before, null for the first) and joined.

    hsp: (tid, target, tlen, qs, qe, ts, te, evalue), on the transcript and on the target. A target is the frame's if an HSP
    of it, good enough, overlaps min_overlap of the frame. Common targets of two neighbouring frames join them if their HSPs
    there overlap on the transcript, or overlap on the target by less than min_duplication of it; what overlaps there by
    more is a tandem duplication.
    """
    w = Window.partitionBy("tid").orderBy("s", "e")
    good = hsp.filter(F.col("evalue") <= max_evalue).select("tid", "target", "tlen", "qs", "qe", "ts", "te")
    found = orf.select("tid", "s", "e", F.row_number().over(w).alias("_k")).alias("f").join(good.alias("h"), (F.col("f.tid") == F.col("h.tid")) & (_shared("s", "e", "qs", "qe") >= min_overlap * (F.col("e") + 1 - F.col("s"))), "left").drop(F.col("h.tid"))
    # a row a frame and target, with the HSPs between these two; what is grouped by tid and more stays where it is
    d = found.groupBy("tid", "s", "e", "_k", "target", "tlen").agg(F.collect_list(F.struct("qs", "qe", "ts", "te")).alias("own"))
    of = Window.partitionBy("tid", "target", "tlen").orderBy("_k")
    shared = lambda a, b, s, e: F.least(a[e], b[e]) - F.greatest(a[s], b[s])
    on_target = lambda a, b: (shared(a, b, "ts", "te") >= 0) & (shared(a, b, "ts", "te") / F.col("tlen") < min_duplication)
    held = F.exists("own", lambda a: F.exists("_own", lambda b: (shared(a, b, "qs", "qe") >= 0) | on_target(a, b)))
    d = d.withColumns({"_own": F.lag("own").over(of), "_beside": F.lag("_k").over(of) == F.col("_k") - 1})
    d = d.groupBy("tid", "s", "e", "_k").agg(F.count("target").alias("hits"), F.coalesce(F.bool_or(F.col("target").isNotNull() & F.col("_beside") & held), F.lit(False)).alias("joined"))
    return d.withColumn("before", F.lag("hits").over(w)).select("tid", "s", "e", "hits", "before", "joined")


def chimera_decide(evidence: DataFrame, mode: str = STRINGENT) -> DataFrame:
    """(tid, s, e, part, from, to): the frames of each model in parts from 1 on, and each part's bounds.

    Two frames with hits part unless those join them. Of frames without any, STRINGENT parts none; LENIENT parts where both
    lack them, PERMISSIVE also where one does. NOSPLIT parts never, SPLIT always.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    w = Window.partitionBy("tid").orderBy("s", "e")
    fewer, more = F.least("hits", "before"), F.greatest("hits", "before")
    parts = F.when(more == 0, mode in (LENIENT, PERMISSIVE)).when(fewer == 0, mode == PERMISSIVE).otherwise(~F.col("joined"))
    parts = {NOSPLIT: F.lit(False), SPLIT: F.lit(True)}.get(mode, parts)
    d = evidence.withColumn("part", (F.sum(F.when(F.col("before").isNotNull() & parts, 1).otherwise(0)).over(w) + 1).cast("int"))
    run = Window.partitionBy("tid", "part")
    return d.select("tid", "s", "e", "part", F.min("s").over(run).alias("from"), F.max(F.struct("s", "e")).over(run)["e"].alias("to"))


def chimera_split(exon: DataFrame, decided: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((tid, part, s, e), (tid, part, s, e), (tid)): exons and frames of the parts of models with more than one, and the
    models whose parts would collide, which stay whole and lose their coding part. Leave out of `decided` what must not be split.

    Inner borders are those of the frames; an exon of which one base alone would be left at a border keeps two. The untranslated
    ends stay with the outer parts. Frames count from their part's start.
    """
    parts = decided.groupBy("tid", "part").agg(F.min("from").alias("from"), F.min("to").alias("to")).withColumn("n", F.max("part").over(Window.partitionBy("tid"))).filter("n > 1")
    x = exon_cumulative_offset(exon).select("tid", "strand", F.col("s").alias("gs"), F.col("e").alias("ge"), (F.col("offset") + 1).alias("ts"), (F.col("offset") + F.col("e") - F.col("s") + 1).alias("te"))
    d = x.join(parts, "tid")
    left, right = F.col("part") > 1, F.col("part") < F.col("n")
    a = F.when(left & (F.col("te") == F.col("from")), F.greatest("ts", F.col("from") - 1)).when(left, F.greatest("ts", "from")).otherwise(F.col("ts"))
    b = F.when(right & (F.col("ts") == F.col("to")), F.least("te", F.col("to") + 1)).when(right, F.least("te", "to")).otherwise(F.col("te"))
    d = d.withColumns({"a": a, "b": b}).filter("a <= b")
    minus = F.col("strand") == "-"
    d = d.select("tid", "part", "a", "b", F.when(minus, F.col("ge") - (F.col("b") - F.col("ts"))).otherwise(F.col("gs") + F.col("a") - F.col("ts")).alias("s"), F.when(minus, F.col("ge") - (F.col("a") - F.col("ts"))).otherwise(F.col("gs") + F.col("b") - F.col("ts")).alias("e"))
    span = d.groupBy("tid", "part").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.min("s").alias("s"), F.max("e").alias("e"))
    w = Window.partitionBy("tid").orderBy("part")
    clash = span.withColumns({"_s": F.lag("s").over(w), "_e": F.lag("e").over(w)}).filter(F.col("_s").isNotNull() & (_shared("s", "e", "_s", "_e") > 0)).select("tid").distinct()
    frames = decided.join(span.select("tid", "part", "a", "b"), ["tid", "part"]).select("tid", "part", (F.least("s", "b") - F.col("a") + 1).alias("s"), (F.least("e", "b") - F.col("a") + 1).alias("e"))
    return d.select("tid", "part", "s", "e").join(clash, "tid", "left_anti"), frames.join(clash, "tid", "left_anti"), clash


def _new_bases(keys: list[str], s: str, e: str) -> Column:
    """The bases that an interval adds to those of its key before it, in order; intervals that share a single base stay apart,
    so it counts twice. The sum is the length of the merged intervals."""
    top = F.max(e).over(Window.partitionBy(*keys).orderBy(s, e).rowsBetween(Window.unboundedPreceding, -1))
    return F.when(F.col(s) < top, F.greatest(F.lit(0), F.col(e) - top)).otherwise(F.col(e) - F.col(s) + 1)


def chimera_hits(hsp: DataFrame, decided: DataFrame, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """Hits of the parts: (tid, part, target) with bounds and bases aligned on both sides, best bits and evalue, identity and
    positives in percent of the aligned bases.

    hsp: (tid, target, qs, qe, ts, te, evalue, bits, match). A part takes the HSPs that overlap min_overlap of it, of hits
    that reach it. In a match, letters and bars are identical positions and a plus sign is a positive one; these and an
    underscore go one position on, other signs do not. A position counts once, however many HSPs say so.
    """
    keys, of = ["tid", "part", "target"], Window.partitionBy("tid", "target")
    parts = decided.select("tid", "part", "from", "to").distinct()
    d = hsp.withColumns({"_s": F.min("qs").over(of), "_e": F.max("qe").over(of)}).join(parts, "tid").filter((_shared("_s", "_e", "from", "to") > 0) & (_shared("qs", "qe", "from", "to") >= min_overlap * (F.col("to") + 1 - F.col("from"))))
    d = d.withColumn("_q", _new_bases(keys, "qs", "qe")).withColumn("_t", _new_bases(keys, "ts", "te"))
    # a row a position; what is summed up once an HSP stands at its first one
    d = d.select(*keys, "qs", "qe", "ts", "te", "bits", "evalue", "_q", "_t", F.posexplode_outer(F.split(F.regexp_replace("match", "[^A-Za-z|+_]", ""), "")).alias("i", "c"))
    first, known = F.coalesce(F.col("i") == 0, F.lit(True)), F.coalesce(~F.col("c").isin("", "_"), F.lit(False))
    once = {"query_aligned": F.when(first, F.col("_q")), "target_aligned": F.when(first, F.col("_t")), "n_hsps": first.cast("long")}
    whole = lambda qs, qe, ts, te: [F.min(qs).alias("query_start"), F.max(qe).alias("query_end"), F.min(ts).alias("target_start"), F.max(te).alias("target_end"), F.max("bits").alias("bits"), F.min("evalue").alias("evalue")]
    d = d.groupBy(*keys, (F.col("qs") + F.col("i")).alias("at")).agg(F.bool_or(known).alias("_p"), F.bool_or(known & (F.col("c") != "+")).alias("_i"), *whole("qs", "qe", "ts", "te"), *[F.sum(c).alias(k) for k, c in once.items()])
    d = d.groupBy(*keys).agg(*[F.count(F.when(F.col(k), 1)).alias(k) for k in ("_p", "_i")], *whole("query_start", "query_end", "target_start", "target_end"), *[F.sum(k).alias(k) for k in once])
    share = lambda c: F.col(c) * 100 / F.col("query_aligned")
    return d.select(*keys, "bits", "evalue", "n_hsps", "query_start", "query_end", "query_aligned", "target_start", "target_end", "target_aligned", share("_i").alias("identity"), share("_p").alias("positives"))
