"""Reading frames on the sequences of their models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splicedf.operators.sequence import START, STOPS, ends_with_stop, inner_stop


def first_codon(text: Column, *which: str) -> Column:
    """The number, from 1, of the first codon of text that is one of these; null without one. One pass over the text."""
    n = F.length(F.regexp_extract(text, f"(?s)^(?:...)*?(?:{'|'.join(which)})", 0))
    return F.when(n > 0, (n / 3).cast("long"))


def last_codon(text: Column, *which: str) -> Column:
    """The same of the last one, counted back from the end of text: 1 is its last codon. Text is whole codons."""
    n = F.length(F.regexp_extract(text, f"(?s)^(?:...)*(?:{'|'.join(which)})", 0))
    return F.when(n > 0, ((F.length(text) - n) / 3).cast("long") + 1)


def orf_validate(orf: DataFrame) -> DataFrame:
    """orf (tid, s, e, phase, seq) with reason: bounds (not within the sequence), length (no whole codons, unless the frame runs
    to the end of the sequence), stop (a stop before the last codon), or valid; and has_start, has_stop."""
    n = F.col("e") - F.col("s") + 1 - F.col("phase")
    own = F.substring("seq", F.col("s") + F.col("phase"), F.greatest(n, F.lit(0)))
    d = orf.withColumn("_own", own)
    reason = F.when((F.col("s") < 1) | (F.col("e") > F.length("seq")) | (F.col("s") > F.col("e")), "bounds").when((n % 3 != 0) & (F.col("e") < F.length("seq")), "length").when(inner_stop(F.col("_own")), "stop").otherwise("valid")
    return d.select(*orf.columns, reason.alias("reason"), (F.substring("seq", F.col("s") + F.col("phase"), F.lit(3)) == START).alias("has_start"), ends_with_stop(F.col("_own")).alias("has_stop"))


def orf_start_adjust(orf: DataFrame, max_regression: float = 0.2) -> DataFrame:
    """orf (tid, s, e, seq) with s moved to a start codon where it has none: (tid, was, s, e, phase, stopped).

    Frames that start after the third base go upstream by codons to the first start or stop codon; a stop there makes
    stopped true and is where s stays. Other frames go down, over the first max_regression of their codons, to a start.
    Where neither finds any, the frame is open: s is 1, and phase the bases before its first codon.
    """
    codon = lambda at: F.substring("seq", at, F.lit(3))
    s = F.col("s")
    up = last_codon(F.substring("seq", (s - 1) % 3 + 1, F.greatest(s - 1 - (s - 1) % 3, F.lit(0))), START, *STOPS)
    down = first_codon(F.substring("seq", s + 3, (3 * F.greatest(F.floor(max_regression * F.floor((F.col("e") - s + 1) / 3)), F.lit(0))).cast("int")), START)
    d = orf.withColumns({"_fine": codon(s) == START, "_up": up, "_down": down})
    to = F.when(F.col("_fine"), s).when(s > 3, s - 3 * F.col("_up")).otherwise(s + 3 * F.col("_down"))
    stopped = ~F.col("_fine") & (s > 3) & (F.substring("seq", s - 3 * F.col("_up"), F.lit(3)) != START)
    d = d.withColumns({"_to": to, "stopped": F.coalesce(stopped, F.lit(False))})
    return d.select("tid", s.alias("was"), F.coalesce("_to", F.lit(1)).cast("long").alias("s"), "e", F.when(F.col("_to").isNull(), (s - 1) % 3).otherwise(0).cast("int").alias("phase"), "stopped")


def orf_check(coding: DataFrame, may_strip: Column) -> DataFrame:
    """(tid, verdict) of coding sequences (tid, seq) from their first whole codon on: keep, or, for a stop within or a length
    that is no whole number of codons, strip where that is allowed, else reject."""
    bad = (F.length("seq") % 3 != 0) | inner_stop(F.col("seq"))
    return coding.select("tid", F.when(~bad, "keep").when(may_strip, "strip").otherwise("reject").alias("verdict"))
