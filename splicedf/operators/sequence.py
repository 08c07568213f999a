"""Sequences: spliced texts, splice signals, codons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Splice signals that count as canonical, donor then acceptor.
CANONICAL = (("GT", "AG"), ("GC", "AG"), ("AT", "AC"))
#: The standard genetic code by codon in the order T, C, A, G of each base; * is a stop.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: The codons in that order; start and stops.
CODONS = tuple(a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG")
START, STOPS = "ATG", ("TAA", "TAG", "TGA")


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def translated(seq: Column) -> Column:
    """The protein of a coding sequence, codon by codon; an incomplete last codon goes, an unknown one is X."""
    known = F.create_map(*[F.lit(x) for pair in zip(CODONS, STANDARD, strict=True) for x in pair])
    return F.coalesce(F.array_join(F.transform(codons(seq), lambda c: F.coalesce(F.try_element_at(known, c), F.lit("X"))), ""), F.lit(""))


def codons(seq: Column) -> Column:
    """The text in upper case in pieces of three letters, cut in one pass; what is left over goes."""
    return F.regexp_extract_all(F.upper(seq), F.lit("(?s).{3}"), F.lit(0))


def inner_stop(seq: Column) -> Column:
    """Whether a whole codon before the last whole one is a stop, in one pass over the text."""
    return F.coalesce(seq.rlike(f"(?is)^(?:...)*?(?:{'|'.join(STOPS)})..."), F.lit(False))


def ends_with_stop(seq: Column) -> Column:
    """Whether the last whole codon is a stop."""
    n = F.length(seq)
    return F.coalesce((n >= 3) & F.upper(F.substring(seq, n - n % 3 - 2, F.lit(3))).isin(*STOPS), F.lit(False))


def cdna_sequence(pieces: DataFrame, *keys: str) -> DataFrame:
    """(tid, keys, seq) from pieces of exons with their text along the strand (tid, strand, s, dna): joined in order of place, against
    it on the minus strand."""
    at = F.when(F.col("strand") == "-", -F.col("s")).otherwise(F.col("s")).alias("at")
    own = F.array_sort(F.collect_list(F.struct(at, "dna")))
    return pieces.groupBy("tid", *keys).agg(F.array_join(own["dna"], "").alias("seq"))


def splice_canonical(introns: DataFrame) -> DataFrame:
    """Introns (with left and right, their outer two bases) with hint: the strand on which they are canonical, or null."""
    left, right = F.upper("left"), F.upper("right")
    on = lambda a, b: F.greatest(*[((a == x) & (b == y)).cast("int") for x, y in CANONICAL]) == 1
    return introns.withColumn("hint", F.when(on(left, right), "+").when(on(reverse_complement(right), reverse_complement(left)), "-"))


def strand_check(hinted: DataFrame) -> DataFrame:
    """(tid, plus, minus, neither, verdict): keep, reverse or reject a model by the strands of its introns."""
    n = lambda c: F.count(F.when(c, 1))
    d = hinted.groupBy("tid", "strand").agg(n(F.col("hint") == "+").alias("plus"), n(F.col("hint") == "-").alias("minus"), n(F.col("hint").isNull()).alias("neither"))
    own, other = F.when(F.col("strand") == "+", F.col("plus")).otherwise(F.col("minus")), F.when(F.col("strand") == "+", F.col("minus")).otherwise(F.col("plus"))
    verdict = F.when((own > 0) & (other > 0), "mixed").when(own > 0, "keep").when(other > 0, "reverse").otherwise("none")
    return d.withColumn("verdict", verdict)
