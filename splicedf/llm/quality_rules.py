"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio between trusted documents and the whole corpus."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splicedf.llm.common import filled, pieces, renamed, small, written

#: Buckets of the two multinomials; PRIOR is added to a bucket's trusted count and to the count that its share of all
#: n-grams lets expect, so a bucket without evidence weighs 0; weights are integers of 1 / SCALE.
BUCKETS, PRIOR, SCALE = 1 << 16, 4.0, 1 << 16
#: A document is kept if its mean log ratio per n-gram is at least this.
THRESHOLD = -0.17
MIN_WORDS, WINDOW, MAX_REPEATED = 10, 5, 20
#: Ids of trusted documents that may be broadcast (8 bytes each).
TRUSTED_ROWS = 1_000_000


def gram_hashes(h: str, n: str) -> Column:
    """Hashes of the words and of the pairs of neighbours, from the words' hashes in column h."""
    rest = F.greatest(F.col(n) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(h, 1, rest), F.slice(h, 2, rest), lambda a, b: F.xxhash64(a, b))
    return F.concat(F.col(h), F.when(F.col(n) > 1, pairs).otherwise(F.slice(h, 1, F.lit(0))))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that are labelled good and nowhere bad or toxic."""
    flags = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return flags.filter("q = 1 AND t = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_trusted"))


def gram_counts(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(b, raw, good): the n-grams of all and of trusted documents by bucket; BUCKETS rows at most.

    Every task sums its own n-grams by bucket before the shuffle, so what is moved is at most BUCKETS rows a task, for
    hot words as for rare ones.
    """
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(ids, F.col("_id") == F.col("_trusted"), "left")
    d = d.select(F.col("_trusted").isNotNull().cast("long").alias("_good"), F.transform(filled(pieces(F.col("_t"))), lambda w: F.xxhash64(w)).alias("_h"))
    d = d.withColumn("_n", F.size("_h")).select("_good", gram_hashes("_h", "_n").alias("_g"))
    # outer: for inner generators the optimizer derives a filter and pushes it, with all that it is made of, to the scan
    d = d.select("_good", F.explode_outer("_g").alias("_x")).filter("_x IS NOT NULL").groupBy(F.pmod("_x", F.lit(BUCKETS)).alias("b")).agg(F.count(F.lit(1)).alias("raw"), F.sum("_good").alias("good"))
    return written(d, "gram-counts")


def numbers(values: list[int]) -> Column:
    """An array literal, folded into one value."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def gram_buckets(grams: Column) -> Column:
    """The buckets of n-gram hashes, sorted. As a column of its own, without nulls, Spark sorts it as plain integers."""
    return F.sort_array(F.transform(grams, lambda x: x.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")))


def run_ends(buckets: str) -> Column:
    """The places of the last of each run of equal buckets in a column of sorted ones."""
    last = F.transform(buckets, lambda x, i: F.when(F.get(buckets, i + 1) == x, F.lit(-1)).otherwise(i))
    return F.filter(last, lambda i: i >= 0)


def gram_score(buckets: str, ends: str, is_trusted: Column, counts: DataFrame) -> Column:
    """The sum of the integer weights of the n-grams in a column of sorted buckets, as the other documents set them.

    A document's own n-grams are left out of both multinomials. A run of c equal buckets, which `ends` has the last place
    of, is weighed once, times c.
    """
    raw, good = [0] * BUCKETS, [0] * BUCKETS
    for r in counts.collect():  # BUCKETS rows at most, whatever the input
        raw[r["b"]], good[r["b"]] = r["raw"], r["good"]
    n, t = F.size(buckets), is_trusted.cast("int")
    share = (F.lit(sum(good)) - n * t) / F.greatest(F.lit(sum(raw)) - n, F.lit(1))
    raw, good = numbers(raw), numbers(good)

    def weight(end: Column, k: Column) -> Column:
        b, c = F.get(buckets, end), end - F.coalesce(F.get(ends, k - 1), F.lit(-1))
        trusted = F.get(good, b) - c * t + F.lit(PRIOR)
        expected = share * (F.get(raw, b) - c) + F.lit(PRIOR)
        return c * F.rint(F.log(trusted / expected) * SCALE).cast("long")

    return F.aggregate(F.transform(ends, weight), F.lit(0).cast("long"), lambda s, x: s + x)


def base_columns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the words' hashes _h."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = docs.withColumns({"_p": pieces(F.col(text_col)), "_lines": lines, "n_symbols": (F.size(F.split(text, "[#*$%&|<>]", -1)) - 1).cast("long"), "_chars": F.char_length(text)})
    d = d.withColumns({"_h": F.transform(filled(F.col("_p")), lambda w: F.xxhash64(w)), "word_chars": (F.col("_chars") - F.size("_p") + 1).cast("long"), "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")}).drop("_p", "_lines", "_chars")
    d = d.withColumn("n_words", F.size("_h").cast("long"))
    last = F.col("n_words").cast("int") - WINDOW
    window = lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)])
    d = d.withColumn("_w", F.when(last >= 1, F.transform(F.sequence(F.lit(0), last), window)))
    # only texts with a window that returns are sorted
    twice = F.size(F.array_distinct("_w")) < F.size("_w")
    d = d.withColumn("_s", F.when(twice, F.array_sort(F.transform("_w", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("_w")
    is_twice = lambda s, i: (F.get("_s", i - 1).x == s.x) | (F.get("_s", i + 1).x == s.x)
    at = F.array_sort(F.transform(F.filter("_s", lambda s, i: F.coalesce(is_twice(s, i), F.lit(False))), lambda s: s.i))
    zero = F.struct(F.lit(0).alias("e"), F.lit(0).alias("t"))
    cover = F.aggregate(at, zero, lambda a, p: F.struct((p + WINDOW).alias("e"), (a.t + p + WINDOW - F.greatest(p, a.e)).alias("t")), lambda a: a.t)
    d = d.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0)).cast("long")).drop("_s")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with the base columns, gram_score (sum of integer weights), mean_log_ratio and kept.

    The sum is of integers, so no order of rows changes it. A null or empty text has no words, fails the base and is not
    kept; labels with nulls do not count as trusted; without any trusted document all weights are 0.
    Repeated rows are judged alike; columns of other names pass through, and those of the names above are replaced.
    """
    trusted = trusted_ids(labels)
    ids = F.broadcast(trusted) if small(trusted, TRUSTED_ROWS) else trusted
    counts = gram_counts(docs, ids, id_col, text_col)
    d = base_columns(docs.join(ids, F.col(id_col) == F.col("_trusted"), "left"), text_col)
    d = d.withColumn("_b", gram_buckets(gram_hashes("_h", "n_words"))).withColumn("_e", run_ends("_b"))
    d = d.withColumns({"gram_score": gram_score("_b", "_e", F.col("_trusted").isNotNull(), counts), "_n": F.size("_b")}).drop("_b", "_e", "_h", "_trusted")
    limit = math.floor(threshold * SCALE)
    # the row number, always true, keeps a filter on the verdict from being pushed into the lambdas below
    d = d.withColumns({"mean_log_ratio": F.when(F.col("_n") > 0, F.col("gram_score") / F.col("_n") / SCALE), "kept": ~F.col("base_failed") & (F.col("gram_score") >= F.col("_n") * limit) & (F.monotonically_increasing_id() >= 0)})
    return d.drop("_n")


def kept_only(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that are kept, with their own columns and values, whatever their names."""
    d, cols = renamed(docs)
    kept = judged(d, labels, f"c{cols.index(id_col)}", f"c{cols.index(text_col)}", **how).filter("kept")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])
