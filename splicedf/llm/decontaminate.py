"""Benchmark decontamination: a broadcast hash set of normalised test windows, scanned along every training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splicedf.llm.common import ascii_lower, filled, maybe_broadcast, renamed, small, written

WINDOW = 10
#: Other than A-Z (lower-cased before), 0-9 and what is not ASCII ends a word.
DELIMITER = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
RAW_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Distinct windows that go into the hash set that every task gets (8 bytes each); more are joined by a shuffle.
SET_ROWS = 100_000
#: Bits of the set beyond that: 8 MB.
BITMAP_BITS = 26


def words(text: Column) -> Column:
    return filled(F.split(ascii_lower(F.coalesce(text, F.lit(""))), DELIMITER, -1))


def window_hash(h: str, i: Column, length: int, *salt: Column) -> Column:
    """Hash of the words i to i + length - 1 (from 0), by their hashes in column h."""
    return F.xxhash64(*salt, *[F.get(F.col(h), i + k) for k in range(length)])


def starts(n: str, length: int) -> Column:
    return F.when(F.col(n) >= length, F.sequence(F.lit(0), F.col(n) - length)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, len, h, h2, w): the distinct windows of each item; an item of fewer words is one window, of none has none."""
    b = benchmark.select("item_id", words(F.col("text")).alias("_words")).withColumns({"_h": F.transform("_words", lambda w: F.xxhash64(w)), "_n": F.size("_words")})
    b = written(b, "bench-words")
    short = sorted(r[0] for r in b.filter(F.col("_n").between(1, window - 1)).select("_n").distinct().collect())
    out = None
    for length in [*short, window]:
        own = b.filter(F.col("_n") == length if length < window else F.col("_n") >= length)
        at = own.withColumn("_i", F.explode_outer(starts("_n", length))).filter("_i IS NOT NULL")
        row = at.select("item_id", F.lit(length).alias("len"), window_hash("_h", F.col("_i"), length).alias("h"), window_hash("_h", F.col("_i"), length, F.lit(1)).alias("h2"), F.concat_ws(" ", F.slice("_words", F.col("_i") + 1, length)).alias("w"))
        out = row if out is None else out.unionAll(row)
    return out.distinct()


def bitmap(keys: DataFrame) -> Column:
    """A bit for each value that the low bits of a window's hash take, as an array of longs: at most 2^BITMAP_BITS bits."""
    h = F.col("h").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    rows = keys.groupBy(F.shiftright(h, 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(h & 63 AS INT))")).alias("bits")).collect()  # 2^(BITMAP_BITS - 6) rows at most
    bits = [0] * (1 << (BITMAP_BITS - 6))
    for r in rows:
        bits[r["i"]] = r["bits"]
    return F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", set_rows: int = SET_ROWS) -> DataFrame:
    """One row a document: _id, _th (hash of its text), n_words, spans (sorted [pos, len] of matched windows), items.

    Windows whose hash is in the set are kept within the row and then compared with the benchmark's word by word. If the
    benchmark has more than set_rows windows, the set is a bitmap of their hashes, of bounded size, and the windows that
    pass it are joined with the benchmark's by two 64-bit hashes. What may be broadcast holds a window once, not its
    items; those are joined to the few documents that have it. Null and empty texts have no words and no hits; benchmark
    items that are null or empty have no windows; repeated rows each get a row. Null item ids count as no item, though
    their windows hit. Other columns of docs and benchmark are left out, whatever their names.
    """
    bench = written(benchmark_windows(benchmark, window), "bench-windows")
    keys = bench.select("len", "h").distinct()
    d, cols = renamed(docs)
    of_id, of_text = F.col(f"c{cols.index(id_col)}"), F.col(f"c{cols.index(text_col)}")
    d = d.select(of_id.alias("_id"), F.xxhash64(of_text).alias("_th"), words(of_text).alias("_words"))
    d = d.withColumns({"_h": F.transform("_words", lambda w: F.xxhash64(w)), "n_words": F.size("_words")})
    in_set = small(keys, set_rows)
    known: dict[int, list[int]] = {}
    if in_set:
        for length, h in keys.collect():
            known.setdefault(length, []).append(h)
    else:
        known = {r[0]: [] for r in keys.select("len").distinct().collect()}
        d = d.withColumn("_bits", bitmap(keys))
    found = []
    for length, hashes in sorted(known.items()):
        at = f"sequence(0, n_words - {length})"
        one = f"xxhash64({', '.join(f'get(_h, i + {k})' for k in range(length))})"
        if in_set:
            test = f"{one} IN ({', '.join(f'{h}L' for h in sorted(hashes))})"
            row = f"struct(i AS pos, {length} AS len, 0L AS h, 0L AS h2, array_join(transform(sequence(0, {length - 1}), k -> get(_words, i + k)), ' ') AS w)"
        else:
            low = f"({one} & {(1 << BITMAP_BITS) - 1}L)"
            test = f"(get(_bits, CAST(shiftright({low}, 6) AS INT)) & shiftleft(1L, CAST({low} & 63 AS INT))) <> 0"
            row = f"struct(i AS pos, {length} AS len, {one} AS h, {one.replace('(', '(1, ', 1)} AS h2, '' AS w)"
        found.append(F.expr(f"CASE WHEN n_words >= {length} THEN transform(filter({at}, i -> {test}), i -> {row}) ELSE array() END"))
    # position -1 stands for the document itself
    none = F.expr("array(struct(-1 AS pos, 0 AS len, 0L AS h, 0L AS h2, '' AS w))")
    # outer: for inner generators the optimizer derives a filter and pushes it, with all that it is made of, to the scan
    d = d.select("_id", "_th", "n_words", F.concat(none, *found).alias("_found")).select("_id", "_th", "n_words", F.inline_outer("_found"))
    join_on = ["len", "w"] if in_set else ["len", "h", "h2"]
    # without items: a row a window, and there are at most set_rows of them where this is broadcast, but for equal hashes
    of_window = bench.select(*join_on, F.xxhash64(*join_on).alias("_win")).distinct()
    d = d.join(maybe_broadcast(of_window, 2 * set_rows) if in_set else of_window, join_on, "left")
    d = d.groupBy("_id", "_th", "n_words").agg(
        F.count_if(F.col("pos") < 0).alias("_rows"),
        F.array_sort(F.collect_set(F.when((F.col("pos") >= 0) & F.col("_win").isNotNull(), F.struct("pos", "len")))).alias("spans"),
        F.collect_set(F.when(F.col("pos") >= 0, F.col("_win"))).alias("_wins"),
    )
    d = written(d, "document-hits")
    some = d.filter(F.size("_wins") > 0).select("_id", "_th", F.explode_outer("_wins").alias("_win")).filter("_win IS NOT NULL")
    ids = bench.filter("item_id IS NOT NULL").select(F.xxhash64(*join_on).alias("_win"), "item_id").distinct()
    items = some.join(ids, "_win").select("_id", "_th", "item_id").distinct().groupBy(F.col("_id").alias("_i"), F.col("_th").alias("_t")).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    d = d.join(items, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_th") == F.col("_t")), "left").withColumn("items", F.coalesce("items", F.array().cast(items.schema["items"].dataType)))
    return d.select("_id", "_th", "n_words", "spans", "items", F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col("_rows"))).alias("_row")).drop("_row")


def covered(spans: Column) -> Column:
    """Number of words inside any of the sorted spans."""
    zero = F.struct(F.lit(0).alias("e"), F.lit(0).alias("t"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(F.greatest(a.e, s.pos + s.len).alias("e"), (a.t + F.greatest(F.lit(0), s.pos + s.len - F.greatest(s.pos, a.e))).alias("t")), lambda a: a.t).cast("long")


def report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    d = hits(docs, benchmark, **how)
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return d.select(F.col("_id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without what the benchmark holds: without the documents that have a hit, or without the words of the hits.

    Columns pass through, whatever their names. Only the keys of documents with hits are joined back; they are broadcast
    if checked to be few.
    """
    bad = hits(docs, benchmark, id_col=id_col, text_col=text_col, **how).filter(F.size("spans") > 0).select("_id", "_th", "spans").dropDuplicates(["_id", "_th"])
    bad = maybe_broadcast(written(bad, "contaminated"))
    d, cols = renamed(docs)
    text = F.col(f"c{cols.index(text_col)}")
    same = F.col(f"c{cols.index(id_col)}").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_th"))
    if remove == "documents":
        return d.join(bad.drop("spans"), same, "left_anti").toDF(*cols)
    seps, raw = F.split(text, RAW_WORD, -1), F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0))
    d = d.join(bad, same, "left").withColumns({"_seps": F.when(F.col("spans").isNotNull(), seps), "_raw": F.when(F.col("spans").isNotNull(), raw)})
    hit = lambda i: F.exists("spans", lambda s: (i >= s.pos) & (i < s.pos + s.len))
    cut = F.concat(F.get("_seps", F.lit(0)), F.array_join(F.transform("_raw", lambda w, i: F.concat(F.when(hit(i), F.lit("")).otherwise(w), F.get("_seps", i + 1))), ""))
    left = F.when(F.col("spans").isNotNull(), cut).otherwise(text)
    return d.select(*[(left if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(cols)])
