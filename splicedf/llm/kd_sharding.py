"""K-d tree sharding: nodes are cut at distributed weighted medians along their widest metadata dimension."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from splicedf.llm.common import BROADCAST_ROWS, Scratch, maybe_broadcast, renamed

#: Copies of a text that weigh more than a leaf are cut into points of this part of one.
HEAVY_PARTS = 16
#: Keys have 60 bits: 20 of the dimension, 40 that order ties, heavier texts first; a pass of the histogram reads 20, of
#: which 10 are summed up first.
KEY_BITS, STEP_BITS, COARSE_BITS, TIE_BITS, WEIGHT_BITS = 60, 20, 10, 40, 5
#: Rows of a window that numbers slots.
SLOT_ROWS = 200_000


def place(c: Column, numeric: bool) -> Column:
    """A metadata value as a position of 20 bits; numbers by their logarithm, names by hash; null is 0."""
    at = F.floor(F.log2(F.greatest(c.cast("double"), F.lit(0.0)) + 1) * (1 << 14)) if numeric else F.shiftrightunsigned(F.xxhash64(c), 44)
    return F.coalesce(F.least(at.cast("long"), F.lit((1 << 20) - 2)) + 1, F.lit(0))


def points_of(docs: DataFrame, leaf_bytes: float, dims: list[str]) -> tuple[DataFrame, DataFrame]:
    """(docs with chunk, points). The copies of a text are one point, unless they weigh more than a leaf.

    No more groups than leaves are heavier than a leaf; the list is broadcast if it is checked to be small.
    """
    groups = docs.groupBy("_text").agg(F.sum("_size").alias("_bytes"))
    heavy = groups.filter(F.col("_bytes") > leaf_bytes).select("_text", F.ceil(F.col("_bytes") * HEAVY_PARTS / leaf_bytes).cast("long").alias("_chunks"))
    docs = docs.join(maybe_broadcast(heavy), "_text", "left").withColumn("_chunk", F.coalesce(F.pmod(F.xxhash64("_id", "_text"), F.col("_chunks")), F.lit(0).cast("long"))).drop("_chunks")
    points = docs.groupBy("_text", "_chunk").agg(F.sum("_size").alias("_w"), *[F.min(d).alias(d) for d in dims])
    light = F.least(F.greatest(F.floor(F.log2(F.lit(float(leaf_bytes)) / F.col("_w")) * 2), F.lit(0)), F.lit((1 << WEIGHT_BITS) - 1)).cast("long")
    tie = F.shiftleft(light, TIE_BITS - WEIGHT_BITS) + F.shiftrightunsigned(F.xxhash64("_text", "_chunk"), 64 - TIE_BITS + WEIGHT_BITS)
    return docs, points.select("_text", "_chunk", "_w", *[(F.shiftleft(F.col(d), TIE_BITS) + tie).alias(d) for d in dims])


def crossing(bins: DataFrame, nodes: DataFrame, bin_col: str, few: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(_leaf, bin, upto, w): the first bin of each node up to which its points weigh what is wanted, or else its last.

    A node has at most 2 to the power of COARSE_BITS bins here.
    """
    by = Window.partitionBy("_leaf").orderBy(bin_col)
    b = bins.join(few(nodes.select("_leaf", "want", "below")), "_leaf")
    b = b.withColumns({"upto": F.col("below") + F.sum("w").over(by), "last": F.lead(bin_col).over(by).isNull()})
    at = b.filter((F.col("upto") >= F.col("want")) | F.col("last")).groupBy("_leaf").agg(F.min(F.struct(F.col(bin_col).alias("bin"), "upto", "w")).alias("x"))
    return at.select("_leaf", "x.bin", "x.upto", "x.w")


def median_cuts(state: DataFrame, dims: list[str], work: Scratch, few: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(_leaf, _dim, _cut, _half) of every node of several shards: where it is cut, along its widest dimension.

    A pass groups by (node, 20 bits of the key) and closes in on the weighted median of every node at once. Nodes are a
    table, of no more rows than there are shards.
    """
    open_ = state.filter("_n > 1")
    spread = lambda d: F.max(F.shiftright(d, TIE_BITS)) - F.min(F.shiftright(d, TIE_BITS))
    widest = F.array_max(F.array(*[F.struct(F.col(f"_s{i}").alias("s"), F.lit(-i).alias("i")) for i in range(len(dims))]))
    nodes = open_.groupBy("_leaf", "_n").agg(F.sum("_w").alias("all"), *[spread(d).alias(f"_s{i}") for i, d in enumerate(dims)])
    half = F.floor(F.col("_n") / 2).cast("long")
    nodes = work.written(nodes.select("_leaf", half.alias("_half"), (-widest.i).alias("_dim"), (F.col("all") * half / F.col("_n")).alias("want"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("upto")), "kd-nodes")
    for bits in range(STEP_BITS, KEY_BITS + 1, STEP_BITS):
        key = F.element_at(F.array(*dims), F.col("_dim") + 1)
        seen = open_.join(few(nodes.select("_leaf", "_dim", "prefix")), "_leaf").withColumn("_key", key).filter(F.shiftright("_key", KEY_BITS - bits + STEP_BITS) == F.col("prefix"))
        hist = work.written(seen.groupBy("_leaf", F.shiftright("_key", KEY_BITS - bits).alias("bin")).agg(F.sum("_w").alias("w")), "kd-bins")
        coarse = hist.groupBy("_leaf", F.shiftright("bin", COARSE_BITS).alias("c")).agg(F.sum("w").alias("w"))
        near = crossing(coarse, nodes, "c", few).select("_leaf", F.col("bin").alias("c"), (F.col("upto") - F.col("w")).alias("below"))
        near = nodes.drop("below").join(few(near), "_leaf")
        fine = hist.join(few(near.select("_leaf", "c")), "_leaf").filter(F.shiftright("bin", COARSE_BITS) == F.col("c"))
        at = crossing(fine.select("_leaf", "bin", "w"), near, "bin", few)
        nodes = nodes.drop("prefix", "below", "upto").join(few(at), "_leaf").select("_leaf", "_half", "_dim", "want", F.col("bin").alias("prefix"), (F.col("upto") - F.col("w")).alias("below"), "upto")
        nodes = work.written(nodes, "kd-nodes")
        work.drop("kd-bins")
        work.drop("kd-nodes", keep=1)
    # the point at the median goes to the side that it leaves nearer to its share
    over = F.abs(F.col("upto") - F.col("want")) <= F.abs(F.col("below") - F.col("want"))
    return nodes.select("_leaf", "_dim", F.when(over, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("_cut"), "_half")


def kd_leaves(points: DataFrame, dims: list[str], shards: int, work: Scratch) -> DataFrame:
    """Written: points with _leaf (0 to shards - 1). A node of s shards is cut so that its parts weigh floor(s / 2) : ceil(s / 2).

    The points are written anew at each level, of which there are log2(shards).
    """
    # nodes are at most as many as shards
    few = F.broadcast if shards <= BROADCAST_ROWS else lambda d: d
    state = work.written(points.withColumns({"_leaf": F.lit(0).cast("long"), "_n": F.lit(shards).cast("long")}), "kd-points")
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        cut = median_cuts(state, dims, work, few)
        d = state.join(few(cut), "_leaf", "left")
        right = F.element_at(F.array(*dims), F.col("_dim") + 1) > F.col("_cut")
        leaf = F.when(F.col("_half").isNull() | ~right, F.col("_leaf")).otherwise(F.col("_leaf") + F.col("_half"))
        n = F.when(F.col("_half").isNull(), F.col("_n")).when(right, F.col("_n") - F.col("_half")).otherwise(F.col("_half"))
        state = work.written(d.select("_text", "_chunk", "_w", *dims, leaf.alias("_l"), n.alias("_n")).withColumnRenamed("_l", "_leaf"), "kd-points")
        work.drop("kd-points", keep=1)
        work.drop("kd-nodes")
    return state.select("_text", "_chunk", "_leaf")


def numbered(df: DataFrame, rows: int) -> DataFrame:
    """df with slot: gapless from 0 in each shard.

    Rows are numbered in buckets by hash, of about SLOT_ROWS rows; a bucket starts where the ones before it end. The
    table of starts has a row a bucket (rows / SLOT_ROWS and 32 a shard); it is broadcast if checked to be small.
    """
    buckets = max(32, math.ceil(rows / SLOT_ROWS))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_text"), F.lit(buckets)))
    counts = df.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    at = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_id", "_text")) - 1
    return df.withColumn("_at", at).join(maybe_broadcast(starts), ["shard", "_bucket"]).withColumn("slot", F.col("_start") + F.col("_at"))


def kd_shards(docs: DataFrame, shards: int | None = 16, target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text", numeric: tuple = ("n_chars",), names: tuple = ("source", "lang")) -> DataFrame:
    """One row a document: id_col, size, text_crc32, shard, slot.

    size is the UTF-8 bytes of the text plus 1 (null: 1, crc 0). Leaves are cut until there are `shards` of them, or
    until they reach target_bytes. The law that holds is that of bytes: leaves differ by about a point's weight, which is
    a document's or that of all copies of a text. Copies of a text share a shard, unless they weigh more than a leaf.
    Missing or null metadata is position 0 of its dimension; repeated rows get slots of their own. Other columns of docs
    are left out, whatever their names. An empty table gives no rows.
    """
    work = Scratch(docs.sparkSession)
    d, cols = renamed(docs)
    of = {c: F.col(f"c{i}") for i, c in enumerate(cols)}
    text = F.coalesce(of[text_col], F.lit(""))
    dims = {f"_d{i}": place(of[c], num) for i, (c, num) in enumerate([(c, True) for c in numeric if c in of] + [(c, False) for c in names if c in of])}
    dims["_d9"] = place(F.octet_length(text), True)
    flat = work.written(d.select(of[id_col].alias("_id"), (F.octet_length(text).cast("long") + 1).alias("_size"), F.crc32(text.cast("binary")).alias("_crc"), F.xxhash64(text).alias("_text"), *[v.alias(k) for k, v in dims.items()]), "kd-docs")
    rows, total = flat.agg(F.count(F.lit(1)), F.coalesce(F.sum("_size"), F.lit(0))).first()
    if target_bytes:
        shards = max(1, math.ceil(total / target_bytes))
    flat, points = points_of(flat, max(total, 1) / shards, list(dims))
    leaves = kd_leaves(points, list(dims), shards, work)
    placed = flat.join(leaves, ["_text", "_chunk"]).select("_id", "_text", "_size", "_crc", F.col("_leaf").cast("int").alias("shard"))
    return numbered(placed, rows).select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard", "slot")
