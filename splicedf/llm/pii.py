"""Personal data: base patterns, and candidates that boosted trees accept above thresholds calibrated on all candidates."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splicedf.llm import pii_spans
from splicedf.llm.common import written

#: Candidates of each kind and label that the trees are fitted on, at most about so many, by hash of place.
TRAIN_ROWS = 3_000
TREES, DEPTH, SEED = 20, 4, 7
#: A kind's threshold is the lowest of BINS scores from which this share of its candidates outside the sample is right;
#: kinds with fewer than MIN_HELD right ones there have FALLBACK.
PRECISION, BINS, MIN_HELD, FALLBACK = 0.98, 200, 5, 0.95
SPAN = "array<struct<kind: string, start: bigint, end: bigint>>"
CANDIDATE = "array<struct<kind: string, start: bigint, end: bigint, label: double, base: boolean, features: array<double>>>"


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_th"), F.col(text_col).alias("text"))
    return written(d.mapInArrow(pii_spans.rows, f"_id long, _th long, base {SPAN}, candidates {CANDIDATE}"), "pii")


def fitted(cands: DataFrame) -> GBTClassificationModel | None:
    """The trees, from a bounded sample of candidates by kind and label; None if one of the labels has no candidate."""
    counts = cands.groupBy("kind", "label").count().collect()  # two rows a kind at most
    if {r["label"] for r in counts} != {0.0, 1.0}:
        return None
    own = F.coalesce(*[F.when((F.col("kind") == r["kind"]) & (F.col("label") == r["label"]), F.lit(max(1, -(-r["count"] // TRAIN_ROWS)))) for r in counts])
    # one small partition, in a fixed order: the same rows give the same trees
    sample = written(cands.withColumn("every", own).filter("pmod(place, every) = 0").orderBy("_id", "_th", "start", "kind").coalesce(1), "pii-sample")
    return GBTClassifier(featuresCol="v", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(sample.withColumn("v", array_to_vector("features")))


def thresholds(cands: DataFrame) -> dict[str, float]:
    """The threshold of each kind, from the counts of right and wrong candidates by score, over all that are not in the sample."""
    sizes = {(r["kind"], r["label"]): r["count"] for r in cands.groupBy("kind", "label").count().collect()}
    own = F.coalesce(*[F.when((F.col("kind") == k) & (F.col("label") == x), F.lit(max(1, -(-n // TRAIN_ROWS)))) for (k, x), n in sizes.items()])
    held = cands.withColumn("every", own).filter("pmod(place, every) <> 0 OR every = 1")  # a kind that is in the sample whole is judged by it
    bins = held.groupBy("kind", F.floor(F.col("score") * BINS).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("right")).collect()  # BINS + 1 rows a kind at most
    limits = {}
    for kind in pii_spans.KINDS:
        n = right = 0.0
        limits[kind] = 2.0
        for r in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, right = n + r["n"], right + r["right"]
            if right >= MIN_HELD and right / n >= PRECISION:
                limits[kind] = r["bin"] / BINS
        if right < MIN_HELD:
            limits[kind] = FALLBACK
    return limits


def scored(cands: DataFrame, model: GBTClassificationModel) -> DataFrame:
    d = model.transform(cands.withColumn("v", array_to_vector("features")))
    return d.withColumn("score", vector_to_array("probability")[1]).drop("v", "rawPrediction", "probability", "prediction")


def joined(spans: Column) -> Column:
    """kind:start:end, by kind as listed and start, comma-joined."""
    rank = F.create_map(*[F.lit(x) for p in ((k, i) for i, k in enumerate(pii_spans.ORDER)) for x in p])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(rank[s.kind].alias("k"), s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: _id, _th, base spans and added spans.

    Base spans always stay. A candidate adds one if its score reaches its kind's threshold and no base span touches it;
    of added ones that overlap, the higher score stays (then the longer, then the first). Null text counts as empty, very
    long ones are read whole; repeated rows each get a row; without candidates of either label nothing is added. Other
    columns of docs are left out, whatever their names.
    """
    table = scanned(docs, id_col, text_col)
    cands = table.select("_id", "_th", F.inline_outer("candidates")).filter("kind IS NOT NULL").dropDuplicates(["_id", "_th", "kind", "start"])
    cands = written(cands.withColumn("place", F.xxhash64("_id", "_th", "start", "kind")), "pii-candidates")
    model = fitted(cands)
    if model is None:
        return table.select("_id", "_th", "base", F.array().cast(SPAN).alias("added"))
    cands = written(scored(cands, model).drop("features"), "pii-scores")
    least = F.coalesce(*[F.when(F.col("kind") == k, F.lit(x)) for k, x in thresholds(cands).items()])
    good = cands.filter(~F.col("base") & (F.col("score") >= least))
    own = good.groupBy("_id", "_th").agg(F.collect_list(F.struct("score", (F.col("end") - F.col("start")).alias("n"), (-F.col("start")).alias("first"), "kind", "start", "end")).alias("a"))
    beats = lambda x, y: (y.start < x.end) & (y.end > x.start) & (F.struct(y.score, y.n, y["first"], y.kind) > F.struct(x.score, x.n, x["first"], x.kind))
    own = own.select(F.col("_id").alias("_i"), F.col("_th").alias("_t"), F.transform(F.filter("a", lambda x: ~F.exists("a", lambda y: beats(x, y))), lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"))).alias("added"))
    return table.join(own, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_th") == F.col("_t")), "left").select("_id", "_th", "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"))


def report(docs: DataFrame, **how) -> DataFrame:
    d = personal_data(docs, **how)
    count = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return d.select(F.col("_id").alias("doc_id"), *[count(k) for k in pii_spans.BASE], F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"), (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
