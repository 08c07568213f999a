"""Quality classifier: heuristic labellers, their accuracies by expectation-maximisation, a hashed linear scorer."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splicedf.llm import quality_rules
from splicedf.llm.common import filled, pieces, written

#: Frequent words of four languages, fixed values.
COMMON_WORDS = ("the", "of", "and", "to", "in", "is", "that", "with", "de", "la", "le", "les", "et", "des", "un", "une", "que", "el", "los", "del", "con", "para", "der", "die", "das", "und", "von", "den", "mit", "nicht")
#: The scorer is fitted on at most about so many documents, taken by hash of text from all.
TRAIN_ROWS, FEATURES, ROUNDS, SMOOTH = 20_000, 1 << 15, 100, 0.5
KEEP = 0.5


def voted(good: Column, bad: Column) -> Column:
    """1 good, -1 bad, 0 silent; null conditions are silent."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(docs: DataFrame, text_col: str) -> tuple[DataFrame, list[str]]:
    """docs with n_words and a vote of each labeller. Labellers overlap on purpose. One that looks for a fault
    says bad or is silent, one that looks for what speaks for a text says good or is silent; what silence is worth is fitted."""
    d = quality_rules.base_columns(docs, text_col)
    text, n = F.coalesce(F.col(text_col), F.lit("")), F.greatest(F.col("n_words"), F.lit(1))
    known = F.array(*[F.xxhash64(F.lit(w)) for w in COMMON_WORDS])
    d = d.withColumns({
        "_symbols": F.col("n_symbols") / n, "_repeated": F.col("n_repeat_words") / n, "_lines": F.col("n_dup_lines") / (F.size(F.split(text, "\n", -1))),
        "_upper": (F.size(F.split(text, "[A-Z]", -1)) - 1) / F.greatest(F.col("word_chars"), F.lit(1)), "_shouts": (F.size(F.split(text, "[!?]", -1)) - 1) / n,
        "_stops": (F.size(F.split(text, "[.!?]", -1)) - 1) / n, "_mean": F.col("word_chars") / n, "_common": F.size(F.array_intersect("_h", known)),
    })
    named = {
        "v_symbols": voted(F.lit(False), F.col("_symbols") > 0.1),
        "v_repeats": voted(F.lit(False), F.col("_repeated") > 0.2),
        "v_lines": voted(F.lit(False), F.col("_lines") > 0.3),
        "v_upper": voted(F.lit(False), F.col("_upper") > 0.4),
        "v_shouts": voted(F.lit(False), F.col("_shouts") > 0.3),
        "v_word": voted(F.lit(False), (F.col("_mean") < 2) | (F.col("_mean") > 15)),
        "v_empty": voted(F.lit(False), F.col("n_words") < 2),
        "v_plain": voted((F.col("_symbols") < 0.02) & (F.col("_upper") < 0.15) & (F.col("_shouts") < 0.05), F.lit(False)),
        "v_fresh": voted((F.col("_repeated") < 0.1) & (F.col("_lines") < 0.2), F.lit(False)),
        "v_stops": voted(F.col("_stops").between(0.02, 0.5), F.lit(False)),
        "v_common": voted(F.col("_common") >= 3, F.lit(False)),
    }
    return d.select(*docs.columns, "n_words", *[v.alias(k) for k, v in named.items()]), list(named)


def accuracies(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, np.ndarray]:
    """(share of good, log odds of each labeller's votes -1, 0, 1) from the counts of vote patterns.

    The labellers are taken as independent given the class. Each has its own chance of each vote in either class; that,
    and the share of good documents, are fitted by expectation-maximisation. It starts from the belief that any bad vote is rather right: faults come singly.
    """
    v, w = np.array([p for p, _ in patterns]), np.array([c for _, c in patterns], float)
    post = np.where((v < 0).any(1), 0.01, 0.99)
    onehot = np.stack([v == x for x in (-1, 0, 1)], 2).astype(float)
    odds, prior = np.zeros((v.shape[1], 3)), 0.5
    for _ in range(ROUNDS):
        good, bad = (w * post) @ onehot.reshape(len(w), -1) + SMOOTH, (w * (1 - post)) @ onehot.reshape(len(w), -1) + SMOOTH
        good, bad = good.reshape(-1, 3), bad.reshape(-1, 3)
        odds = np.log(good / good.sum(1, keepdims=True)) - np.log(bad / bad.sum(1, keepdims=True))
        prior = min(max(float((w * post).sum() / w.sum()), 1e-6), 1 - 1e-6)
        z = (onehot * odds).sum((1, 2)) + math.log(prior / (1 - prior))
        post = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    return prior, odds


def posterior(names: list[str], prior: float, odds: np.ndarray) -> Column:
    z = F.lit(math.log(prior / (1 - prior)))
    for name, o in zip(names, odds):
        z = z + F.when(F.col(name) < 0, float(o[0])).when(F.col(name) > 0, float(o[2])).otherwise(float(o[1]))
    return 1 / (1 + F.exp(-z))


def classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """One row a document: id_col, n_words, the votes, label (posterior of good), score (of the linear scorer), kept.

    What reaches the driver is the count of each vote pattern, of which there are at most 3 to the power of the
    labellers. Null and empty texts have no words and the votes of an empty text; repeated rows are judged alike. With
    one class only among the sampled labels there is no scorer: the score is then the posterior itself.
    """
    d, names = votes(docs.select(F.col(id_col), F.col(text_col)), text_col)
    table = written(d.select(id_col, F.xxhash64(text_col).alias("_th"), "n_words", *names), "votes")
    counts = table.groupBy(*names).count().collect()
    if not counts:
        return table.select(id_col, "n_words", *names, F.lit(None).cast("double").alias("label"), F.lit(None).cast("double").alias("score"), F.lit(None).cast("boolean").alias("kept"))
    prior, odds = accuracies([(tuple(r[n] for n in names), r["count"]) for r in counts])
    label = posterior(names, prior, odds)
    rows = sum(r["count"] for r in counts)
    every = max(1, math.ceil(rows / TRAIN_ROWS))
    labelled = table.filter(F.pmod("_th", F.lit(every)) == 0).select("_th", label.alias("p")).dropDuplicates(["_th"])
    words = lambda d: d.withColumn("_words", filled(pieces(F.col(text_col))))
    taken = docs.select(F.col(text_col), F.xxhash64(text_col).alias("_th")).filter(F.pmod("_th", F.lit(every)) == 0).dropDuplicates(["_th"])
    sample = written(words(taken.join(labelled, "_th")).select("_words", "p"), "weak-sample").coalesce(4)
    steps = [HashingTF(inputCol="_words", outputCol="_tf", numFeatures=FEATURES), Normalizer(inputCol="_tf", outputCol="_v", p=2.0)]
    for step in steps:
        sample = step.transform(sample)
    sample = sample.withColumns({"y": (F.col("p") >= 0.5).cast("double"), "w": F.abs(2 * F.col("p") - 1)})
    scored = docs.select(F.col(id_col), F.col(text_col))
    if sample.select("y").distinct().count() < 2:
        return table.select(id_col, "n_words", *names, label.alias("label"), label.alias("score"), (label >= keep).alias("kept"))
    model = LogisticRegression(featuresCol="_v", labelCol="y", weightCol="w", probabilityCol="_p", maxIter=30, regParam=1e-4).fit(sample)
    # the second pass over the texts makes words and scores only; a score, as the votes, depends on the text alone
    out = PipelineModel([*steps, model]).transform(words(scored)).select(F.xxhash64(text_col).alias("_t"), F.col(id_col).alias("_i"), vector_to_array("_p")[1].alias("score"))
    out = out.dropDuplicates(["_i", "_t"])
    d = table.join(out, F.col(id_col).eqNullSafe(F.col("_i")) & (F.col("_th") == F.col("_t")), "left")
    return d.select(id_col, "n_words", *names, label.alias("label"), "score", (F.col("score") >= keep).alias("kept"))
