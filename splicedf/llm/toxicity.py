"""Toxicity: sentences are the instances of a document; their scores, joined by noisy-or, are learnt from document labels.

A document is toxic unless each of its sentences is harmless: P = 1 - product of (1 - p). What a sentence scores is learnt
only through that product, so the gradient of a toxic document goes to the sentences that are likeliest to have made it
toxic, and all sentences of a harmless one are pushed down. The same sentence scores locate the offending sentences.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.llm.common import maybe_broadcast, written

#: At most about so many labelled texts of either label are fitted on, by hash of text; weights make up for the share.
TRAIN_ROWS = 6_000
#: Texts a task fits on; the weights of all tasks are averaged after each of ROUNDS, each of STEPS full passes. One text
#: of FOLDS is not fitted on: the scores of those calibrate what the noisy-or says of texts that it has not seen.
PART_ROWS, ROUNDS, STEPS, FOLDS = 5_000, 2, 20, 5
FEATURES, RATE, MOMENTUM, DECAY, BIAS = 1 << 18, 2.0, 0.9, 0.1, -5.0
#: How many documents' worth of belief the calibration starts with that scores are right as they are.
BELIEF = 5.0
#: Features of a run of letters: itself and its beginnings of these lengths. A run of over 64 letters counts as several.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
TOXIC, OFFENDING = 0.3, 0.5
CACHE = 400_000
SENTENCE, LETTERS = re.compile(r"[^.!?\n]+[.!?]*"), re.compile(r"[^\W\d_]{1,64}")


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, distinct lower-case words between white space) of the sentences that have any."""
    out = []
    for m in SENTENCE.finditer(text):
        if words := list(dict.fromkeys(m[0].lower().split())):
            out.append((m.start(), m.end(), words))
    return out


def features(word: str) -> list[int]:
    """Hashed features of a word: of its runs of letters. Other words with the same beginning share some."""
    parts = (f for run in LETTERS.findall(word) for f in (f"{run} ", *(run[:n] for n in BEGINNINGS if n <= len(run))))
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % FEATURES for f in parts]


def softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


class Bags:
    """Documents as bags of sentences of words, in flat arrays."""

    def __init__(self, texts, toxic, weight):
        ids, features_of, starts, self.words, per_sentence, per_doc, y, w = {}, [], [0], [], [], [], [], []
        for text, t, c in zip(texts, toxic, weight):
            found = sentences(text)
            if not found:
                continue
            for _, _, words in found:
                for word in words:
                    if word not in ids:
                        ids[word] = len(ids)
                        features_of += features(word)
                        starts.append(len(features_of))
                    self.words.append(ids[word])
                per_sentence.append(len(words))
            per_doc.append(len(found))
            y.append(t)
            w.append(c)
        self.words, self.features = np.array(self.words, np.int64), np.array(features_of, np.int64)
        self.of_word = np.repeat(np.arange(len(ids)), np.diff(starts))
        self.of_sentence, self.of_doc = np.repeat(np.arange(len(per_sentence)), per_sentence), np.repeat(np.arange(len(per_doc)), per_doc)
        self.y, self.w = np.array(y, float), np.array(w, float)
        pairs = np.unique(self.of_doc[self.of_sentence] * max(len(ids), 1) + self.words) % max(len(ids), 1)
        self.mentions = np.bincount(self.features, np.bincount(pairs, minlength=len(ids))[self.of_word], FEATURES)

    def gradient(self, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float, float]:
        """Of the mean log loss of the noisy-or, by feature and for the bias, and the loss itself."""
        word = np.bincount(self.of_word, weights[self.features], len(np.unique(self.of_word)))
        z = bias + np.bincount(self.of_sentence, word[self.words])
        p, total = 1 / (1 + np.exp(-np.clip(z, -50, 50))), np.bincount(self.of_doc, softplus(z))
        any_ = np.maximum(-np.expm1(-total), 1e-12)
        # d loss / d z: p for a harmless document, -p (1 - P) / P for a toxic one
        pull = np.where(self.y > 0.5, -np.exp(-total) / any_, 1.0) * self.w / self.w.sum()
        g = p * pull[self.of_doc]
        by_word = np.bincount(self.words, g[self.of_sentence], len(word))
        loss = float((np.where(self.y > 0.5, -np.log(any_), total) * self.w).sum() / self.w.sum())
        return np.bincount(self.features, by_word[self.of_word], FEATURES), float(g.sum()), loss


def fitted(bags: Bags, weights: np.ndarray, bias: float, steps: int) -> tuple[np.ndarray, float]:
    """Descent with momentum over all documents of the task at each step; no random numbers.

    A feature's step is divided by the root of the share of documents that mention it: what many toxic documents have in
    common grows far faster than the words that one of them has for itself.
    """
    n = len(bags.y)
    rare = np.append(np.sqrt(n / np.maximum(bags.mentions, 1)), 1.0)
    weights, m = weights.copy(), np.zeros(FEATURES + 1)
    for _ in range(steps):
        g, gb, _ = bags.gradient(weights, bias)
        m = MOMENTUM * m + np.append(g + DECAY / n * weights, gb)
        weights, bias = weights - RATE * rare[:-1] * m[:-1], bias - RATE * float(m[-1])
    return weights, bias


class WordScores(dict):
    """Scores of words, worked out when first asked for; the memory for that is bounded."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        s = math.fsum(self.weights[f] for f in features(word))
        if len(self) >= CACHE:
            self.clear()
        if len(word) <= 64:
            self[word] = s
        return s


class Scorer:
    """Scores of sentences and documents under given weights; slope and offset calibrate the log odds of documents."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, offset: float = 0.0):
        self.bias, self.slope, self.offset, self.known = bias, slope, offset, WordScores(weights)

    def text(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """(score of the text, sentences with their scores). Without sentences a text scores 0."""
        found, total, word = [], 0.0, self.known.__getitem__
        for start, end, words in sentences(text):
            z = self.bias + sum(map(word, words))
            total += max(z, 0.0) + math.log1p(math.exp(-abs(z)))
            found.append((start, end, sigmoid(z)))
        return (sigmoid(self.slope * log_odds(total) + self.offset) if found else 0.0), found


def sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(min(z, 50.0), -50.0)))


def log_odds(total: float) -> float:
    """Of 1 - exp(-total), the noisy-or of sentences with that sum of softplus."""
    return min(max(total + math.log(max(-math.expm1(-total), 1e-300)), -50.0), 50.0)


def calibration(odds: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0.05) and offset of a logistic curve through the log odds, by Newton's steps, drawn to (1, 0)."""
    x, at, w = np.stack([odds, np.ones(len(odds))], 1), np.array([1.0, 0.0]), w / w.min()

    def loss(a):
        z = x @ a
        return float((w * (softplus(z) - y * z)).sum()) + BELIEF / 2 * ((a[0] - 1) ** 2 + a[1] ** 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
        g, h = x.T @ (w * (p - y)) + BELIEF * (at - [1.0, 0.0]), (x * (w * p * (1 - p))[:, None]).T @ x + BELIEF * np.eye(2)
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return max(float(at[0]), 0.05), float(at[1])


def held_out(doc_id) -> F.Column:
    """Whether a row's label is never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(part, th, text, toxic, weight): distinct labelled texts that are not held out, toxic if any label says so. Part -1 calibrates."""
    y = labels.select(F.col(id_col).alias("_y"), F.col(label_col).cast("int").alias("toxic")).filter(F.col("_y").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("_y")))
    y = y.groupBy("_y").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    narrow = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).isNotNull().alias("there")).filter("there AND _id IS NOT NULL")
    texts = narrow.join(maybe_broadcast(y), F.col("_id") == F.col("_y")).groupBy("th").agg(F.max("toxic").alias("toxic"), F.min("_id").alias("_first"))
    texts = written(texts, "labelled")
    counts = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    every = F.when(F.col("toxic") == 1, F.lit(-(-counts.get(1, 1) // TRAIN_ROWS))).otherwise(F.lit(-(-counts.get(0, 1) // TRAIN_ROWS)))
    parts = -(-sum(min(c, TRAIN_ROWS) for c in counts.values()) // PART_ROWS) or 1
    chosen = texts.withColumn("every", every).filter("pmod(th, every) = 0").select("th", "_first", "toxic", F.col("every").cast("double").alias("weight"))
    text = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"), F.col(text_col).alias("text"))
    found = text.join(maybe_broadcast(chosen), (F.col("_id") == F.col("_first")) & (F.col("_th") == F.col("th"))).dropDuplicates(["th"])
    return written(found.select(F.when(F.pmod(F.shiftright("th", 32), F.lit(FOLDS)) == 0, -1).otherwise(F.pmod(F.xxhash64("th"), F.lit(parts))).cast("int").alias("part"), "th", "text", "toxic", "weight"), "toxic-sample")


def trained(sample: DataFrame, rounds: int = ROUNDS, steps: int = STEPS) -> tuple[np.ndarray, float, float, float]:
    """Weights, bias, slope and offset: each part fits on its own texts from the common start, and the parts' results are averaged."""
    spark, weights, bias = sample.sparkSession, np.zeros(FEATURES), BIAS
    for _ in range(rounds):
        start = spark.sparkContext.broadcast((weights, bias))  # FEATURES numbers, whatever the input

        def fit(rows):
            import pandas as pd

            rows = rows.sort_values("th")
            bags = Bags(rows["text"], rows["toxic"], rows["weight"])
            if not len(bags.y):
                return pd.DataFrame({"part": [], "docs": [], "weights": [], "bias": []})
            w, b = fitted(bags, *start.value, steps)  # noqa: B023  the job ends within this round
            return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "docs": [bags.w.sum()], "weights": [w], "bias": [b]})

        found = sorted(sample.filter("part >= 0").groupBy("part").applyInPandas(fit, "part int, docs double, weights array<double>, bias double").collect(), key=lambda r: r["part"])
        start.unpersist()
        if not found:
            break
        share = np.array([r["docs"] for r in found]) / sum(r["docs"] for r in found)
        weights = sum(s * np.array(r["weights"]) for s, r in zip(share, found))
        bias = float(sum(s * r["bias"] for s, r in zip(share, found)))
    end = spark.sparkContext.broadcast((weights, bias))

    def odds(batches):
        import pyarrow as pa

        scorer = Scorer(*end.value)
        for batch in batches:
            found = [scorer.text(t.as_py() or "") for t in batch.column(1)]
            x = [log_odds(sum(-math.log1p(-min(p, 1 - 1e-15)) for *_, p in of)) for _, of in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64()), pa.array([bool(of) for _, of in found]), batch.column(2), batch.column(3)], ["th", "odds", "there", "toxic", "weight"])

    # two labels of TRAIN_ROWS texts, divided by FOLDS, at most about so many rows
    held = sorted(sample.filter("part < 0").select("th", "text", "toxic", "weight").mapInArrow(odds, "th long, odds double, there boolean, toxic int, weight double").filter("there").collect())
    slope, offset = calibration(np.array([r["odds"] for r in held]), np.array([float(r["toxic"]) for r in held]), np.array([r["weight"] for r in held])) if held else (1.0, 0.0)
    return weights, bias, slope, offset


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", offending: float = OFFENDING) -> DataFrame:
    """One row a document: _id, score, n_sentences and the offending sentences (start, end, score).

    The score depends on the text alone. A null or empty text, or one without words, has no sentences and scores 0. Very
    long texts are read whole, sentence by sentence. Repeated rows each have a row; rows without an id are scored and not
    learnt from. Labels that are null do not count; of several for one id, or for equal texts, toxic wins. Where the labels
    are of one kind only, or none are there, nothing is learnt: texts with words score 1 if all labels say toxic, else 0.
    Other columns of docs are left out, whatever their names.
    """
    sample = sampled(docs, labels, id_col, text_col, label_col)
    kinds = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    model = docs.sparkSession.sparkContext.broadcast(trained(sample) if kinds == {0, 1} else (np.zeros(FEATURES), 50.0 if kinds == {1} else -50.0))
    span = "start int, end int, score double"

    def score(batches):
        import pyarrow as pa

        scorer, struct = Scorer(*model.value), pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        for batch in batches:
            found = [scorer.text(t.as_py() or "") for t in batch.column(1)]
            spans = [[{"start": s, "end": e, "score": p} for s, e, p in of if p >= offending] for _, of in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array([len(of) for _, of in found], pa.int64()), pa.array(spans, pa.list_(struct))], ["_id", "score", "n_sentences", "offending"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, f"_id {rows.schema['_id'].dataType.simpleString()}, score double, n_sentences long, offending array<struct<{span.replace(' int', ': int').replace(' double', ': double')}>>")


def report(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """scored() with held_out, predicted and the offending sentences as start:end, in code points, end exclusive."""
    d = scored(docs, labels, **how)
    spans = F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return d.select("_id", held_out(F.col("_id")).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "n_sentences", F.size("offending").cast("long").alias("n_offending"), spans.alias("offending"))
