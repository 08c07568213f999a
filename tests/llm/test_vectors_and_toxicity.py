"""Vector codes and clusters against brute force in Python's integers; toxicity against its formula and held-out labels."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from splicedf.llm import simplex_clusters, toxicity, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, _id string, v int, apex int"
NAN, INF = float("nan"), float("inf")


def vectors(dims, n=90, seed=1):
    r = random.Random(seed)
    rows = [(i, [r.choice([-1.0, 0.0, 0.5, r.gauss(0, 1)]) for _ in range(dims)], r.choice([0, 1, None])) for i in r.sample(range(1000), n)]
    rows += [rows[3], rows[3], (rows[5][0], [0.25] * dims, 1), (None, [0.5] * dims, None), (None, [-0.5] * dims, 2)]
    rows += [(2000 + i, list(rows[0][1]), 0) for i in range(20)]  # copies
    rows += [(2100, None, 0), (2101, [None] + [0.0] * (dims - 1), 1), (2102, [NAN] * dims, 1), (2103, [0.0] * (dims - 1) + [-INF], 1)]
    rows += [(2104, [1e6, -1e6] + [0.0] * (dims - 2), 1), (2105, [3e30] * dims, 1), (2106, [-1e-9] * dims, 1)]
    return [(*x, "x", "y", 7, 8) for x in rows]


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(x, scale):
    y = math.floor(x * scale)
    return max(-(1 << 62), min(1 << 62, y))


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def best(v, entries):
    return min((gap(v, e), i) for i, e in enumerate(entries))


def mean_floor(rows):
    return [sum(c) // len(rows) for c in zip(*rows)]


def brute_codes(rows, parts, entries, rounds, scale):
    kept = [(i, [whole(x, scale) for x in v], lab) for i, v, lab, *_ in rows if sound(v)]
    dims = -(-max([len(v) for _, v, _ in kept] + [1]) // parts) * parts
    kept = [(i, v + [0] * (dims - len(v)), lab) for i, v, lab in kept]
    m = dims // parts
    cut = lambda v: [v[p * m : (p + 1) * m] for p in range(parts)]
    books = list(map(list, zip(*[cut(v) for i, v, _ in sorted(kept, key=lambda x: (x[0] is None, x[0] or 0, x[1]))[:entries]])))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(best(cut(v)[p], books[p])[1], []).append(cut(v)[p])
            books[p] = [mean_floor(own[e]) if e in own else books[p][e] for e in range(len(books[p]))]
    out = []
    for i, v, lab in kept:
        found = [best(x, b) for x, b in zip(cut(v), books)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), min(sum(d for d, _ in found), (1 << 63) - 1)))
    return out, books


@pytest.mark.parametrize("dims,parts,entries", [(32, 16, 64), (12, 4, 5), (7, 2, 8)])
def test_vector_codes(spark, dims, parts, entries):
    rows = vectors(dims) + [(3000, [], 1, "x", "y", 7, 8), (3001, [1.0], 1, "x", "y", 7, 8)]
    d, books = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA).repartition(3), parts=parts, entries=entries)
    want, want_books = brute_codes(rows, parts, entries, 2, 256)
    assert books == want_books
    got = sorted(map(tuple, d.select("_id", "_label", "code", "error").collect()), key=repr)
    assert got == sorted(want, key=repr)
    sums = {}
    for _, lab, _, e in want:
        sums[lab] = min(sums.get(lab, 0) + e, (1 << 63) - 1)
    assert {(r["_label"], r["label_error"]) for r in d.collect()} == set(sums.items())
    text = ",".join(str(x) for part in want_books for e in part for x in e)
    assert vector_codes.digest(books) == hashlib.sha256(text.encode()).hexdigest()


def test_vector_codes_of_empty_and_unsound_tables(spark):
    for rows in ([], [(1, None, 1, "x", "y", 7, 8), (2, [NAN], 1, "x", "y", 7, 8)]):
        d, books = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA))
        assert d.collect() == [] and books == [] and [*d.columns] == ["_id", "_label", "code", "error", "label_error"]


@pytest.mark.parametrize("n", [1, 2, 4, 8, 32])
def test_walsh_is_in_sequency_order_and_keeps_lengths(n):
    h = vector_codes.walsh(np.eye(n, dtype=np.int64)).T
    assert [(np.diff(row) != 0).sum() for row in h] == list(range(n)) and (h @ h.T == n * np.eye(n)).all()
    x = np.random.default_rng(1).integers(-99, 99, (5, n))
    assert ((vector_codes.walsh(x) ** 2).sum(1) == n * (x**2).sum(1)).all()


def test_nearest_entry_ties_go_to_the_first():
    rows, entries = np.array([[0, 0, 0], [4, 4, 4], [2, 2, 2]]), np.array([[4, 4, 4], [0, 0, 0], [4, 4, 4], [0, 0, 0]])
    entry, distance = vector_codes.nearest(rows, entries)
    assert entry.tolist() == [1, 0, 0] and distance.tolist() == [0, 0, 12]


def brute_clusters(rows, clusters, rounds, dims, scale, seed):
    kept = [(i, [whole(x, scale) for x in v]) for i, v, *_ in rows if sound(v) and len(v) == dims]
    key = lambda x: (x[0] is None, hashlib.sha256(f"{seed}:{x[0]}".encode()).hexdigest() if x[0] is not None else "", x[1])
    centroids = [v for _, v in sorted(kept, key=key)[:clusters]]
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(best(v, centroids)[1], []).append(v)
        centroids = [mean_floor(own[c]) if c in own else centroids[c] for c in range(len(centroids))]
    return [(i, best(v, centroids)[1], min(best(v, centroids)[0], (1 << 63) - 1)) for i, v in kept], centroids


@pytest.mark.parametrize("dims,clusters,pivots", [(16, 8, 8), (5, 3, 4), (64, 8, 1)])
def test_simplex_clusters(spark, dims, clusters, pivots):
    rows = vectors(dims, seed=2) + [(3000, [], 1, "x", "y", 7, 8), (3001, [1.0] * (dims + 1), 1, "x", "y", 7, 8)]
    how = {"dims": dims, "clusters": clusters, "most_pivots": pivots}
    d = simplex_clusters.report(spark.createDataFrame(rows, SCHEMA).repartition(3), **how)
    want, centroids = brute_clusters(rows, clusters, 10, dims, 1024, 3)
    got = d.collect()
    assert sorted(((r["_id"], r["cluster"], r["distance"]) for r in got), key=repr) == sorted(want, key=repr)
    top = (1 << 63) - 1
    assert {r["inertia"] for r in got} == {min(top, sum(x for *_, x in want))}
    assert all(r["cluster_inertia"] == min(top, sum(x for _, c, x in want if c == r["cluster"])) for r in got)
    assert all(r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest() for r in got)


def test_simplex_bounds_hold_and_leave_few_centroids():
    r = np.random.default_rng(3)
    middles = r.integers(-900, 900, (8, 64))
    rows = (middles[r.integers(0, 8, 400)] + r.integers(-60, 60, (400, 64))).astype(np.int64)
    s = simplex_clusters.simplex(rows[:64], 8)
    a, b = s.apexes(rows), s.apexes(middles)
    true = np.sqrt(((rows[:, None] - middles[None]) ** 2).sum(2))
    flat = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(2)
    low, high = np.sqrt(flat + (a[:, None, -1] - b[None, :, -1]) ** 2), np.sqrt(flat + (a[:, None, -1] + b[None, :, -1]) ** 2)
    assert (low <= true + 1e-6).all() and (true <= high + 1e-6).all()
    cluster, distance, compared = simplex_clusters.nearest(rows, a, middles, b)
    assert (cluster == true.argmin(1)).all() and (distance == np.rint(true.min(1) ** 2)).all() and compared < 2 * len(rows)


def test_simplex_of_equal_vectors_and_empty_tables(spark):
    rows = [(i, [1.0, 2.0], 0, "x", "y", 7, 8) for i in range(5)]
    got = simplex_clusters.report(spark.createDataFrame(rows, SCHEMA), dims=2).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)} and len(got) == 5
    none = simplex_clusters.report(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and "centroid_sha256" in none.columns


# toxicity

DOCS = "doc_id long, text string, lang string, source string, score string, part int"


def corpus(n=400, seed=4):
    """Prose in which every fifth document has one sentence with a bad word; beginnings of words mark some of them."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(150)]
    rows, labels = [], []
    for i in range(n):
        lines = [" ".join(r.choice(words) for _ in range(r.randint(4, 14))) for _ in range(r.randint(1, 12))]
        toxic = int(i % 5 == 0)
        if toxic:
            k = r.randrange(len(lines))
            lines[k] += " " + r.choice(["vile", "vile", "grubzor" + r.choice(words), "grubzor" + r.choice(words)]) + " " + r.choice(words)
        rows.append((i, ". ".join(x.capitalize() for x in lines) + ".", r.choice(["en", None]), "s", "x", 1))
        labels.append((i, r.choice([0, 1, None]), toxic))
    return rows, labels


def odd_rows():
    return [(9000, None, None, None, None, None), (9001, "", "en", "s", "x", 1), (9002, " \n !!! ...", "en", "s", "x", 1), (None, "A text without id that is vile.", "en", "s", "x", 1), (9003, "vile " * 30000, "en", "s", "x", 1), (9004, "x" * 50000, "en", "s", "x", 1)]


LABELS = "doc_id long, quality int, toxic int"


def out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_toxicity_learns_held_out_labels_and_finds_the_sentence(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + odd_rows() + [rows[0], rows[0]], DOCS).repartition(3)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (9000, 1, 1), (7, 1, None)], LABELS)
    got = toxicity.report(docs, lab).collect()
    assert len(got) == len(rows) + len(odd_rows()) + 2
    by = {r["_id"]: r for r in got}
    toxic = {i: t for i, _, t in labels}
    held = [i for i in toxic if out(i)]
    assert all(by[i]["held_out"] == out(i) for i in toxic) and by[None]["held_out"] is False
    caught = [by[i]["predicted"] for i in held if toxic[i]]
    assert len(caught) > 10 and sum(caught) >= 0.9 * len(caught)
    clean = [by[i]["predicted"] for i in held if not toxic[i]]
    assert sum(clean) <= 0.05 * len(clean)
    texts = {r[0]: r[1] for r in rows}
    for i in held:
        if toxic[i] and by[i]["offending"]:
            s, e = map(int, by[i]["offending"].split(",")[0].split(":"))
            assert "vile" in texts[i][s:e] or "grubzor" in texts[i][s:e]
    assert [by[i]["score"] for i in (9000, 9001)] == [0.0, 0.0] and by[9000]["n_sentences"] == 0
    assert by[None]["score"] >= 0.3 and by[9003]["predicted"] == 1 and all(0 <= r["score"] <= 1 for r in got)


def test_toxicity_never_learns_from_held_out_rows(spark):
    rows, labels = corpus(150)
    docs = spark.createDataFrame(rows, DOCS)
    a = toxicity.scored(docs, spark.createDataFrame(labels, LABELS)).select("_id", "score").collect()
    b = toxicity.scored(docs, spark.createDataFrame([(i, q, 1 - t if out(i) else t) for i, q, t in labels], LABELS)).select("_id", "score").collect()
    assert sorted(a) == sorted(b)


def test_toxicity_without_both_labels(spark):
    rows, labels = corpus(20)
    docs = spark.createDataFrame(rows + odd_rows()[:2], DOCS)
    for kept, score in ([], 0.0), ([(i, q, 0) for i, q, _ in labels], 0.0), ([(i, q, 1) for i, q, _ in labels], 1.0):
        got = toxicity.scored(docs, spark.createDataFrame(kept, LABELS)).collect()
        assert {round(r["score"], 6) for r in got if r["n_sentences"]} == {score} and {r["score"] for r in got if not r["n_sentences"]} == {0.0}
    assert toxicity.report(docs.limit(0), spark.createDataFrame(labels, LABELS)).collect() == []


def test_noisy_or_loss_and_gradient():
    texts, y, w = ["Bad word. Good one.", "good one here! and there", "bad. bad luck", ""], [1, 0, 1, 0], [1.0, 3.0, 1.0, 1.0]
    bags, r = toxicity.Bags(texts, y, w), np.random.default_rng(1)
    weights, bias = r.normal(0, 1, toxicity.FEATURES), -0.7

    def loss(weights, bias):
        total = 0.0
        for t, label, c in zip(texts[:3], y, w):
            harmless = 1.0
            for _, _, words in toxicity.sentences(t):
                harmless *= 1 - 1 / (1 + math.exp(-(bias + sum(weights[f] for x in words for f in toxicity.features(x)))))
            total -= c * math.log(1 - harmless if label else harmless)
        return total / sum(w[:3])

    g, gb, got = bags.gradient(weights, bias)
    assert got == pytest.approx(loss(weights, bias))
    assert gb == pytest.approx((loss(weights, bias + 1e-6) - loss(weights, bias - 1e-6)) / 2e-6, rel=1e-4)
    for f in toxicity.features("bad")[:2] + toxicity.features("one")[:2]:
        up, down = weights.copy(), weights.copy()
        up[f] += 1e-6
        down[f] -= 1e-6
        assert g[f] == pytest.approx((loss(up, bias) - loss(down, bias)) / 2e-6, rel=1e-4)
    score, spans = toxicity.Scorer(weights, bias).text(texts[0])
    assert score == pytest.approx(1 - math.prod(1 - p for *_, p in spans)) and [texts[0][s:e].strip() for s, e, _ in spans] == ["Bad word.", "Good one."]


def test_calibration_is_the_curve_through_the_counts():
    odds = np.repeat([-2.0, 2.0], 1000)
    y = np.r_[np.arange(1000) < 100, np.arange(1000) < 800].astype(float)
    slope, offset = toxicity.calibration(odds, y, np.ones(2000))
    at = [1 / (1 + math.exp(-(slope * x + offset))) for x in (-2.0, 2.0)]
    assert at == pytest.approx([0.1, 0.8], abs=0.01)
