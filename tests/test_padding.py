"""Padding by nested loops and letter by letter, on small made models."""

import random

import pytest

from splicedf.operators import padding

MODELS = "tid long, locus string, strand string, s long, e long"


def made(seed, n=40):
    r, out = random.Random(seed), {}
    for tid in range(1, n + 1):
        locus = r.choice("ab")
        first, last = sorted(r.sample(range(5), 2)) if r.random() < 0.8 else [r.randrange(5)] * 2
        x = []
        for k in range(first, last + 1):
            if first < k < last and r.random() < 0.2:
                continue
            x.append((1000 + 200 * k + r.choice([0, 0, 15, 40]), 1000 + 200 * k + 100 + r.choice([0, 0, 10, 120 if k == last else 0])))
        out[tid] = (locus, "-" if locus == "b" else "+", x, r.randint(1, 4))
    return out


def edge(u, t, distance, splices):
    """Whether the start of exons u may be taken on from t."""
    if not t[0][0] < u[0][0] or min(u[-1][1], t[-1][1]) <= u[0][0]:
        return False
    for k, (s, e) in enumerate(t):
        if s <= u[0][0] <= e:
            d, n = 0, 0
            if s < u[0][0]:
                d, n = u[0][0] - s + 1, int(k > 0)
            for j in range(k):
                d += t[j][1] - t[j][0] - 1
                n += 1 if j == 0 else 2
            return d <= distance and n <= splices
    return False


def mirror(x):
    return sorted((-e, -s) for s, e in x)


def side(models, turn, distance, splices):
    """Of each model the best sink that it reaches, by walking the graph."""
    x = {i: turn(m[2]) for i, m in models.items()}
    to = {i: [j for j in x if models[i][0] == models[j][0] and edge(x[i], x[j], distance, splices)] for i in x}
    out = {}
    for i in x:
        seen, todo = set(), list(to[i])
        while todo:
            j = todo.pop()
            if j not in seen:
                seen.add(j)
                todo += to[j]
        if seen:
            out[i] = min((j for j in seen if not to[j]), key=lambda j: (-models[j][3], j))
    return out


def low_padded(x, t):
    """Exons x with what template t has below: the template's pieces are walked from the model's start outwards."""
    start = x[0][0]
    if t[-1][1] < start:
        return x, 0
    before = [(s, e) for s, e in t if s <= start]
    new = before[-1][0]
    return [*before[:-1], (new, x[0][1]), *x[1:]], start - new + sum(e - s + 1 for s, e in before[:-1])


def padded(models, low, high):
    out = {}
    for i, (_, _, x, _) in models.items():
        a = b = 0
        y = list(x)
        if i in low:
            y, a = low_padded(y, models[low[i]][2])
        if i in high:
            y, b = low_padded(mirror(y), mirror(models[high[i]][2]))
            y = mirror(y)
        out[i] = (y, a, b)
    return out


def frames(spark, models):
    x = spark.createDataFrame([(i, locus, strand, s, e) for i, (locus, strand, x, _) in models.items() for s, e in x], MODELS)
    return x, spark.createDataFrame([(i, m[3]) for i, m in models.items()], "tid long, score long")


@pytest.mark.parametrize("seed,distance,splices", [(1, 2000, 2), (2, 150, 2), (3, 2000, 0), (4, 400, 4), (5, 30, 1)])
def test_templates_and_exons(spark, seed, distance, splices):
    models = made(seed)
    low, high = (side(models, turn, distance, splices) for turn in (lambda x: x, mirror))
    x, score = frames(spark, models)
    t = padding.pad_templates(x, score, distance, splices)
    want = {i: (high.get(i), low.get(i)) if m[1] == "-" else (low.get(i), high.get(i)) for i, m in models.items()}
    assert {r["tid"]: (r["five"], r["three"]) for r in t.collect()} == want
    exons, added = padding.pad_extend(x, t)
    got = {}
    for r in exons.collect():
        got.setdefault(r["tid"], []).append((r["s"], r["e"]))
    after = padded(models, low, high)
    assert {i: sorted(y) for i, y in got.items()} == {i: y for i, (y, _, _) in after.items()}
    assert {r["tid"]: (r["five_added"], r["three_added"]) for r in added.collect()} == {i: (b, a) if models[i][1] == "-" else (a, b) for i, (_, a, b) in after.items()}


def test_templates_are_found_at_all(spark):
    """The cases above hold chains, both strands and templates over introns."""
    ends = [side(made(s), t, 2000, 2) for s in range(1, 6) for t in (lambda x: x, mirror)]
    assert sum(map(len, ends)) > 30


def test_many_models_at_one_place_are_one_node(spark):
    models = {i: ("a", "+", [(1000 + 10 * (i % 3), 1400)], i % 7) for i in range(300)}
    x, score = frames(spark, models)
    assert sorted(map(tuple, padding.low_edges(x, score, 2000, 2).select("locus", "p", "q").collect())) == [("a", 1010, 1000), ("a", 1020, 1000), ("a", 1020, 1010)]
    low = side(models, lambda x: x, 2000, 2)
    assert {r["tid"]: r["five"] for r in padding.pad_templates(x, score).collect() if r["five"]} == {i: t for i, t in low.items() if t}


def test_empty_locus(spark):
    x, score = frames(spark, {})
    exons, added = padding.pad_extend(x, padding.pad_templates(x, score))
    assert exons.collect() == [] and added.collect() == []


def orf(spark, *rows):
    d = spark.createDataFrame(rows, "tid long, s long, e long, phase int, five_added long, three_added long, was_seq string, seq string")
    return {(r["tid"], r["was"]): (r["s"], r["e"], r["phase"], r["verdict"]) for r in padding.pad_orf_extend(d).collect()}


def test_frames_go_on_stay_or_are_reverted(spark):
    body = "GCTGCAGCC" * 3
    got = orf(
        spark,
        (1, 1, 27, 0, 6, 9, body, "ATGGCA" + body + "GCATAAGCC"),  # start above, stop below
        (2, 1, 33, 0, 5, 4, "ATG" + body + "TAA", "GCGCC" + "ATG" + body + "TAA" + "GGGG"),  # complete: moves only
        (3, 1, 27, 0, 9, 0, body, "ATGTAAGCC" + body),  # the way up holds a start, but a stop after it
        (4, 1, 27, 0, 4, 3, body, "GGGG" + body + "GCC"),  # open at both ends
        (5, 2, 27, 1, 3, 0, "G" + body, "GCC" + "G" + body),  # phase carried, open
        (6, 1, 30, 0, 0, 6, "ATG" + body, "ATG" + body + "GCCTGA"),  # has its start, gets a stop
        (7, 1, 27, 0, 0, 0, body, body),  # did not grow
        (8, 1, 27, 0, 9, 0, body, "GCCTAAGCC" + body), (8, 7, 27, 0, 9, 0, body, "GCCTAAGCC" + body),  # a stop and no start above: both frames go back
    )
    assert got[1, 1] == (1, 39, 0, "extended")
    assert got[2, 1] == (6, 38, 0, "moved")
    assert got[3, 1] == (1, 27, 0, "reverted")
    assert got[4, 1] == (1, 34, 1, "extended")
    assert got[5, 2] == (1, 31, 2, "extended")
    assert got[6, 1] == (1, 36, 0, "extended")
    assert got[7, 1] == (1, 27, 0, "moved")
    assert {got[8, 1][3], got[8, 7][3]} == {"reverted"} and got[8, 7][:2] == (7, 27)


def test_copies_and_equal_chains(spark):
    models = [(1, "a", 5, False, True), (2, "a", 9, True, False), (3, "a", 7, False, False), (4, "a", 8, False, False), (5, "a", 8, False, False), (6, "a", 1, True, False), (7, "b", 5, False, True), (8, "a", 2, False, False), (9, "a", 3, False, False)]
    x, y, mono = [(1, 10), (20, 30)], [(1, 10), (20, 40)], [(1, 50)]
    exons = {1: x, 2: x, 3: x, 4: y, 5: y, 6: [(5, 10), (20, 33)], 7: x, 8: mono, 9: [(2, 50)]}
    m = spark.createDataFrame(models, "tid long, locus string, score long, is_ref boolean, is_primary boolean")
    e = spark.createDataFrame([(i, *p) for i, v in exons.items() for p in v], "tid long, s long, e long")
    assert dict(map(tuple, padding.pad_redundancy(m, e).collect())) == {2: "copy", 3: "copy", 5: "copy", 4: "chain"}


def test_long_chains_of_places(spark):
    """Ninety models, each of which holds the start of the one before alone: before, sixty rounds were the most."""
    models = {i: ("a", "+", [(5000 - 10 * i, 5012 - 10 * i), (6000, 6100)], i % 7 + 1) for i in range(90)} | {99: ("b", "+", [(100, 200)], 1)}
    x, score = frames(spark, models)
    low = side(models, lambda x: x, 2000, 2)
    assert {r["tid"]: r["five"] for r in padding.pad_templates(x, score).collect() if r["five"] is not None} == low == {i: 89 for i in range(89)}


@pytest.mark.parametrize("name,most", [("pad_extend", 30), ("pad_redundancy", 30), ("pad_orf_extend", 30)])
def test_exons_are_brought_together_seldom(spark, name, most):
    """Models are rows, so their exons are not joined and grouped by model again at every step."""
    from splicedf import plans
    from tests.conftest import SF

    p = plans.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert p.count("Exchange hashpartitioning") <= most
