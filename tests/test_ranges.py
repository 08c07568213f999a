"""Sweeps along chromosomes, range by range: the same rows as one pass, and no task that holds a chromosome."""

import random

import pytest
from pyspark.sql import functions as F

from splicedf.operators import intervals, model


@pytest.fixture(params=[8, 64, 1 << 16])
def width(request, monkeypatch):
    monkeypatch.setattr(model, "RANGE", request.param)
    return request.param


def made(seed, n=150):
    r = random.Random(seed)
    return [(r.choice("ab"), r.choice(["+", "-", None]), s := r.randint(-60, 900), s + r.choice([0, 3, 9, 150]), i) for i in range(n)]


def rows(spark, d):
    return spark.createDataFrame(d, "chrom string, strand string, s long, e long, gid long")


def test_islands(spark, width):
    d = made(width)
    got = {r["gid"]: r["island"] for r in model.islands(rows(spark, d), ["chrom", "strand"], F.col("s") <= F.col("_top") + 5).collect()}
    want = {}
    for key in {x[:2] for x in d}:
        n, top = 0, None
        for x in sorted((x for x in d if x[:2] == key), key=lambda x: (x[2], x[3])):
            if top is None or x[2] > top + 5:
                n += 1
            top = x[3] if top is None else max(top, x[3])
            want[x[4]] = n
    assert got == want


def test_numbers_and_neighbours(spark, width):
    d = made(width + 1)
    got = {r["gid"]: r["n"] for r in model.numbered(rows(spark, d), ["chrom"], "e", "gid").collect()}
    flanks = {r["gid"]: r for r in intervals.gene_flank_distances(rows(spark, d)).collect()}
    gaps = {r["gid"]: r["distance"] for r in intervals.intergenic_distances(rows(spark, d)).collect()}
    for chrom in "ab":
        own = sorted((x for x in d if x[0] == chrom), key=lambda x: (x[2], x[3], x[4]))
        for k, x in enumerate(own):
            assert got[x[4]] == k + 1
            prev, nxt = max(((y[3], y[4]) for y in own[:k]), default=None), own[k + 1] if k + 1 < len(own) else None
            f = flanks[x[4]]
            assert f["prev_gid"] == (prev and prev[1]) and f["next_gid"] == (nxt and nxt[4])
            assert f["prev_distance"] == (max(0, x[2] - prev[0]) if prev else 0) and f["next_distance"] == (max(0, nxt[2] - x[3]) if nxt else 0)
            assert gaps.get(x[4]) == (nxt[2] - x[3] if nxt else None)


def test_no_window_holds_a_chromosome(spark):
    """Every window by chromosome alone runs over the table of ranges, which an aggregate makes."""
    plan = model.islands(rows(spark, made(1)), ["chrom"], F.col("s") <= F.col("_top"))._jdf.queryExecution().optimizedPlan().toString()
    windows = [[part.strip("[] ") for part in x.rsplit("], [", 2)] for x in plan.splitlines() if "Window [" in x]
    assert len(windows) >= 4
    assert all("_cell" in by or order.startswith("_cell") for _, by, order in windows)
