"""The graph loops on graphs whose labels are the worst for them, and what they store."""

import glob
import os

from splicedf.operators import graph


def test_components_of_ordered_paths_and_stars(spark):
    n = 200
    path = [(i, i + 1) for i in range(1, n)]
    stars = [(1000 + 10 * k + 9, 1000 + 10 * k + i) for k in range(20) for i in range(9)] + [(1000 + 10 * k, 1010 + 10 * k) for k in range(19)]
    nodes = [(i,) for i in [*range(1, n + 1), *range(1000, 1200), 5000]]
    got = dict(graph.connected_components(spark.createDataFrame(nodes, "node long"), spark.createDataFrame(path + stars + [(7, 7), (3, 2), (2, 3)], "a long, b long")).collect())
    assert got == {v: 1 if v <= n else 1000 if v < 1200 else 5000 for (v,) in nodes}


def test_loops_take_edges_of_strangers_and_selves_and_write_little(spark):
    nodes = spark.createDataFrame([(i, i % 5) for i in range(1000)], "node long, priority long")
    edges = spark.createDataFrame([(i, j) for i in range(1000) for j in (i + 1, i + 2, i) if j < 1003], "a long, b long")
    was = set(glob.glob(f"{graph.shared_dir(spark)}/**", recursive=True))
    want, gone = set(), set()
    for i in sorted(range(1000), key=lambda i: (-(i % 5), i)):
        if i not in gone:
            want.add(i)
            gone |= {i - 2, i - 1, i + 1, i + 2}
    assert {r.node for r in graph.greedy_mis(nodes, edges).collect()} == want
    new = [f for f in set(glob.glob(f"{graph.shared_dir(spark)}/**", recursive=True)) - was if os.path.isfile(f)]
    assert not [f for f in new if os.path.basename(f).startswith("part-") and not f.endswith(".parquet")], "rounds are packed tables"
