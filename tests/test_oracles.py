"""Every query with SQL against DuckDB on the smallest tables; invariants of the loops; the text formats."""

import random
from collections import Counter

import duckdb
import pytest

from splicedf import plans
from splicedf.operators import graph, intervals
from tests.conftest import SF

TABLES = ("customer", "lineitem", "orders", "supplier", "part")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rounded(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_oracle(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    r = duck.execute(plans.ORACLE_SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    want = Counter(rounded(row[names.index(c)] for c in cols) for row in r.fetchall())
    assert Counter(rounded(row[c] for c in cols) for row in df.collect()) == want


def test_greedy_mis_is_the_pass_in_order(spark):
    r = random.Random(1)
    for n in (1, 12, 40):
        prio = {i: r.randint(0, 5) for i in range(n)}
        edges = {tuple(sorted(r.sample(range(n), 2))) for _ in range(2 * n)} if n > 1 else set()
        want, gone = set(), set()
        for i in sorted(prio, key=lambda i: (-prio[i], i)):
            if i not in gone:
                want.add(i)
                gone |= {b if a == i else a for a, b in edges if i in (a, b)}
        got = graph.greedy_mis(spark.createDataFrame(list(prio.items()), "node long, priority long"), spark.createDataFrame(list(edges), "a long, b long"))
        assert {x[0] for x in got.collect()} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40) if i % 7] + [(100, 3), (101, 101)]
    got = dict(graph.connected_components(spark.createDataFrame([(i,) for i in [*range(1, 42), 100, 101]], "node long"), spark.createDataFrame(edges, "a long, b long")).collect())
    assert got[7] == 1 and got[8] == 8 and got[14] == 8 and got[100] == 1 and got[101] == 101 and got[41] == 41


def test_overlap_join_is_the_nested_loop(spark):
    r = random.Random(2)
    rows = [(i, r.choice("ab"), s := r.randint(-50, 400), s + r.choice([0, 3, 30, 300])) for i in range(120)]
    d = spark.createDataFrame(rows, "tid long, chrom string, s long, e long")
    for slack in (0, 7):
        got = intervals.join_overlap(d, d, width=16, slack=slack).select("tid_a", "tid_b").collect()
        want = [(a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[2] - slack <= b[3] and b[2] <= a[3] + slack]
        assert sorted(map(tuple, got)) == sorted(want)
