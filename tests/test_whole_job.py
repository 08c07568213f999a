"""Queries that once left rows out, against brute force over all rows."""

from splicedf import plans
from splicedf.sources import projection
from tests.conftest import SF


def transcripts(spark):
    return projection.Tables(spark, SF).transcript.collect()


def in_order(rows, rank, clash):
    """The greedy pass, by brute force."""
    kept = []
    for x in sorted(rows, key=rank):
        if not any(clash(x, y) for y in kept):
            kept.append(x)
    return kept


def test_select_best_nonoverlapping_takes_all(spark):
    clash = lambda x, y: (x.chrom, x.strand) == (y.chrom, y.strand) and x.s <= y.e and y.s <= x.e
    want = in_order(transcripts(spark), lambda x: (-x.cdna, x.tid), clash)
    got = [r[0] for r in plans.QUERIES["select_best_nonoverlapping"](spark, SF).collect()]
    assert sorted(got) == sorted(x.tid for x in want) and any(i % 2 for i in got)


def test_connected_components_links_all(spark):
    g = projection.Tables(spark, SF).gene.select("gid", "chrom", "s", "e").collect()
    want = {}
    for x in sorted(g):
        todo = [x]
        while todo:
            y = todo.pop()
            if y.gid not in want:
                want[y.gid] = x.gid
                todo += [z for z in g if z.chrom == y.chrom and z.s <= y.e and y.s <= z.e]
    got = dict(plans.QUERIES["connected_components"](spark, SF).collect())
    assert got == want and any((a - b) % 4 for a, b in got.items())


def test_orfs_of_all_transcripts(spark):
    frames = {}
    for x in transcripts(spark):
        both = [(31, x.cdna // 2 - 20), (x.cdna // 2 + 10 - 40 * (x.tid % 2), x.cdna - 30)]
        if own := sorted((f for f in both if f[0] < f[1]), key=lambda f: (f[0] - f[1], f[0])):
            frames[x.tid] = own
    order = plans.QUERIES["orf_order"](spark, SF).collect()
    assert sorted(map(tuple, order)) == sorted((i, *f, k) for i, own in frames.items() for k, f in enumerate(own, 1))
    clash = lambda x, y: min(x[1], y[1]) >= max(x[0], y[0])
    want = [(i, *f) for i, own in frames.items() for f in in_order(own, lambda f: (f[0] - f[1], f[0]), clash)]
    assert sorted(map(tuple, plans.QUERIES["orf_nonoverlapping"](spark, SF).collect())) == sorted(want)
    assert {i % 10 for i in frames} == set(range(10))
