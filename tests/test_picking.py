"""Steps of the choice of models that have no SQL, and small cases, against the pass written out."""

from splicedf import plans
from splicedf.operators import compare, picking
from splicedf.sources import projection
from tests.conftest import SF


def test_as_redundant_is_the_pass_in_order(spark):
    t = projection.Tables(spark, SF)
    genes: dict = {}
    for tid, gid, cdna in t.transcript.select("tid", "gid", "cdna").collect():
        genes.setdefault(gid, []).append((-cdna, tid))
    rest = {gid: sorted(v)[1:] for gid, v in genes.items()}
    side = (t.transcript, t.exon, t.intron)
    code = {(a, b): c for a, b, c in compare.compare_pairs(side, side).select("tid_a", "tid_b", "ccode").collect()}
    want = set()
    for models in rest.values():
        kept: list = []
        for _, tid in models:
            if not any(code.get((tid, other)) in picking.REDUNDANT_CODES for other in kept):
                kept.append(tid)
        want |= set(kept)
    assert {x.tid for x in plans.QUERIES["as_redundant"](spark, SF).collect()} == want
    assert len(want) < sum(map(len, rest.values()))


def test_reduce_contained_small(spark):
    models = {1: [(10, 20), (30, 40), (50, 60)], 2: [(30, 40), (50, 58)], 3: [(12, 20), (50, 55)], 4: [(30, 40), (50, 58)], 5: [(31, 39)], 6: [(30, 41), (50, 60)], 7: [(32, 38)]}
    exon = spark.createDataFrame([("c", "+", i, s, e) for i, v in models.items() for s, e in v], "chrom string, strand string, tid long, s long, e long")
    t = spark.createDataFrame([(i, v[0][0], v[-1][1], i == 7) for i, v in models.items()], "tid long, s long, e long, is_ref boolean")
    assert sorted(x.tid for x in picking.reduce_contained(t, exon).collect()) == [1, 3, 6, 7]
    assert picking.reduce_contained(t.limit(0), exon.limit(0)).count() == 0


def test_stop_codons_join_what_they_touch(spark):
    cds = spark.createDataFrame([(1, 10, 20), (2, 10, 20)], "tid long, s long, e long")
    stop = spark.createDataFrame([(1, 21, 23), (2, 21, 21), (2, 30, 31)], "tid long, s long, e long")
    assert sorted(map(tuple, picking.stop_codon_fix(cds, stop).collect())) == [(1, 10, 23), (2, 10, 21), (2, 30, 31)]
