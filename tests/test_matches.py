"""Matches of predictions by hand: fusions, run-on, strands, places, and pairs that are given."""

import pytest

from splicedf.operators import compare, model

EXON = "tid string, gid string, chrom string, strand string, is_ref boolean, source string, s long, e long"
REFERENCE = {
    ("r1", "g1", "+"): [(100, 200), (300, 400)],
    ("r2", "g2", "+"): [(1000, 1100), (1200, 1300)],
    ("r2b", "g2", "+"): [(1000, 1100), (1250, 1300)],
    ("r3", "g3", "-"): [(1150, 1250)],
    ("r4", "g4", "+"): [(5000, 5100), (5200, 5300)],
    ("r5", "g5", "-"): [(5400, 5500)],
}
PREDICTED = {
    ("fused", "+"): [(100, 200), (300, 400), (1000, 1100), (1200, 1300)],
    ("weak", "+"): [(100, 200), (300, 400), (1000, 1005)],
    ("beside", "+"): [(2000, 2100)],
    ("nearer", "+"): [(5305, 5380)],
    ("far", "+"): [(90000, 90100)],
    ("turned", "-"): [(150, 200), (1150, 1250)],
    ("plain", None): [(150, 200), (1000, 1050)],
    ("thin", "+"): [(195, 200), (600, 650), (1000, 1003)],
    ("lone", "-"): [(110, 150)],
}


def side(spark, named):
    rows = [(tid, gid, "chr1", strand, True, "x", s, e) for (tid, gid, strand), x in named.items() for s, e in x]
    exon = spark.createDataFrame(rows, EXON)
    return model.transcript_bounds(exon), exon, model.introns(exon)


@pytest.fixture(scope="module")
def both(spark):
    return side(spark, {(t, f"p_{t}", strand): x for (t, strand), x in PREDICTED.items()}), side(spark, REFERENCE)


def matches(both, **how):
    got = {}
    for r in compare.tmap(*both, **how).collect():
        got.setdefault(r["tid"], []).append(r)
    return {t: sorted(rs, key=lambda r: str(r["ref_id"])) for t, rs in got.items()}


def test_rows_of_each_prediction(both):
    got = matches(both)
    brief = {t: [(r["ref_id"], r["ccode"]) for r in rs] for t, rs in got.items()}
    assert brief["fused"] == [("r1", "f,n"), ("r2", "f,n")]
    assert {r["location"] for r in got["fused"]} == {"chr1:100..1300"} and [r["ref_gene"] for r in got["fused"]] == ["g1", "g2"]
    assert brief["weak"] == [("r1", "n")] and got["weak"][0]["location"] == "chr1:100..1005"
    assert brief["beside"] == [("r2", "p")] and got["beside"][0]["distance"] == 700  # the first of two as near
    assert brief["nearer"] == [("r4", "p")] and got["nearer"][0]["distance"] == 5
    assert brief["far"] == [(None, "u")] and got["far"][0]["location"] == "chr1:90000..90100" and got["far"][0]["n_f1"] == 0
    assert brief["turned"] == [("r3", "n")]  # one place alone is on its strand
    assert [r["ref_id"] for r in got["plain"]] == ["r1", "r2b"] and all(r["ccode"].startswith("f,") for r in got["plain"])
    assert len(brief["thin"]) == 1 and not brief["thin"][0][1].startswith("f,")  # neither gene has a tenth
    assert brief["lone"] == [("r1", "x")]


def test_without_fusions_the_best_of_them(both):
    got = matches(both, report_fusions=False)
    assert all(len(rs) == 1 and not rs[0]["ccode"].startswith("f,") for rs in got.values())
    assert got["fused"][0]["ref_id"] in ("r1", "r2") and got["weak"][0]["ref_id"] == "r1"


def test_distance_bounds_what_is_beside(both):
    assert matches(both, distance=600)["beside"][0]["ccode"] == "u"


def test_given_pairs_keep_their_columns(spark, both):
    pairs = spark.createDataFrame([("fused", "r4", 7), ("fused", "r2", 8)], "tid_a string, tid_b string, mark int")
    got = {r["tid_b"]: r for r in compare.compare_pairs(*both, pairs=pairs).collect()}
    assert got["r4"]["ccode"] == "p" and got["r4"]["mark"] == 7 and got["r4"]["distance"] == 3700 and got["r2"]["j_common"] == 2 and got["r2"]["e_common"] == 2


def test_options(spark, both):
    cds = spark.createDataFrame([("r1", 150, 200), ("r1", 300, 350), ("fused", 1050, 1100), ("fused", 1200, 1250)], "tid string, s long, e long")
    pred, ref = (compare.with_options(d, cds, exclude_utr=True) for d in both)
    rows = lambda d, tid: sorted((r["s"], r["e"]) for r in d[1].filter(f"tid = '{tid}'").collect())
    assert rows(ref, "r1") == [(150, 200), (300, 350)] and rows(pred, "fused") == [(1050, 1100), (1200, 1250)] and rows(ref, "r2") == [(1000, 1100), (1200, 1300)]
    assert ref[0].filter("tid = 'r1'").first()["cdna"] == 102 and pred[2].filter("tid = 'fused'").count() == 1
    assert [(r["ref_id"], r["ccode"]) for r in compare.tmap(pred, ref).filter("tid = 'fused'").collect()] == [("r2", "=")]
    coding = [compare.with_options(d, cds, protein_coding=True) for d in both]
    assert [(r["tid"], r["ref_id"]) for r in compare.tmap(*coding).collect()] == [("fused", "r1")]


def test_places_far_out(spark):
    """Models on both sides of 2^32, as tables of 6 GB have them: before, bases in common were lost there."""
    at = 1 << 32
    a, b = [(at - 50, at + 50), (at + 300, at + 400)], [(at + 10, at + 50), (at + 300, at + 400), (at + 600, at + 700)]
    pred, ref = side(spark, {("p", "g", "+"): a, ("m", "h", "+"): [(at + 350, at + 450)]}), side(spark, {("r", "g", "+"): b})
    got = {r["tid_a"]: r for r in compare.compare_pairs(pred, ref).collect()}
    assert (got["p"]["n_common"], got["p"]["j_common"], got["p"]["i_common"], got["p"]["ccode"]) == (142, 2, 1, "C")
    assert (got["m"]["n_common"], got["m"]["m_first"], got["m"]["ccode"]) == (51, 49, "e")
