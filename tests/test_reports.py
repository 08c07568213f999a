"""The report of a comparison by hand: outer borders, inner exons, unspliced matches, found and private models and genes."""

import pytest

from splicedf.operators import compare, evaluate, model
from splicedf.sources import formats
from tests.test_matches import EXON


def side(spark, models, is_ref):
    rows = [(tid, gid, "c", strand, is_ref, "x", s, e) for (tid, gid, strand), x in models.items() for s, e in x]
    exon = spark.createDataFrame(rows, EXON)
    return model.transcript_bounds(exon), exon, model.introns(exon)


REF = {("r1", "g1", "+"): [(10, 50), (100, 150), (200, 260)], ("r2", "g2", "+"): [(1000, 1099)], ("r3", "g3", "-"): [(3000, 3100)], ("r4", "g1", "+"): [(100, 150), (300, 320)]}
PRED = {("p1", "q1", "+"): [(20, 50), (100, 150), (200, 240)], ("p2", "q2", "+"): [(1000, 1095)], ("p3", "q3", "+"): [(9000, 9100), (9200, 9300)], ("p4", "q2", "-"): [(3000, 3100)]}


@pytest.fixture(scope="module")
def facts(spark):
    pred, ref = side(spark, PRED, False), side(spark, REF, True)
    pairs = compare.compared(pred, ref).cache()
    single = ref[1].join(pairs.filter("ccode = '_'").selectExpr("tid_b AS tid").distinct(), "tid", "left_semi")
    exon = pred[1].unionByName(ref[1])
    lenient = evaluate.lenient_flags(exon, single.select("chrom", "strand", "s", "e"))
    found = evaluate.found_levels(pred[0].unionByName(ref[0]), pairs)
    return pairs, lenient, {r["key"]: tuple(r)[1:] for r in found.collect()}


def test_lenient_exons(facts):
    got = {tuple(r)[:1] + tuple(r)[2:] for r in facts[1].collect()}
    assert got == {
        ("start", "+", 50, 0, True, True), ("end", "+", 200, 0, True, True), ("exon", "+", 100, 150, True, True), ("start", "+", 150, 0, True, False), ("end", "+", 300, 0, True, False),
        ("start", "+", 9100, 0, False, True), ("end", "+", 9200, 0, False, True), ("exon", "+", 1000, 1099, True, False), ("exon", "-", 3000, 3100, True, True),
    }


def test_found_and_private(facts):
    pairs, _, found = facts
    n = {(r["tid_a"], r["tid_b"]): r["n_f1"] for r in pairs.collect()}
    assert n["p4", "r3"] == 1 and 0.95 < n["p2", "r2"] < 1 and 0.8 < n["p1", "r1"] < 0.95
    # (common_ref, common_pred, pred, ref): p4 equals r3, p2 is close to r2, p1 rather close to r1
    assert [found[f"tx{x}"] for x in evaluate.FOUND] == [(1, 1, 4, 4), (2, 2, 4, 4), (3, 3, 4, 4)]
    assert [found[f"gene{x}"] for x in evaluate.FOUND] == [(1, 1, 3, 3), (2, 1, 3, 3), (3, 2, 3, 3)]
    assert found["tx_private"] == (0, 1, 4, 4) and found["gene_private"] == (0, 1, 3, 3) and found["mono"] == (2, 2, 4, 4)


def test_report_and_its_file(spark, tmp_path):
    keys = {k for _, k in evaluate.LEVEL_ROWS} | {"mono", "tx_private", "gene_private"}
    d = spark.createDataFrame([(k, 3, 4, 8, 6) for k in sorted(keys - {"exon_lenient"})] + [("exon_lenient", 0, 0, 8, 0)], "key string, common_ref long, common_pred long, pred long, ref long")
    report = evaluate.stats_report(d)
    rows = {r["row"]: r for r in report.collect()}
    assert sorted(rows) == list(range(1, 31)) and tuple(rows[1])[1:5] == ("Base level", 50.0, 50.0, 50.0) and rows[3]["sn"] == 0 and rows[3]["f1"] == 0
    assert (rows[19]["n"], rows[20]["n"]) == (8, 6) and tuple(rows[21])[5:] == (3, 6, 50.0) and tuple(rows[24])[5:] == (8, 8, 0.0) and tuple(rows[28])[5:] == (4, 8, 50.0)
    formats.write_stats(report, str(tmp_path / "stats"))
    lines = {r["row"]: r["value"] for r in formats.scan_stats(spark, str(tmp_path / "stats")).collect()}
    assert len(lines) == 30 and lines[1] == "                        Base level: 50.00  50.00  50.00" and lines[15].endswith("chains: 4") and lines[21].endswith("(stringent): 3/6  (50.00%)")


def test_facts_bring_models_together_once(spark):
    """Levels are asked of tables of distinct exons and introns: before, each gathered or numbered a model's exons anew."""
    from unittest import mock

    from splicedf.operators import graph
    from splicedf.plans import reports
    from splicedf.sources import projection
    from tests.conftest import SF

    made = []
    with mock.patch.object(reports, "_cut", lambda d: made.append(d) or graph._cut(d)):
        reports.facts(projection.Tables(spark, SF))
    plan = made[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 3 and "collect_list" not in plan


def test_bases_are_counted_range_by_range(spark):
    """Bases of unions by brute force, with intervals over several ranges, and flags in place of two tables."""
    import random

    from splicedf.operators import intervals

    r = random.Random(3)
    rows = [(r.choice("xy"), s := r.choice([65_500, 131_000, 10, -70_000]) + r.randint(0, 90), s + r.choice([0, 5, 40, 66_000]), r.random() < 0.6, r.random() < 0.5) for _ in range(60)]
    rows.append((None, 1, 9, True, True))
    of = lambda i: {(k, p) for k, s, e, *f in rows if f[i] for p in range(s, e + 1)}
    a, b = of(0), of(1)
    want = (sum(k is not None for k, _ in a & b), len(a), len(b))
    d = spark.createDataFrame(rows, "chrom string, s long, e long, in_a boolean, in_b boolean")
    assert tuple(intervals.covered_by(d, "in_a", "in_b").first()) == want
    assert tuple(intervals.covered_bases(d.filter("in_a"), d.filter("in_b")).first()) == want
    assert tuple(intervals.covered_bases(d.limit(0), d.limit(0)).first()) == (0, 0, 0)
