"""Loops of the choice of models, which have no SQL, against the pass written out; small cases of retained introns."""

from math import floor

from pyspark.sql import functions as F

from splicedf import plans
from splicedf.operators import frames, picking, retention
from splicedf.plans.retention import joined
from splicedf.sources import projection
from tests.conftest import SF
from tests.test_whole_job import in_order, transcripts


def test_requirements_filter_is_the_loop(spark):
    exons: dict = {}
    for tid, gid, s, e, ref in projection.Tables(spark, SF).exon.select("tid", "gid", "s", "e", "is_ref").collect():
        exons.setdefault(gid, {}).setdefault((tid, ref), set()).add((s, e))
    want = set()
    for models in exons.values():
        while True:
            every = set().union(*models.values()) if models else set()
            bad = [k for k, v in models.items() if not k[1] and (len(v) < 2 or len(v) / len(every) < 0.3)]
            if not bad:
                break
            models = {k: v for k, v in models.items() if k not in bad}
        want |= {k[0] for k in models}
    assert {x.tid for x in plans.QUERIES["requirements_filter"](spark, SF).collect()} == want


def test_requirements_filter_measures_again(spark):
    """A model stays while its neighbour does: each round takes one from the end of the chain; the reference stays."""
    d = spark.createDataFrame([(i, i + 1, i == 7) for i in range(1, 5)] + [(7, 9, True)], "tid long, next long, is_ref boolean")

    def measure(left):
        return left.join(left.select(F.col("tid").alias("next"), F.lit(1).alias("there")), "next", "left")

    assert [x.tid for x in picking.requirements_filter(d, F.col("there") == 1, measure).collect()] == [7]
    assert picking.requirements_filter(d, F.col("there") == 1, measure, check_references=True).count() == 0
    assert picking.requirements_filter(d.limit(0), F.col("there") == 1, measure).count() == 0


def scored(models, group):
    """Models with the score of the query, in each group."""
    out = {}
    for x in models:
        own = [y for y in models if group[y.tid] == group[x.tid]]
        parts = []
        for c, up in (("cdna", True), ("n_exons", False)):
            low, high = min(y[c] for y in own), max(y[c] for y in own)
            v = 1.0 if low == high else (x[c] - low) / (high - low) if up else 1 - (x[c] - low) / (high - low)
            parts.append(floor(v * 100 + 0.5) / 100)
        out[x.tid] = sum(parts)
    return out


def chosen(models, group):
    score = scored(models, group)
    clash = lambda x, y: group[x.tid] == group[y.tid] and x.s <= y.e and y.s <= x.e
    return in_order(models, lambda x: (-score[x.tid], x.tid), clash)


def test_loci_is_the_chain_by_hand(spark):
    models = transcripts(spark)
    sub = {x.tid: x.sublocus for x in plans.QUERIES["subloci"](spark, SF).collect()}
    first = chosen(models, sub)
    holder = {x.tid: x.tid for x in first}
    moved = True
    while moved:
        moved = False
        for x in first:
            for y in first:
                if (x.chrom, x.strand) == (y.chrom, y.strand) and x.s <= y.e and y.s <= x.e and holder[y.tid] < holder[x.tid]:
                    holder[x.tid], moved = holder[y.tid], True
    want = {(x.tid, holder[x.tid]) for x in chosen(first, holder)}
    assert {(x.tid, x.holder) for x in plans.QUERIES["loci"](spark, SF).collect()} == want


def frame(spark, models, cds=None):
    rows = [("c", "+", 1, i, False, "x", s, e) for i, v in models.items() for s, e in v]
    x = spark.createDataFrame(rows, "chrom string, strand string, gid long, tid long, is_ref boolean, source string, s long, e long")
    c = spark.createDataFrame([("c", "+", 1, i, s, e) for i, v in (cds or {}).items() for s, e in v], "chrom string, strand string, gid long, tid long, s long, e long")
    return x, c


def test_retained_introns_small(spark):
    models = {1: [(100, 200), (301, 400), (501, 600), (701, 800)], 2: [(100, 200), (301, 600), (701, 800)], 3: [(100, 250)], 4: [(320, 380)], 5: [(100, 200), (301, 450)], 6: [(100, 200), (310, 600), (701, 800)], 7: [(50, 90), (100, 800)]}
    cds = {1: [(150, 200), (301, 400), (501, 600), (701, 750)], 2: [(150, 200), (301, 420)], 5: [(150, 200), (301, 400)]}
    got = {(x.tid, x.s, x.e): x.disrupts for x in retention.retained_introns(*frame(spark, models, cds), "gid").collect()}
    # 2 spans an intron and stops in it; 3 and 5 end in one; 4 meets none; 6 starts where no exon does; 7 spans all, by the end of exon 4
    assert got == {(2, 301, 600): True, (3, 100, 250): False, (5, 301, 450): True, (7, 100, 800): False}
    assert retention.retained_introns(*(d.limit(0) for d in frame(spark, models, cds)), "gid").count() == 0


def test_as_remove_retained_is_the_loop(spark):
    x, c = joined(projection.Tables(spark, SF))
    rows, coding = x.select("gid", "strand", "tid", "s", "e").collect(), c.select("tid", "s", "e").collect()
    first: dict = {}
    cdna: dict = {}
    for r in rows:
        cdna[r.gid, r.tid] = cdna.get((r.gid, r.tid), 0) + r.e - r.s + 1
    for (gid, tid), n in cdna.items():
        first[gid] = max(first.get(gid, (0, 0)), (n, -tid))
    primary = {-t for _, t in first.values()}
    left = {r.tid for r in rows}
    while True:
        own = x.filter(x.tid.isin(sorted(left))), c.filter(c.tid.isin(sorted(left)))
        gone = {r.tid for r in retention.retained_introns(*own, "gid").collect()} - primary
        if not gone:
            break
        left -= gone
    assert {r.tid for r in plans.QUERIES["as_remove_retained"](spark, SF).collect()} == left
    assert len(left) < len({r.tid for r in rows}) and coding


def test_frames_small(spark):
    rows = [(1, 4, 9, 0, "ATGATGTAA"), (2, 1, 12, 0, "ATGTAAGGGTAA"), (3, 4, 8, 0, "CCCGGGTTTAAA"), (4, 1, 30, 0, "ATG"), (5, 7, 12, 0, "ATGCCCGGGTTT"), (6, 7, 12, 0, "TAACCCGGGTTT"), (7, 6, 11, 0, "CCCCCGGGTTT"), (8, 1, 0, 0, "")]
    d = spark.createDataFrame(rows, "tid long, s long, e long, phase int, seq string")
    assert {x.tid: x.reason for x in frames.orf_validate(d).collect()} == {1: "valid", 2: "stop", 3: "length", 4: "bounds", 5: "valid", 6: "valid", 7: "valid", 8: "bounds"}
    got = {x.tid: (x.s, x.phase, x.stopped) for x in frames.orf_start_adjust(d.filter("tid IN (1, 5, 6, 7, 8)")).collect()}
    assert got == {1: (4, 0, False), 5: (1, 0, False), 6: (1, 0, True), 7: (1, 2, False), 8: (1, 0, False)}


def test_codons_are_read_in_one_pass(spark):
    """A sequence of a million letters: before, every codon was sought from the start of the text, which took hours."""
    from time import monotonic

    from splicedf.operators import sequence

    text = F.concat(F.repeat(F.lit("GCAatg"), 150_000), F.lit("TGa"), F.lit("cc"))
    began = monotonic()
    d = spark.range(1).select(text.alias("seq")).select(sequence.translated(F.col("seq")).alias("p"), sequence.inner_stop(F.col("seq")).alias("inner"), sequence.ends_with_stop(F.col("seq")).alias("last"))
    got = d.select(F.length("p"), F.substring("p", 1, 4), F.substring("p", -2, 2), "inner", "last").collect()[0]
    assert tuple(got) == (300_001, "AMAM", "M*", False, True) and monotonic() - began < 60
    orf = spark.createDataFrame([(1, 900_001, 900_900)], "tid long, s long, e long").withColumn("seq", F.concat(F.lit("ATG"), F.repeat(F.lit("GCA"), 400_000)))
    assert tuple(frames.orf_start_adjust(orf).collect()[0])[2:] == (1, 900_900, 0, False)
    few = spark.createDataFrame([("",), ("TA",), ("tag",), ("TAGA",), ("TAGAAA",), ("ATAGAA",), ("NNNtgaNNN",), (None,)], "seq string")
    got = few.select(sequence.translated(F.col("seq")), sequence.inner_stop(F.col("seq")), sequence.ends_with_stop(F.col("seq"))).collect()
    assert [tuple(x) for x in got] == [("", False, False), ("", False, False), ("*", False, True), ("*", False, True), ("*K", True, False), ("IE", False, False), ("X*X", True, False), ("", False, False)]


def test_dna_is_cut_at_chunks(spark):
    """The pieces of exons, also of long ones and of those past the end of the table, are the letters one by one."""
    from splicedf.plans.loci import dna, slice_of

    rows = [(1, "+", 10_000, 10_000), (2, "+", 10_499, 10_500), (3, "+", 12_345, 15_678), (4, "+", 5_013_400, 5_014_900), (5, "+", 70_000_123, 70_000_777)]
    d = spark.createDataFrame(rows, "tid long, strand string, s long, e long")
    got = {}
    for x in sorted(dna(d).collect()):
        got[x.tid] = got.get(x.tid, "") + x.dna
    assert got == {x.tid: x.t for x in d.select("tid", slice_of("s", "e").alias("t")).collect()}


def written(spark):
    from pathlib import Path

    from splicedf.operators import graph

    return sum(p.stat().st_size for p in Path(graph.shared_dir(spark)).rglob("*") if p.is_file())


def test_retained_introns_write_what_can_count(spark):
    """Terminal exons that overlap hundreds of introns of their locus and share no border: before, every such pair was
    written, 9 MB here."""
    rows = [(i, "g", "c", "+", s + i, e + i) for i in range(300) for s, e in ((1, 1000), (3000, 4000))]
    x = spark.createDataFrame([*rows, (999, "g", "c", "+", 900, 3100)], "tid long, gid string, chrom string, strand string, s long, e long")
    was = written(spark)
    got = retention.retained_introns(x, x.limit(0), "gid").collect()
    assert [tuple(r) for r in got] == [(999, 900, 3100, False)] and written(spark) - was < 2_000_000


def test_as_remove_retained_judges_again_only_where_it_must(spark, monkeypatch):
    """Where disrupted models go, one round settles it: before, all models were always met again. Where they stay alone, a
    model that is disrupted no longer goes a round later."""
    models = {1: [(100, 200), (301, 400), (501, 600), (701, 800)], 2: [(100, 200), (301, 600), (701, 800)], 3: [(100, 250)], 4: [(320, 380)], 5: [(100, 200), (301, 450)], 6: [(100, 200), (310, 600), (701, 800)], 7: [(50, 90), (100, 800)], 8: [(150, 210), (301, 400)], 9: [(301, 650), (701, 800)], 10: [(100, 210), (301, 420)]}
    cds = {1: [(150, 200), (301, 400), (501, 600), (701, 750)], 2: [(150, 200), (301, 420)], 5: [(150, 200), (301, 400)], 9: [(701, 750)], 10: [(150, 210), (301, 350)]}
    x, c = frame(spark, models, cds)
    rounds, one = [], retention.considered
    monkeypatch.setattr(retention, "considered", lambda *a: rounds.append(1) or one(*a))
    for kept, disrupted in ((False, False), (True, False), (False, True)):
        left, n = set(models), 0
        while True:
            r = retention.retained_introns(x.filter(x.tid.isin(sorted(left))), c.filter(c.tid.isin(sorted(left))), "gid").groupBy("tid").agg(F.bool_or("disrupts").alias("d")).collect()
            gone = {t for t, d in r if not (disrupted if d else kept)} - {4}
            n += 1
            if not gone:
                break
            left -= gone
        rounds.clear()
        got = retention.as_remove_retained(x, c, "gid", spark.createDataFrame([(4,)], "tid long"), keep_retained=kept, keep_disrupted=disrupted)
        assert sorted(t.tid for t in got.collect()) == sorted(left) and 4 < len(left) < len(models)
        assert len(rounds) == (n if disrupted else 1)
