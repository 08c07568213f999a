"""Larger tables make more tasks, not larger ones; frames and junctions are met in one pass."""

from pyspark.sql import functions as F

from splicedf import plans
from splicedf.operators import evidence
from splicedf.sources import projection
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_hold_no_more_lines_than_they_may(spark, monkeypatch):
    monkeypatch.setattr(projection, "TASK_ROWS", 500)
    t = projection.Tables(spark, SF)
    parts = -(-t.rows // 500)
    assert t.rows == spark.read.parquet(f"{SF}/lineitem.parquet").count() and parts > 4
    for d in (t.exon, t.transcript, t.spread(t.intron, "chrom", "s", "e")):
        assert d.rdd.getNumPartitions() == parts
    of = t.exon.select("tid", F.spark_partition_id().alias("p")).groupBy("tid").agg(F.count_distinct("p").alias("n"))
    assert of.filter("n > 1").isEmpty()
    states = sorted(map(tuple, plans.QUERIES["join_semi_anti"](spark, SF).collect()))
    monkeypatch.undo()
    assert states == sorted(map(tuple, plans.QUERIES["join_semi_anti"](spark, SF).collect())) and {x[1] for x in states} == {"recovered", "lost"}


def test_verified_introns_small(spark):
    intron = spark.createDataFrame([(1, "c", "+", 5, 9), (1, "c", "+", 20, 30), (2, "c", "-", 5, 9), (3, "c", None, 5, 9), (3, "c", None, 40, 50), (4, "d", "+", 5, 9), (5, "c", ".", 5, 9), (5, "c", "-", 40, 50)], "tid long, chrom string, strand string, s long, e long")
    junction = spark.createDataFrame([("c", 5, 9, "+"), ("c", 5, 9, "+"), ("c", 5, 9, "."), ("c", 40, 50, None), ("c", 40, 50, "-"), ("d", 5, 9, "-")], "chrom string, s long, e long, strand string")
    checked = evidence.verified_introns(intron, junction)
    got = sorted((x.tid, x.s, x.verified) for x in checked.collect())
    assert got == [(1, 5, True), (1, 20, False), (2, 5, False), (3, 5, False), (3, 40, True), (4, 5, False), (5, 5, True), (5, 40, True)]
    assert plan(checked).count("Join") == 1


def test_frames_are_made_of_transcripts_once(spark):
    for name in ("orf_order", "orf_strand_filter"):
        assert plan(plans.QUERIES[name](spark, SF)).count("Relation") == 2


def test_pieces_are_read_along_the_strand(spark):
    from splicedf.operators import sequence
    from splicedf.plans.loci import dna, slice_of

    rows = [(1, "-", 10_000, 10_000), (2, "-", 12_345, 13_678), (2, "-", 14_499, 14_500), (3, "+", 12_345, 13_678), (3, "+", 14_499, 14_500), (4, None, 5_013_400, 5_014_900)]
    d = spark.createDataFrame(rows, "tid long, strand string, s long, e long")
    own = {(x.tid, x.s): x.t for x in d.select("tid", "s", slice_of("s", "e").alias("t")).collect()}
    turned = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    want = {1: turned(own[1, 10_000]), 2: turned(own[2, 12_345] + own[2, 14_499]), 3: own[3, 12_345] + own[3, 14_499], 4: own[4, 5_013_400]}
    assert dict(sequence.cdna_sequence(dna(d)).collect()) == want
    assert "translate" not in plan(sequence.cdna_sequence(dna(d)).filter("tid > 0")).split("Join")[0]


def test_fasta_lines_end_with_letters(spark, tmp_path):
    from splicedf.sources import formats

    seqs = {"a": "ACGT" * 30, "b": "", "c": "G" * 61, "d": "é" * 70, "e": "AC GT \t" * 20 + "A"}
    d = formats.fasta_lines(spark.createDataFrame(list(seqs.items()), "name string, seq string"))
    want = {k: ">" + k + "\n" + "\n".join(v[i : i + 60] for i in range(0, len(v), 60)) for k, v in seqs.items()}
    assert dict(d.collect()) == want
    d.select("value").write.text(str(tmp_path / "f"))
    got = {x.name: (x.seq, x.length) for x in formats.scan_fasta(spark, str(tmp_path / "f")).collect()}
    assert got == {k: (s := "".join(v.split()), len(s)) for k, v in seqs.items()}


def test_pairs_are_met_without_a_join_of_exons(spark):
    from splicedf.operators import compare
    from splicedf.plans.comparison import sides

    t = projection.Tables(spark, SF)
    own = {}
    for x in t.exon.select("tid", "s", "e").collect():
        own.setdefault(x.tid, []).append((x.s, x.e))
    pairs = compare.compared(*sides(t))
    assert plan(pairs).count("Generate explode(sequence") == 2  # those of the candidates; before, exons were met in bins as well
    got = pairs.select("tid_a", "tid_b", "n_common").collect()
    assert len(got) == len(set(got)) > 100
    assert all(x.n_common == sum(max(0, min(a[1], b[1]) - max(a[0], b[0]) + 1) for a in own[x.tid_a] for b in own[x.tid_b]) for x in got)
